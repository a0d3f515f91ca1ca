"""Operators that work on one text at a time, against the libraries and plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from fixtures import odd_documents
from tokenizers import Tokenizer, models, pre_tokenizers

from lectern.llm import bpe, mil, quality_rules, unigram
from lectern.llm.queries import queries

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def run(name, spark, data):
    return queries()[name](spark, data).collect()


def texts_of(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


def unigram_library():
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    vocabulary = [("<unk>", 0.0)] + [(sp.id_to_piece(i), sp.get_score(i)) for i in range(3, sp.get_piece_size())]
    t = Tokenizer(models.Unigram(vocabulary, 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


def test_op1_counts_as_the_library_does(spark, data):
    texts, library = texts_of(spark, data), unigram_library()
    got = {r.doc_id: r.n_tokens for r in run("op1_token_counts", spark, data)}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_op1_on_random_texts_and_ties():
    library, own, rng = unigram_library(), unigram.UnigramCounter.from_file(PIECES), random.Random(5)
    signs = ["a", "b", " ", "  ", "\n", "\r", "é", "日", "😀", "▁", "the", " of", "<0x41>", "́", "ing", "\u0000"]
    for _ in range(400):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert own.count(t) == len(library.encode(t, add_special_tokens=False).ids), t
    tie = unigram.UnigramCounter([("ab", -2.0), ("a", -1.0), ("b", -1.0), ("▁", 0.0)], False)
    assert tie.count("ab") == 2  # the space mark and the longer piece, which begins first
    assert tie.count("xx") == 2  # unknown runs are one piece without byte pieces


def test_op8_round_trips_as_the_library_does(spark, data):
    texts, t = texts_of(spark, data), Tokenizer.from_file(WORDS)
    for r in run("op8_bpe_round_trip", spark, data):
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op8_tree_joins_are_exact():
    t, own, rng = Tokenizer.from_file(WORDS), bpe.TreeEncoder(WORDS, leaf_chars=8), random.Random(2)
    for alphabet in ("abcdefghijklmnop", "ab", "'srtlmvdeabc!?", "日本語中文éaß", "éa̧İΣς😀‍'", "0123456789.,-'st", "   \u0085\u001c​abcé"):
        for _ in range(60):
            s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))
            assert own.encode(s) == t.encode(s, add_special_tokens=False).ids
    s = "x<|endoftext|>" + "y" * 50
    assert own.encode(s) == t.encode(s, add_special_tokens=False).ids
    assert own.plain_text(own.encode("Hello, wörld")) == "hello , wörld"


def test_op8_letters_and_signs_learned_apart_are_exact():
    t, own, rng = Tokenizer.from_file(WORDS), bpe.TreeEncoder(WORDS), random.Random(3)
    assert own.parts_plain
    texts = ["".join(rng.choice("abZ Éßÿ×İµªſK.,'!<|>=≠\u0338\u0301 \n-_#0²ﬁ漢\x85") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a.<|endoftext|>. X<|ENDOFTEXT|>, don't. DON'T! ÀÉ.\u0338 b≮ _x_.", "", None, "X" * 3000 + "." * 700, "Word word WORD. word.. word!"]
    for text, (packed, n, decoded) in zip(texts, own.encode_bytes(texts), strict=True):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (np.frombuffer(packed, "<u4").tolist(), n, decoded) == (ids, len(ids), t.decode(ids, skip_special_tokens=False))


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_op10_counts(spark, data):
    texts = texts_of(spark, data)
    for r in run("op10_quality_rules", spark, data):
        want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)


def test_op10_odd_rows(spark):
    docs = odd_documents(spark)
    rows = quality_rules.verdicts(docs).collect()
    assert len(rows) == docs.count() and all(r.kept is not None for r in rows)
    assert quality_rules.verdicts(docs.limit(0)).collect() == []
    loops = spark.createDataFrame([(1, "a b c a b c a\nb\nb\n\n", "en"), (2, "a a a a", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.n_words, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.verdicts(loops).collect()}
    assert got == {1: base("a b c a b c a\nb\nb\n\n")[:1] + base("a b c a b c a\nb\nb\n\n")[3:], 2: (4, 0, 4)}


def test_op10_words_of_no_language_fail_and_good_documents_stay(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = quality_rules.verdicts(docs).collect()
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert len(good) > 200 and all(r.kept for r in good)
    bad = [r for r in rows if labels.get(r.doc_id) == 0 and not r.base_failed and r.n_words >= quality_rules.MIN_WORDS]
    assert any(not r.kept and r.class_distance <= quality_rules.MAX_CLASS_DISTANCE for r in bad)  # by its words alone
    rng = random.Random(5)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) + rng.choice([""] * 9 + [","]) for _ in range(n)).capitalize() + "."
    common = lambda n: " ".join(rng.choice(quality_rules.COMMON_WORDS["en"]) for _ in range(n)).capitalize() + "."
    odd = [(k, f(n), "en") for k, (f, n) in enumerate((f, n) for f in (letters, common) for n in (90, 150, 600, 5000))]
    got = quality_rules.verdicts(spark.createDataFrame(odd, "doc_id long, text string, lang string"), references=quality_rules.language_references(docs)).collect()
    assert all(r.word_distance > r.word_limit and not r.kept for r in got)
    assert all(r.class_distance <= quality_rules.MAX_CLASS_DISTANCE for r in got if r.doc_id < 4)


def test_op10_stored_references_judge_each_document_alone(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    quality_rules.language_references(docs).write.parquet(str(tmp_path / "refs"))
    refs = spark.read.parquet(str(tmp_path / "refs"))
    own = {tuple(r) for r in quality_rules.verdicts(docs).collect()}
    assert {tuple(r) for r in quality_rules.verdicts(docs, references=refs).collect()} == own
    junk = "".join(f"K7Q{i}X " for i in range(100))
    odd = spark.createDataFrame([(1, junk, "en"), (2, junk, "xx"), (3, None, "en"), (4, junk, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.verdicts(odd, references=refs).collect()}
    assert not got[1].kept and got[1].class_distance > quality_rules.MAX_CLASS_DISTANCE and got[1].word_distance > 0.3
    assert got[2].kept and got[2].class_distance is None and not got[3].kept and len(got) == 4
    part = {r.doc_id: tuple(r) for r in quality_rules.verdicts(docs.where("lang = 'en'"), references=refs).collect()}
    assert part and set(part.values()) <= own
    assert quality_rules.language_references(docs.limit(0)).collect() == []
    none = quality_rules.verdicts(docs, references=refs.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) and r.class_distance is None for r in none)


def test_op10_keeps_labelled_good_documents(spark, data):
    kept = {r.doc_id: r for r in run("op10_quality_rules", spark, data)}
    good = [r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()]
    assert all(kept[i].kept or kept[i].base_failed for i in good)


def test_op4_gradients_by_finite_differences():
    rng = np.random.default_rng(3)
    m = mil.Model.fresh(rng)
    m.b[0], starts, labels = 0.3, np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    x = np.abs(rng.standard_normal((7, mil.FEATURES)))
    _, grads = mil.loss_and_gradients(m, x, starts, labels)
    for name in m.__dataclass_fields__:
        w, g = getattr(m, name).reshape(-1), grads[name].reshape(-1)
        for k in rng.choice(w.size, min(12, w.size), replace=False):
            was, sides = w[k], []
            for step in (1e-5, -1e-5):
                w[k] = was + step
                sides.append(mil.loss_and_gradients(m, x, starts, labels)[0])
            w[k] = was
            assert abs((sides[0] - sides[1]) / 2e-5 - g[k]) < 1e-6, name


def test_op4_scores_by_plain_loops():
    m = mil.Model.fresh(np.random.default_rng(8))
    texts = ["", None, "a", "Some words. " * 300, "x" * 513, "é" * 700, "tail"]
    for t, got in zip(texts, m.scores(texts)):
        raw = (t or "").encode()
        cut = [raw[i : i + 512] for i in range(0, len(raw), 512)] or [b""]
        codes, logits = [], []
        for p in cut:
            h = np.tanh(mil.features([p])[0].astype(float) @ m.E + m.e)
            codes.append(h)
            logits.append(sum(w * np.tanh(h @ v) / (1 + np.exp(-(h @ u))) for w, v, u in zip(m.w, m.V.T, m.U.T)))
        weights = np.exp(np.array(logits) - max(logits))
        z = sum(a * h for a, h in zip(weights / weights.sum(), codes))
        assert abs(got - 1 / (1 + np.exp(-(z @ m.c + m.b[0])))) < 1e-6


def test_op4_features_of_a_passage_by_loops():
    p = "Ab 1,\n#é Ab 1".encode()
    f = mil.features([p, b""])
    pairs, kinds = Counter(), Counter()
    for a, b in zip(p, p[1:]):
        pairs[((a * 257 + b) * 2654435761 % 2**32) >> 22] += 1
    for c in p:
        kinds[0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in (32, 9) else 4 if c in (10, 13) else 5 if chr(c) in ".,;:?'\"()-" else 6 if 33 <= c < 127 else 7] += 1
    assert np.allclose(f[0, :1024], [math.sqrt(pairs[k] / len(p)) for k in range(1024)])
    assert np.allclose(f[0, 1024:1032], [3 * kinds[k] / len(p) for k in range(8)])
    assert math.isclose(f[0, 1032], len(p) / 512, rel_tol=1e-6) and math.isclose(f[0, 1033], len({p[i : i + 4] for i in range(len(p) - 3)}) / (len(p) - 3), rel_tol=1e-6)
    assert not f[1].any()


def test_op4_learns_from_whole_texts_within_its_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mil, "fit", lambda bags, labels, seed=1: seen.append(([len(b) for b in bags], labels.tolist())))
    docs = spark.createDataFrame([(i, "word " * (200 * i)) for i in range(1, 30)] + [(3, "zz"), (3, "aa")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, quality int")
    free = [i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 5]
    mil.train(docs, labels)
    assert seen[0] == ([1 if i == 3 else -(-1000 * i // 512) for i in free], [float(i % 2) for i in free])
    mil.train(docs, labels, max_bytes=40_000)
    assert 0 < sum(seen[1][0]) * 512 <= 40_000 + 512 * len(seen[1][0])
    mil.train(docs, labels, max_bytes=1)
    mil.train(docs, labels, max_docs=5)
    assert len(seen[2][0]) == 0 and len(seen[3][0]) == 5


def test_op4_a_text_that_is_too_long_costs_only_itself(spark, monkeypatch):
    for at in range(6):
        assert mil.fitting([(i, 1000 if i == at else 10) for i in range(6)], 60) == [i for i in range(6) if i != at]
    assert mil.fitting([(1, 30), (2, 40), (3, 30)], 60) == [1, 3] and mil.fitting([], 5) == []
    seen = []
    monkeypatch.setattr(mil, "fit", lambda bags, labels, seed=1: seen.append(len(bags)))
    free = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    for long in (free[0], free[len(free) // 2], free[-1]):
        docs = spark.createDataFrame([(i, "word " * (9000 if i == long else 20)) for i in range(60)], "doc_id long, text string")
        mil.train(docs, labels, max_bytes=20_000)
    assert seen == [len(free) - 1] * 3


def test_op4_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    rows = run("op4_quality_classifier", spark, data)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)
    good = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)


def test_op4_uses_no_held_out_label_and_survives_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(i, q) for i, q in ((1, 1), (1, 0), (2, None), (None, 1), (4, 0), (8, 1), (99, 1))], "doc_id long, quality int")
    rows = mil.scored(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = mil.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert mil.scored(docs.limit(0), labels).collect() == []
    flipped = labels.union(spark.createDataFrame([(i, 0) for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0], "doc_id long, quality int"))
    a, b = ({r.doc_id: r.score for r in mil.scored(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_text_operators_on_odd_rows(spark):
    docs = odd_documents(spark)
    for out in (bpe.token_digests(docs, WORDS), unigram.token_counts(docs, PIECES)):
        rows = out.collect()
        assert len(rows) == docs.count() and {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
        assert out.limit(0).collect() == []
