"""BPE encoding and decoding of whole texts, with tree concatenation for long stretches that nothing splits."""

from __future__ import annotations

import hashlib
import re
import string
import struct
from collections.abc import Iterable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Longest unsplit stretch, in characters, that is encoded in one piece.
LEAF_CHARS = 256
#: First width, in characters, of the window on each side of a join.
WINDOW_CHARS = 24
#: Bytes that a worker's remembered words take at most, by estimate; then it starts afresh.
MEMO_BYTES = 96 << 20
#: What a remembered word takes besides its characters, ids and tokens.
ENTRY_BYTES = 330
#: White space that no normalization composes with; other white space stays inside a word and is left to the tokenizer.
WORD = re.compile("[^ \t\n\r\x0b\x0c]+")
#: Letters that lower-casing and composition keep single, and signs that end words; not the apostrophe (contractions) nor the signs of added tokens.
LETTERS = string.ascii_letters + "".join(map(chr, (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))))
SIGNS = "".join(c for c in string.punctuation if c not in "'<|>")
PLAIN = re.compile(f"([{LETTERS}]+)([{re.escape(SIGNS)}]*)")
#: Characters of text whose words are learned together, and words that the library encodes in one call: its encodings are large.
LEARN_CHARS, LEARN_WORDS = 1_000_000, 4096
ENCODED = "struct<ids:array<int>,decoded:string>"
DIGEST = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


@lru_cache(1)
def byte_of_sign() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class TreeEncoder:
    """Encodes as tokenizer.encode(text, add_special_tokens=False) does, for a BPE with word ends whose pre-tokenizer drops white space.

    White space cuts a text into words that no merge, pattern or composition crosses, so words are encoded on their own and remembered. A word of more than
    LEAF_CHARS is unsplit text: its halves are encoded, recursively, all leaves of a batch in one parallel encode_batch, and at each join a window over it is encoded afresh and
    grown until it has a token on either side in common, begin and end, with the half's own encoding. Neighbouring tokens of a BPE encoding decide its validity pair by pair, so what
    is then spliced is what encoding the whole would give; a window that reaches over both halves is the whole.
    """

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.path, self._normal = path, None
        self.leaf_chars = max(2, leaf_chars)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token = [""] * (max(vocab.values(), default=-1) + 1)
        for t, i in vocab.items():
            self.token[i] = t
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        end = self.tokenizer.model.end_of_word_suffix or ""
        self.width = [len(t.removesuffix(end) if end else t) for t in self.token]
        self.ends = np.array([bool(end) and t.endswith(end) for t in self.token], bool)
        self.memo: dict[str, tuple[bytes, int, str]] = {}
        self.memo_bytes = 0
        self.parts_plain = self._parts_plain()

    def _parts_plain(self) -> bool:
        """Whether letters are one piece, signs another, and capitals as good as small letters."""
        t = self.tokenizer
        if t.normalizer is None or t.pre_tokenizer is None:
            return False
        pieces = lambda text: [at for _, at in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))]
        lowers = all(t.normalizer.normalize_str(c) == c.lower() for c in LETTERS + SIGNS)
        runs = pieces(LETTERS) == [(0, len(LETTERS))] and pieces(SIGNS) == [(0, len(SIGNS))]
        parted = all(pieces("a" + c) == [(0, 2)] for c in LETTERS) and all(pieces(f"a{c}") == [(0, 1), (1, 2)] for c in SIGNS)
        one_end = all(ids and self.ends[ids].sum() == 1 and self.ends[ids[-1]] for ids in self._batch([*LETTERS, *SIGNS], False))
        return lowers and runs and parted and one_end

    @property
    def normal(self) -> Tokenizer:
        """For text that is already normalized, as to do it twice isn't the same for every text; loaded when a stretch is too long for one piece."""
        if self._normal is None:
            t = self._normal = Tokenizer.from_file(self.path)
            t.no_padding()
            t.no_truncation()
            t.normalizer = type(t.normalizer)([]) if t.normalizer else None
        return self._normal

    def _batch(self, texts: list[str], normalized: bool = True) -> list[list[int]]:
        own = self.normal if normalized else self.tokenizer
        return [e.ids for i in range(0, len(texts), LEARN_WORDS) for e in own.encode_batch_fast(texts[i : i + LEARN_WORDS], add_special_tokens=False)]

    def _join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        spans = lambda ids, at: [(at := at + w) - w for w in map(self.width.__getitem__, ids)]
        size = lambda s: len(s.encode())
        ls, rs = spans(left_ids, 0), spans(right_ids, size(left))
        w = WINDOW_CHARS
        while True:
            a, b = max(0, len(left) - w), min(len(right), w)
            ids = self._batch([left[a:] + right[:b]])[0]
            if a == 0 and b == len(right):
                return ids
            begin, middle, stop = size(left[:a]), size(left), size(left) + size(right[:b])
            own = spans(ids, begin)
            at = {p: k for k, p in enumerate(own)}
            head = tail = None
            if a == 0:
                head = (0, 0)
            else:
                for i in range(len(left_ids) - 1, 0, -1):
                    if ls[i] <= begin:
                        break
                    k = at.get(ls[i])
                    if k and ids[k] == left_ids[i] and ls[i] + self.width[left_ids[i]] <= middle and i + 1 < len(left_ids):
                        head = (i, k)
                        break
            if b == len(right):
                tail = (len(right_ids), len(ids))
            else:
                for j in range(1, len(right_ids)):
                    if rs[j] + self.width[right_ids[j]] >= stop:
                        break
                    k = at.get(rs[j])
                    if k is not None and ids[k] == right_ids[j] and k + 1 < len(ids):
                        tail = (j, k)
                        break
            if head and tail and head[1] <= tail[1]:
                return left_ids[: head[0]] + ids[head[1] : tail[1]] + right_ids[tail[0] :]
            w *= 2

    def _tree(self, word: str) -> list[int]:
        """A word longer than a leaf, already normalized and free of added tokens."""
        leaves = [word]
        while len(leaves[0]) > self.leaf_chars:
            leaves = [h for x in leaves for h in (x[: (len(x) + 1) // 2], x[(len(x) + 1) // 2 :])]
        parts = list(zip(leaves, self._batch(leaves)))
        while len(parts) > 1:
            parts = [(x + y, self._join(x, i, y, j)) for (x, i), (y, j) in zip(parts[::2], parts[1::2])]
        return parts[0][1]

    def _long(self, word: str) -> list[int]:
        if any(t in word for t in self.added):  # matched before all else, so they cut as white space does
            return self._batch([word], False)[0]
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return [i for x in normal.split(" ") for i in self._tree(x)]

    def _learn(self, words: Iterable[str]) -> None:
        """Remembers words, after it has forgotten the others if they took too much. Those of one call may take more: their texts are held as well."""
        if self.memo_bytes > MEMO_BYTES:
            self.memo.clear()
            self.memo_bytes = 0
        new, made, odd = [w for w in words if w not in self.memo], [], []
        for w in new:
            m = PLAIN.fullmatch(w) if self.parts_plain and len(w) <= self.leaf_chars else None
            if m:
                made.append((w, m[1].lower(), m[2]))
            else:
                odd.append(w)
        self._learn_odd(odd)
        atoms = [a for a in {a for _, *both in made for a in both} if a and a not in self.memo]
        for i in range(0, len(atoms), LEARN_WORDS):
            self._learn_atoms(atoms[i : i + LEARN_WORDS])
        memo = self.memo
        for w, head, signs in made:
            if signs:
                (b, n, d), (b2, n2, d2) = memo[head], memo[signs]
                memo[w] = b + b2, n + n2, f"{d} {d2}"
                self.memo_bytes += ENTRY_BYTES + 2 * len(w) + 4 * (n + n2) + 2 * (len(d) + len(d2))
            elif head != w:
                memo[w] = memo[head]
                self.memo_bytes += ENTRY_BYTES // 2 + 2 * len(w)

    def _learn_atoms(self, atoms: list[str]) -> None:
        """Remembers runs of small letters or of signs, each of which has one word end, its last token."""
        ids = np.array(self._batch([" ".join(atoms)], False)[0], "<u4")
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) != len(atoms):
            raise ValueError("the tokenizer gave other word ends than its letters and signs have alone")
        packed, tokens, at = ids.tobytes(), [self.token[i] for i in ids.tolist()], 0
        for a, stop in zip(atoms, stops):
            self.memo[a] = packed[4 * at : 4 * stop], stop - at, " ".join(tokens[at:stop])
            at = stop
        self.memo_bytes += ENTRY_BYTES * len(atoms) + 2 * sum(map(len, atoms)) + 4 * len(ids) + 2 * sum(map(len, tokens)) + 2 * len(ids)

    def _learn_odd(self, words: list[str]) -> None:
        """Remembers words of any kind, each encoded on its own."""
        short, long = [w for w in words if len(w) <= self.leaf_chars], [w for w in words if len(w) > self.leaf_chars]
        token, pack = self.token.__getitem__, struct.Struct
        for part, got in ((short, self._batch(short, False)), (long, map(self._long, long))):
            for w, ids in zip(part, got):
                decoded = " ".join(map(token, ids))
                self.memo[w] = (pack(f"<{len(ids)}I").pack(*ids), len(ids), decoded)
                self.memo_bytes += ENTRY_BYTES + 2 * len(w) + 4 * len(ids) + 2 * len(decoded)

    def encode_bytes(self, texts: list[str | None]) -> Iterable[tuple[bytes, int, str]]:
        """For each text its ids as little-endian 32-bit integers, their number, and the text that they decode to."""
        at = 0
        while at < len(texts):
            part, chars = [], 0
            while at < len(texts) and (not part or chars + len(texts[at] or "") <= LEARN_CHARS):
                part.append(WORD.findall(texts[at] or ""))
                chars += len(texts[at] or "")
                at += 1
            self._learn(set().union(*part))
            memo = self.memo.__getitem__
            for words in part:
                if words:
                    ids, ns, decoded = zip(*map(memo, words))
                    yield b"".join(ids), sum(ns), " ".join(decoded if all(ns) else filter(None, decoded))
                else:
                    yield b"", 0, ""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(next(iter(self.encode_bytes([text])))[0], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """As tokenizer.decode(ids, skip_special_tokens=False) of a tokenizer without a decoder: tokens with spaces between."""
        return " ".join(self.token[i] for i in ids)

    def plain_text(self, ids: Iterable[int]) -> str:
        """The normalized text that ids stand for: bytes put together, a space after each word's end."""
        end, signs = self.tokenizer.model.end_of_word_suffix or "", byte_of_sign()
        out = bytearray()
        for i in ids:
            t = self.token[i]
            if t in self.added:
                out += t.encode() + b" "
                continue
            word_ends = bool(end) and t.endswith(end)
            out += bytes(signs[c] for c in (t.removesuffix(end) if word_ends else t))
            out += b" " * word_ends
        return out.decode("utf-8", "replace").strip(" ")


@lru_cache(1)
def encoder(path: str, leaf_chars: int = LEAF_CHARS) -> TreeEncoder:
    return TreeEncoder(path, leaf_chars)


def check_file(path: str) -> str:
    if not Path(path).is_file():
        raise FileNotFoundError(path)
    return path


def encoded(text: Column, path: str) -> Column:
    """struct(ids, decoded) of each text; null is empty. The tokenizer's file must lie at the same place on every machine."""

    @F.arrow_udf(ENCODED)
    def bpe(texts: pa.Array) -> pa.Array:
        rows = list(encoder(path).encode_bytes(texts.to_pylist()))
        ids = pa.array([np.frombuffer(b, "<i4") for b, _, _ in rows], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([ids, pa.array([d for _, _, d in rows], pa.string())], ["ids", "decoded"])

    return bpe(text)


def digests(text: Column, path: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of each text's ids (as little-endian unsigned 32-bit integers) and of the decoded text in UTF-8; null is empty."""

    @F.arrow_udf(DIGEST)
    def bpe_digest(texts: pa.Array) -> pa.Array:
        ns, ids, decoded = [], [], []
        for b, n, d in encoder(path).encode_bytes(texts.to_pylist()):
            ns.append(n)
            ids.append(hashlib.sha256(b).hexdigest())
            decoded.append(hashlib.sha256(d.encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(ns, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return bpe_digest(text)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens (digests of nothing); a null id stays null; repeated rows stay repeated; other columns are not read; no rows give none.
    """
    check_file(path)
    return docs.select(F.col(id_col).alias("doc_id"), digests(F.col(text_col), path).alias("d")).select("doc_id", "d.*")
