"""Quality classifier by attention-based multiple-instance learning over the passages of a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of a passage; the last of a text may be shorter.
PASSAGE_BYTES = 512
#: Bins of hashed pairs of neighbouring bytes, and of byte classes.
PAIR_BINS, CLASSES = 1024, 8
FEATURES = PAIR_BINS + CLASSES + 2
#: Sizes of the passage code and of the attention layer.
CODE, ATTENTION = 24, 12
#: Labelled documents that the model is fitted on at most, and bytes of their texts: the bound of what the driver gathers. Each is learned from with all its passages. Scoring knows no such bound.
TRAIN_DOCS, TRAIN_BYTES = 4000, 16 << 20
#: Passages encoded at a time.
STEP = 512
#: A score from here up counts as good.
CUT = 0.3


def byte_classes() -> np.ndarray:
    """Class of each byte: 0 lower case, 1 upper case, 2 digit, 3 space, 4 line break, 5 sentence marks, 6 other ASCII marks, 7 beyond ASCII and control."""
    out = np.full(256, 7, np.int64)
    out[0x21:0x7F] = 6
    out[ord("a") : ord("z") + 1], out[ord("A") : ord("Z") + 1], out[ord("0") : ord("9") + 1] = 0, 1, 2
    out[[32, 9]], out[[10, 13]] = 3, 4
    out[[ord(c) for c in ".,;:?'\"()-"]] = 5
    return out


def passages(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + PASSAGE_BYTES] for i in range(0, len(raw), PASSAGE_BYTES)] or [b""]


def features(parts: list[bytes]) -> np.ndarray:
    """A row for each passage: the shares of hashed byte pairs (square roots), of byte classes, how full it is and how varied its four-byte pieces are. An empty passage has only zeros."""
    kinds, out = byte_classes(), np.zeros((len(parts), FEATURES), np.float32)
    raw = np.frombuffer(b"".join(p.ljust(PASSAGE_BYTES, b"\0") for p in parts), np.uint8).reshape(len(parts), PASSAGE_BYTES)
    size = np.array([len(p) for p in parts])
    inside = np.arange(PASSAGE_BYTES) < size[:, None]
    row = np.repeat(np.arange(len(parts), dtype=np.int32), PASSAGE_BYTES).reshape(raw.shape)
    both = inside[:, 1:]
    pair = ((raw[:, :-1].astype(np.uint32) * 257 + raw[:, 1:]) * np.uint32(2654435761) >> np.uint32(22)).astype(np.int32)
    n = np.maximum(size, 1)[:, None]
    counts = np.bincount((row[:, 1:] * PAIR_BINS + pair)[both], minlength=len(parts) * PAIR_BINS).reshape(len(parts), PAIR_BINS)
    out[:, :PAIR_BINS] = np.sqrt(counts / n)
    out[:, PAIR_BINS : PAIR_BINS + CLASSES] = np.bincount((row * CLASSES + kinds[raw])[inside], minlength=len(parts) * CLASSES).reshape(len(parts), CLASSES) / n * 3
    out[:, -2] = size / PASSAGE_BYTES
    four = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, 4, axis=1)).view(np.uint32)[..., 0].copy()
    four[~inside[:, 3:]] = 0
    four.sort(axis=1)
    out[:, -1] = ((np.diff(four, axis=1) != 0).sum(axis=1) + (size == PASSAGE_BYTES)) / np.maximum(size - 3, 1)  # the filling of a short passage is one more kind
    out[size == 0] = 0
    return out


def bag(text: str | None) -> np.ndarray:
    """The features of all passages of a text."""
    parts = passages(text)
    return np.concatenate([features(parts[i : i + STEP]) for i in range(0, len(parts), STEP)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Passage code h = tanh(x E + e), attention softmax(w . (tanh(h V) * sigmoid(h U))) over a text's passages, and a logistic output on the weighted code."""

    E: np.ndarray
    e: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Model:
        g = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
        return cls(g(FEATURES, CODE), np.zeros(CODE), g(CODE, ATTENTION), g(CODE, ATTENTION), g(ATTENTION), g(CODE), np.zeros(1))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and attention logits of passages."""
        h = np.tanh(x @ self.E + self.e)
        return h, (np.tanh(h @ self.V) * sigmoid(h @ self.U)) @ self.w

    def pooled(self, h: np.ndarray, logit: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention weights and weighted codes of bags that begin at starts."""
        sizes = np.diff([*starts, len(h)])
        a = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        return a, np.add.reduceat(a[:, None] * h, starts, axis=0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1 of each whole text."""
        out = np.empty(len(texts))
        at = 0
        while at < len(texts):  # whole texts, as many as fill a step; a longer one has its passages encoded in steps
            bags = []
            first = at
            while at < len(texts) and (not bags or sum(map(len, bags)) + len(texts[at] or "") // PASSAGE_BYTES < STEP):
                bags.append(passages(texts[at]))
                at += 1
            flat = [p for b in bags for p in b]
            got = [self.encode(features(flat[i : i + STEP])) for i in range(0, len(flat), STEP)]
            h, logit = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            _, z = self.pooled(h, logit, np.cumsum([0, *(len(b) for b in bags[:-1])]))
            out[first:at] = sigmoid(z @ self.c + self.b[0])
        return out


def loss_and_gradients(m: Model, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The mean logistic loss of bags that begin at starts, and its gradients by hand through the output, the attention and the passage code."""
    sizes = np.diff([*starts, len(x)])
    h = np.tanh(x @ m.E + m.e)
    p, q = np.tanh(h @ m.V), sigmoid(h @ m.U)
    a, z = m.pooled(h, (p * q) @ m.w, starts)
    out = sigmoid(z @ m.c + m.b[0])
    err = (out - labels) / len(labels)
    dz = np.repeat(err[:, None] * m.c, sizes, axis=0)
    da = (dz * h).sum(axis=1)
    dl = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    dp, dq = dl[:, None] * m.w * q * (1 - p * p), dl[:, None] * m.w * p * q * (1 - q)
    dh = (a[:, None] * dz + dp @ m.V.T + dq @ m.U.T) * (1 - h * h)
    grads = {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dp, "U": h.T @ dq, "w": (p * q).T @ dl, "c": z.T @ err, "b": np.array([err.sum()])}
    loss = -np.mean(labels * np.log(np.maximum(out, 1e-300)) + (1 - labels) * np.log(np.maximum(1 - out, 1e-300)))
    return float(loss), grads


def fit(bags: list[np.ndarray], labels: np.ndarray, *, epochs: int = 30, least_steps: int = 1000, rate: float = 0.004, decay: float = 1e-4, batch: int = 64, seed: int = 1) -> Model:
    """Adam on the logistic loss. Few bags are gone over more often, for least_steps steps. No bags: an untrained model whose score is 0.5 throughout."""
    rng = np.random.default_rng(seed)
    m = Model.fresh(rng)
    if not bags:
        m.c[:] = 0
        return m
    m.b[0] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    names = list(m.__dataclass_fields__)
    epochs = max(epochs, -(-least_steps // -(-len(bags) // batch)))
    first, second, t = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            _, grads = loss_and_gradients(m, np.concatenate([bags[k] for k in own]), np.cumsum([0, *(len(bags[k]) for k in own[:-1])]), labels[own])
            t += 1
            step = rate * (1 - epoch / epochs)
            for k in names:
                g = grads[k] + (decay * getattr(m, k) if k not in ("e", "b") else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                setattr(m, k, getattr(m, k) - step * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8))
    return m


def held_out(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. Such rows are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, max_docs: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES, seed: int = 1) -> Model:
    """A model learned from the labels of rows that aren't held out, from all passages of each text.

    The sample: the labelled ids in the order of their hash, up to max_docs of them; each that fits into what is left of max_bytes of text is taken, one that doesn't is passed over, so a long text costs only itself and nothing over max_bytes
    is gathered. An id with several labels counts by their mean, rounded (half up); one with several texts by the least of them, so nothing depends on the order of rows. Null labels and ids are left out.
    """
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    chosen = known.withColumn("at", F.xxhash64("id")).orderBy("at", "id").limit(max_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = texts.select("id", F.octet_length("text").alias("n")).join(F.broadcast(chosen), "id").groupBy("at", "id").agg(F.max("n").alias("n")).collect()  # max_docs ids and numbers
    own = fitting([(r["id"], r["n"]) for r in sorted(sizes, key=lambda r: (r["at"], r["id"]))], max_bytes)
    if not own:
        return fit([], np.empty(0), seed=seed)
    within = docs.sparkSession.createDataFrame([(i,) for i in own], StructType([StructField("id", texts.schema["id"].dataType)]))
    got = texts.join(F.broadcast(within), "id").groupBy("id").agg(F.min("text").alias("text")).join(F.broadcast(known.join(F.broadcast(within), "id")), "id").collect()  # max_docs ids and max_bytes of text
    got.sort(key=lambda r: r["id"])
    return fit([bag(r["text"]) for r in got], np.array([r["y"] for r in got], float), seed=seed)


def fitting(sizes: list[tuple], room: int) -> list:
    """The ids of a list of (id, size) that are taken in order, each if it fits into what room the ones before have left."""
    out = []
    for i, n in sizes:
        if n <= room:
            out.append(i)
            room -= n
    return out


def score(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def mil_score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()))

    return mil_score(text)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", cut: float = CUT) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= cut).

    Only the text enters a score; null and empty texts are one empty passage. Without any usable label every score is 0.5. Null ids and repeated rows stay; other columns are not read; no rows give none.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= cut).cast("int"))
