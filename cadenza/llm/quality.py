"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed 1-, 2- and 3-grams of word shapes. The shape of a word is its run
of character classes (lower, upper, digit, each ASCII sign; letters beyond ASCII count as lower
case) with repeats collapsed, marked if the word equals the one before it. Counts are damped
(log), weighted by the inverse document frequency over *all* documents, and L2-normalised. A
truncated SVD of a bounded sample of labelled rows (LABELLED of them, least hash of the id first,
training folds only) gives the latent space; the sample's vectors and labels are broadcast. Every
document is compared with all of them by blocked matrix products (exact cosines), and its score is
the similarity-weighted mean label of its NEIGHBOURS nearest (ties at the last place included).

Defined cases: null and empty texts have no words and score the sample's mean label; a labelled
row without document, id or label is left out; a document with several labels gets their mean;
without any label every score is 0.5. Rows pass through with all their columns, repeated rows and
clashing names included (the score's column is named by the caller).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cadenza.llm.common import fresh

DIMS = 2048
LATENT = 64
LABELLED = 6000
NEIGHBOURS = 25
SHARPNESS = 4
FOLDS = 5
THRESHOLD = 0.3
#: Bytes of text that are turned into features at once, and documents scored at once.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 512

_rng = np.random.RandomState(12345)
_SHAPE = _rng.randint(1, 1 << 62, size=(256, 32), dtype=np.int64).astype(np.uint64)
_BYTES = _rng.randint(1, 1 << 62, size=(256, 64), dtype=np.int64).astype(np.uint64)
_REPEAT, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _classes() -> np.ndarray:
    c = np.arange(256, dtype=np.uint8)
    c[ord("a"):ord("z") + 1] = ord("a")
    c[ord("A"):ord("Z") + 1] = ord("A")
    c[ord("0"):ord("9") + 1] = ord("0")
    c[128:] = ord("a")
    c[[9, 10, 11, 12, 13]] = ord(" ")
    return c


_CLASS = _classes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _block_counts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])  # the separator ends each text's last word
    cls = _CLASS[raw]
    blank = cls == ord(" ")
    first = ~blank & np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(first)
    if not len(starts):
        return [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(texts)
    inside = np.flatnonzero(~blank)
    word = np.cumsum(first)[inside] - 1
    at = inside - starts[word]
    cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    exact = np.add.reduceat(_BYTES[raw[inside], np.minimum(at, 63)], cut)
    c = cls[inside]
    new = np.concatenate(([True], c[1:] != c[:-1])) | (at == 0)
    turn = np.cumsum(new)
    nth = turn - turn[cut][word]
    shape = np.add.reduceat(np.where(new, _SHAPE[c, np.minimum(nth, 31)], np.uint64(0)), cut)
    doc = np.searchsorted(ends, starts, side="right")
    again = np.concatenate(([False], (exact[1:] == exact[:-1]) & (doc[1:] == doc[:-1])))
    s = _mix(shape + again.astype(np.uint64) * _REPEAT)
    grams, where = [s], [doc]
    for n in (2, 3):
        if len(s) >= n:
            g = s[: len(s) - n + 1]
            for j in range(1, n):
                g = _mix(g * np.uint64(3) + s[j: len(s) - n + 1 + j])
            ok = doc[: len(g)] == doc[n - 1:]
            grams.append(g[ok])
            where.append(doc[: len(g)][ok])
    key = np.concatenate(where) * DIMS + (np.concatenate(grams) % np.uint64(DIMS)).astype(np.int64)
    keys, counts = np.unique(key, return_counts=True)
    cuts = np.searchsorted(keys // DIMS, np.arange(len(texts) + 1))
    return [(keys[a:b] % DIMS, counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def text_counts(texts):
    """(buckets, counts) for each text (null: empty), a block of about BLOCK_BYTES at a time."""
    block, size = [], 0
    for t in texts:
        b = (t or "").encode()
        block.append(b)
        size += len(b)
        if size >= BLOCK_BYTES or len(block) >= BLOCK_DOCS:
            yield from _block_counts(block)
            block, size = [], 0
    if block:
        yield from _block_counts(block)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray  # DIMS x latent
    refs: np.ndarray  # rows x latent, normalised
    labels: np.ndarray
    prior: float

    def vectors(self, counts) -> np.ndarray:
        x = np.zeros((len(counts), DIMS), np.float32)
        for i, (k, n) in enumerate(counts):
            x[i, k] = np.log1p(n) * self.idf[k]
        return _unit(_unit(x) @ self.basis)

    def scores(self, texts) -> np.ndarray:
        out, counts = [], list(text_counts(texts))
        for a in range(0, len(counts), BLOCK_DOCS):
            v = self.vectors(counts[a:a + BLOCK_DOCS])
            out.append(self._vote(v))
        return np.concatenate(out) if out else np.empty(0)

    def _vote(self, v: np.ndarray) -> np.ndarray:
        score = np.full(len(v), self.prior)
        known = np.abs(v).sum(axis=1) > 0
        if not len(self.refs) or not known.any():
            return score
        sim = v[known] @ self.refs.T
        k = min(NEIGHBOURS, sim.shape[1])
        last = np.partition(sim, sim.shape[1] - k, axis=1)[:, sim.shape[1] - k][:, None]
        w = np.where(sim >= last, np.maximum(sim, 1e-6), 0).astype(np.float64) ** SHARPNESS
        score[known] = np.clip((w @ self.labels) / w.sum(axis=1), 0, 1)
        return score


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(n > 0, n, 1)).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo FOLDS, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """Documents, and documents per bucket, over all rows: one partial sum per task, then a sum per bucket."""
    def partial(batches):
        n, df = 0, np.zeros(DIMS, np.int64)
        for b in batches:
            for k, _ in text_counts(b.column(0).to_pylist()):
                df[k] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMS), -1)), pa.array(np.append(df, n))], ["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(partial, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    got = {r[0]: r[1] for r in rows}
    return got.get(-1, 0), np.array([got.get(k, 0) for k in range(DIMS)], np.float64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", labelled: int = LABELLED, latent: int = LATENT) -> Model:
    """Learns from at most ``labelled`` labelled rows outside the held-out fold; the document
    frequencies are those of all documents."""
    n, df = document_frequencies(docs, text_col)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col)).alias("y"))
    known = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(labelled))  # at most `labelled` rows

    def sparse(batches):
        for b in batches:
            ks = [k.astype(np.int32).tobytes() + c.astype(np.int32).tobytes() for k, c in text_counts(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(ks, pa.binary())], ["id", "y", "x"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id").select("id", "y", "text")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = d.mapInArrow(sparse, f"id {id_type}, y double, x binary").groupBy("id").agg(F.max("y").alias("y"), F.max("x").alias("x"))
    rows = sorted(rows.collect(), key=lambda r: r["id"])  # at most `labelled` sparse vectors
    y = np.array([r["y"] for r in rows], np.float64)
    prior = float(y.mean()) if len(y) else 0.5
    model = Model(idf, np.zeros((DIMS, 0), np.float32), np.zeros((0, 0), np.float32), y, prior)
    if not rows:
        return model
    x = np.zeros((len(rows), DIMS), np.float32)
    for i, r in enumerate(rows):
        k, c = np.frombuffer(r["x"], np.int32).reshape(2, -1)
        x[i, k] = np.log1p(c) * idf[k]
    model.basis = _truncated_basis(_unit(x), latent)
    model.refs = _unit(_unit(x) @ model.basis)
    return model


def _truncated_basis(x: np.ndarray, rank: int, rounds: int = 5) -> np.ndarray:
    """Leading right singular vectors of the bounded sample, by subspace iteration from a fixed start."""
    rank = min(rank, *x.shape)
    q = np.random.RandomState(7).standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :rank].astype(np.float32)


def score(docs: DataFrame, model: Model, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a score column. The model is broadcast; its size depends on LABELLED and LATENT alone."""
    if score_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {score_col}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for b in batches:
            s = shared.value.scores(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with their columns."""
    s, = fresh(docs, "__score")
    return score(docs, model, s, text_col).filter(F.col(s) >= threshold).drop(s)
