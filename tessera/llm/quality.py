"""Quality classifier by positive-unlabelled learning.

A linear score over text statistics minimises the non-negative unbiased risk with squared loss
``l(z) = (1 - z)**2 / 4``::

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

P are trusted positives, U is the text of all documents (its labels unseen), and the class prior is
estimated from the labelled training rows. For this loss the risk depends on the data only through first
and second moments, so every document is counted: each task sends one matrix of a fixed size, these
are summed in two rounds, and the driver minimises over the sums. Where the negative part falls below zero
its own gradient is climbed instead (the non-negative correction).

Positives are at most ``max_positives`` labelled rows, those with the least hash of doc_id; their ids are all that is
broadcast. Texts are read whole; label, language, source and id are no inputs of a score.

Defined results: null and empty texts are scored like any other (all statistics 0); repeated rows get
equal scores; without positives, or without documents, the score is the prior (0.5 if there is none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb

MAX_POSITIVES = 20_000
THRESHOLD = 0.3
RIDGE = 1e-4
#: Steps at which a share counts as passed.
STEPS = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7)
SUM_TASKS = 16

_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[10] = 5
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 6
_CLASS[ord("!")] = 7
_CLASS[ord("|")] = 8
_CLASS[[ord(c) for c in "#$%&*+=~^@_\\/<>[]{}`"]] = 9
_CLASS[128:] = 10
_CLASS[:9] = 11
_CLASSES = 12


def shares(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Statistics of each text, all in [0, 1]."""
    n = len(off) - 1
    size = np.maximum(off[1:] - off[:-1], 1).astype(float)
    row = np.repeat(np.arange(n), off[1:] - off[:-1])
    kinds = np.bincount(row * _CLASSES + _CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES)
    starts, ends, wrow = tb.words(raw, off)
    nw = np.bincount(wrow, minlength=n)
    per = np.maximum(nw, 1).astype(float)
    h = tb.span_hashes(raw, starts, ends)
    length = ends - starts
    count = lambda mask: np.bincount(wrow[mask], minlength=n)
    first, last = (raw[starts], raw[ends - 1]) if len(starts) else (raw[:0], raw[:0])
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    key = h ^ tb.mix(wrow.astype(np.uint64) + np.uint64(1))
    sole, at, times = np.unique(key, return_index=True, return_counts=True)
    distinct = np.bincount(wrow[at], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, wrow[at], times)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 10], 1)
    odd = _CLASS[last] == 9
    cols = [kinds[:, k] / size for k in range(1, _CLASSES)]
    cols += [
        kinds[:, 2] / letters,
        count(again) / per,
        1 - distinct / per,
        top / per,
        count(length <= 2) / per,
        count(length >= 12) / per,
        count(odd) / per,
        count((last == ord("!"))) / per,
        count((length == 1) & (first == ord("|"))) / per,
        count((first >= 65) & (first < 91)) / per,
        np.minimum(np.log1p(nw) / 10, 1),
        np.minimum(kinds[:, 5] / per, 1),
        (nw == 0).astype(float),
    ]
    return np.stack(cols, axis=1)


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    x = shares(raw, off)
    steps = [np.clip((x - s) / s, 0, 1) for s in STEPS]
    return np.concatenate([np.ones((len(x), 1)), x, np.sqrt(x), *steps], axis=1)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def _moments(docs: DataFrame, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x x^T over all documents and over the positives; x starts with 1."""
    ids = np.sort(positives)

    def each(batches):
        u = p = 0.0
        for b in batches:
            doc = b.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            known = ~np.asarray(b.column(0).is_null())
            raw, off = tb.text_bytes(b.column(1))
            for i, j, r, o in tb.slices(raw, off):
                x = features(r, o)
                u = u + x.T @ x
                at = np.searchsorted(ids, doc[i:j])
                mine = known[i:j] & (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == doc[i:j]) if len(ids) else np.zeros(j - i, bool)
                p = p + x[mine].T @ x[mine]
        if not np.isscalar(u):
            import pyspark

            part = pyspark.TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part % SUM_TASKS], pa.int32()), pa.array([np.stack([u, p]).tobytes()], pa.binary())], names=["bucket", "sums"])

    def total(batches):
        s = 0.0
        for b in batches:
            for v in b.column(1).to_pylist():
                s = s + np.frombuffer(v, dtype=float)
        if not np.isscalar(s):
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([s.tobytes()], pa.binary())], names=["bucket", "sums"])

    schema = "bucket int, sums binary"
    rows = tb.small_batches(docs).select("doc_id", "text").mapInArrow(each, schema).repartition(SUM_TASKS, "bucket").mapInArrow(total, schema).collect()
    d = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    s = sum((np.frombuffer(r["sums"], dtype=float) for r in rows), np.zeros(2 * d * d)).reshape(2, d, d)
    return s[0], s[1]


def fit(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, rounds: int = 400) -> np.ndarray:
    """Weights of the score; labels has (doc_id, quality), training rows only."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    seen = labels.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("quality") == 1).cast("long")).alias("p")).first()
    prior = (seen["p"] or 0) / seen["n"] if seen["n"] else 0.5
    chosen = labels.where("quality = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives)
    ids = np.array([r[0] for r in chosen.collect()], dtype=np.int64)
    u, p = _moments(docs, ids)
    n_u, n_p = u[0, 0], p[0, 0]
    d = len(u)
    w = np.zeros(d)
    w[0] = 2 * prior - 1
    if not n_u or not n_p:
        return w
    u, p = u / n_u, p / n_p
    scale = np.sqrt(np.maximum(np.diag(u), 1e-12))
    u, p = u / np.outer(scale, scale), p / np.outer(scale, scale)
    mu, mp = u[0] * 1.0, p[0] * 1.0  # scale[0] is 1
    ridge = RIDGE * np.eye(d)
    ridge[0, 0] = 0
    pre = np.linalg.inv(u + ridge + 1e-9 * np.eye(d))

    def part(sign: float, m1: np.ndarray, m2: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
        """E[l(sign * f)] and its gradient."""
        return (1 - 2 * sign * (m1 @ v) + v @ m2 @ v) / 4, (m2 @ v - sign * m1) / 2

    v = w * scale
    for _ in range(rounds):
        pos, g_pos = part(1, mp, p, v)
        neg_u, g_u = part(-1, mu, u, v)
        neg_p, g_p = part(-1, mp, p, v)
        if neg_u - prior * neg_p >= 0:
            v = v - 0.5 * pre @ (prior * g_pos + g_u - prior * g_p + ridge @ v)
        else:
            v = v + 0.25 * pre @ (g_u - prior * g_p)
    return v / scale


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """docs' columns and the score: the linear score f, as (1 + f) / 2 within [0, 1]. Only texts go to Python, only scores come back."""

    def each(raw, off):
        return pa.array(np.clip((1 + features(raw, off) @ weights) / 2, 0, 1))

    return tb.small_batches(docs).withColumn(name, tb.of_texts(each, "double", F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_positives: int = MAX_POSITIVES) -> DataFrame:
    """(doc_id, text, score, predicted), learnt from the given label rows."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels, max_positives))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
