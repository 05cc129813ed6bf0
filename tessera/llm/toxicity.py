"""Toxic spans by a linear-chain conditional random field.

Two states, clean and toxic. A token's potential sums the weights of its hashed features (the word without
outer punctuation, its first 3 to 6 bytes, its last 4), and neighbours share transition
potentials. Forward-backward marginals give each token's probability; a document's score is a logistic function of
its largest marginal and of the expected number of toxic tokens (marginals from 0.2 on), and tokens at 0.5 or more make the offending spans.

Tokens are labelled for training from labelled documents: all tokens of a clean document are clean, a token of a
toxic document is toxic if one of its features occurs in toxic documents far more often than in clean ones. The fit
uses at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents (those with the least hash of doc_id, one text for each id) of at most
``MAX_BYTES`` bytes together; this bounds the driver's memory. Scoring reads every text whole.

The recursions run over all tokens of a batch at once: a document's first token has a transition that forgets what
came before, so a batch is one chain; it is cut into blocks of ``BLOCK`` tokens, block products are
combined, and messages then run inside all blocks side by side. This gives the exact marginals.

Defined results: null, empty and blank texts get the score of no toxic token; repeated rows get equal
scores; without labels of both kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb

MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 1500, 2500, 32 << 20
THRESHOLD = 0.7
BUCKETS = 1 << 18
BLOCK = 64
EPOCHS = 12
#: Tokens of the training texts that are worked on at once.
SHARD = 1 << 18
DEPTH = 6

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[ord(c) for c in ".,;:!?\"'()[]{}|#$%&*+-=~^@_\\/<>`"]] = True
_KINDS = 6


def token_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(kinds, tokens) bucket numbers."""
    if not len(starts):
        return np.zeros((_KINDS, 0), np.int64)
    s, e = starts.copy(), ends.copy()
    for _ in range(4):
        move = (s < e - 1) & _EDGE[raw[s]]
        s += move
        move = (s < e - 1) & _EDGE[raw[e - 1]]
        e -= move
    pw, inv = tb.powers(len(raw) + 1)
    c = np.empty(len(raw) + 1, dtype=np.uint64)
    c[0] = 0
    np.cumsum((tb.LOWER[raw].astype(np.uint64) + np.uint64(1)) * pw[:-1], out=c[1:])
    out = []
    for k, (a, b) in enumerate([(s, e), *((s, np.minimum(e, s + n)) for n in (3, 4, 5, 6)), (np.maximum(s, e - 4), e)]):
        h = (c[b] - c[a]) * inv[a] + (b - a).astype(np.uint64)
        out.append((tb.mix(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) >> np.uint64(64 - 18)).astype(np.int64))
    return np.stack(out)


def _scan(m: list[np.ndarray], left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Normalised row vectors v_t = v_{t-1} M_t from (1/2, 1/2), for 2x2 matrices given by their four entries.

    With ``left`` false the chain runs over columns from the end: v_{t-1} = M_t v_t; entry t is then v_{t-1}.
    """
    n = len(m[0])
    if not left:
        a, b = _scan([x[::-1] for x in (m[0], m[2], m[1], m[3])], True)
        return a[::-1], b[::-1]
    nb = -(-n // BLOCK)
    pad = nb * BLOCK - n
    one, zero = np.ones(pad), np.zeros(pad)
    t = [np.ascontiguousarray(np.concatenate([x, z]).reshape(nb, BLOCK).T) for x, z in zip(m, (one, zero, zero, one), strict=True)]
    va, vb = np.empty((BLOCK, nb)), np.empty((BLOCK, nb))
    if nb == 1:
        a, b = np.array([0.5]), np.array([0.5])
    else:
        p00, p01, p10, p11 = np.ones(nb), np.zeros(nb), np.zeros(nb), np.ones(nb)
        for k in range(BLOCK):
            a00, a01, a10, a11 = t[0][k], t[1][k], t[2][k], t[3][k]
            p00, p01, p10, p11 = p00 * a00 + p01 * a10, p00 * a01 + p01 * a11, p10 * a00 + p11 * a10, p10 * a01 + p11 * a11
            z = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * z, p01 * z, p10 * z, p11 * z
        a, b = _scan([p00, p01, p10, p11], True)
        a, b = np.concatenate([[0.5], a[:-1]]), np.concatenate([[0.5], b[:-1]])
    for k in range(BLOCK):
        a, b = a * t[0][k] + b * t[2][k], a * t[1][k] + b * t[3][k]
        z = 1 / (a + b)
        a, b = a * z, b * z
        va[k], vb[k] = a, b
    return va.T.reshape(-1)[:n], vb.T.reshape(-1)[:n]


@dataclass
class Model:
    weights: np.ndarray  # of the buckets, for toxic against clean
    bias: float
    edges: np.ndarray  # 2 x 2 log potentials of transitions
    readout: np.ndarray  # logistic weights of 1, log-odds of the largest marginal, log of the expected count
    constant: float | None = None

    def marginals(self, feats: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of each token, and the expected transitions (4, tokens) into it; first marks the first token of a text."""
        w = np.exp(np.clip(self.bias + self.weights[feats].sum(axis=0), -30, 30))
        e = np.exp(self.edges)
        t00, t01, t10, t11 = (np.where(first, 1.0, e[i, j]) for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)))
        m = [t00, t01 * w, t10, t11 * w]
        fa, fb = _scan(m, True)
        ba, bb = _scan(m, False)  # entry t: message from t on to t - 1
        na, nb = np.append(ba[1:], 0.5), np.append(bb[1:], 0.5)
        p1 = fb * nb / (fa * na + fb * nb)
        pa_, pb_ = np.concatenate([[0.5], fa[:-1]]), np.concatenate([[0.5], fb[:-1]])
        pair = np.stack([pa_ * m[0] * na, pa_ * m[1] * nb, pb_ * m[2] * na, pb_ * m[3] * nb])
        pair /= pair.sum(axis=0)
        return p1, pair


#: Marginals below it are no part of the expected number of toxic tokens: many small ones would add up in a long clean text.
LEAST_COUNTED = 0.2


def _summary(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    most, total = np.zeros(n), np.bincount(row, weights=np.where(p >= LEAST_COUNTED, p, 0), minlength=n)
    np.maximum.at(most, row, p)
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(n), np.log(most / (1 - most)), np.log(total + 1e-3)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _copy_weights(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """1 / (texts with the same least 3-word shingle hash), so that copies count about once."""
    key = np.zeros(len(off) - 1, dtype=np.uint64)
    for i, j, r, o in tb.slices(raw, off):
        s, e, row = tb.words(r, o)
        h, hr = tb.shingle_hashes(tb.span_hashes(r, s, e), row, 3)
        if len(h):
            at = np.flatnonzero(np.append(True, hr[1:] != hr[:-1]))
            key[i + hr[at]] = np.minimum.reduceat(h, at)
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    return 1 / n[at]


def _label_tokens(feats: np.ndarray, row: np.ndarray, toxic: np.ndarray, weight: np.ndarray, least: float = 3.0) -> np.ndarray:
    """Which tokens of toxic documents are toxic.

    Features with a log-odds of ``least`` or more are taken one by one, always the one that occurs in most
    toxic documents (copies counted once) that have fewer than ``DEPTH`` chosen features so far, until none occurs in
    three more. What copies of one toxic text share is thus left out once its insults are known.
    """
    d = len(toxic)
    w1, w0 = weight[toxic].sum(), weight[~toxic].sum()
    pairs_f, pairs_d = [], []
    for k in range(_KINDS):
        pair = np.sort(feats[k].astype(np.int64) * d + row)
        pair = pair[np.append(True, pair[1:] != pair[:-1])]
        b, doc = pair // d, pair % d
        t = toxic[doc]
        c1 = np.bincount(b[t], weights=weight[doc[t]], minlength=BUCKETS)
        c0 = np.bincount(b[~t], weights=weight[doc[~t]], minlength=BUCKETS)
        good = (np.log((c1 + 0.1) / (w1 + 1)) - np.log((c0 + 0.3) / (w0 + 1)) >= least) & (c1 >= 2.5)
        use = t & good[b]
        pairs_f.append(b[use] + k * BUCKETS)
        pairs_d.append(doc[use])
    f, doc = np.concatenate(pairs_f), np.concatenate(pairs_d)
    chosen = np.zeros(_KINDS * BUCKETS, dtype=bool)
    names, f = np.unique(f, return_inverse=True)
    by_f = np.split(doc[np.argsort(f, kind="stable")], np.cumsum(np.bincount(f, minlength=len(names)))[:-1]) if len(names) else []
    need = np.full(d, DEPTH)
    while len(names):
        gain = np.bincount(f, weights=weight[doc] * (need[doc] > 0), minlength=len(names))
        best = int(gain.argmax())
        if gain[best] < 2.5:
            break
        chosen[names[best]] = True
        need[by_f[best]] -= 1
        keep = f != best
        f, doc = f[keep], doc[keep]
    y = np.zeros(len(row), dtype=bool)
    for k in range(_KINDS):
        y |= chosen[k * BUCKETS + feats[k]]
    return y & toxic[row]


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """The model of labelled documents."""
    toxic = np.asarray(toxic, dtype=bool)
    zero = Model(np.zeros(BUCKETS), -4.0, np.zeros((2, 2)), np.zeros(3))
    if not len(toxic) or toxic.all() or not toxic.any():
        zero.constant = float(toxic.mean()) if len(toxic) else 0.0
        return zero
    raw, off = tb.text_bytes(pa.array(texts, pa.large_string()))
    feats, rows = [], []
    for i, _, r, o in tb.slices(raw, off):
        s, e, row = tb.words(r, o)
        feats.append(token_features(r, s, e).astype(np.int32))
        rows.append(row + i)
    feats, row = np.concatenate(feats, axis=1), np.concatenate(rows)
    n, d = len(row), len(texts)
    first = np.ones(n, dtype=bool)
    first[1:] = row[1:] != row[:-1]
    y = _label_tokens(feats, row, toxic, _copy_weights(raw, off))
    model = zero
    # gradient ascent on the log-likelihood of the labelled tokens, with adaptive steps
    sq = np.full(BUCKETS, 1e-8)
    sq_b, sq_e = 1e-8, np.full((2, 2), 1e-8)
    prev = np.concatenate([[False], y[:-1]])
    seen = np.array([[np.sum(~first & (prev == i) & (y == j)) for j in (0, 1)] for i in (0, 1)], dtype=float)
    starts = np.flatnonzero(first)
    at = np.searchsorted(starts, np.arange(0, n, SHARD))
    cuts = np.unique(np.append(starts[at[at < len(starts)]], n))
    shards = [slice(x, y_) for x, y_ in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    for epoch in range(EPOCHS):
        g, gb, met = np.zeros(BUCKETS), 0.0, np.zeros(4)
        for part in shards:  # whole texts; bounds the memory of the messages
            p, pair = model.marginals(feats[:, part], first[part])
            g_tok = y[part] - p
            for k in range(_KINDS):
                g += np.bincount(feats[k, part], weights=g_tok, minlength=BUCKETS)
            gb += g_tok.sum()
            met += pair[:, ~first[part]].sum(axis=1)
        g -= 0.05 * model.weights
        step = 0.6 / (1 + 0.05 * epoch)
        sq += g * g
        model.weights += step * g / np.sqrt(sq) * (np.abs(g) > 1e-3)
        sq_b += gb * gb
        model.bias += step * gb / np.sqrt(sq_b)
        ge = seen - met.reshape(2, 2) - 0.1 * model.edges
        sq_e += ge * ge
        model.edges += 0.3 * step * ge / np.sqrt(sq_e)
    p = np.concatenate([model.marginals(feats[:, part], first[part])[0] for part in shards])
    x = _summary(p, row, d)
    scale = np.array([1, 5, 3])
    x = x / scale
    w = np.zeros(3)
    for _ in range(60):  # ridge logistic regression by Newton's method
        q = _sigmoid(x @ w)
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(3)
        w += np.linalg.solve(h, x.T @ (toxic - q) - 1e-2 * w)
    model.readout = w / scale
    return model


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1


def labelled_texts(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int, max_bytes: int) -> tuple[list[str], np.ndarray]:
    """(texts, toxic) of the sample that is fitted: ids by least hash, one text for each, as long as they fit.

    Ids and sizes are found first, then the texts that fit are sent; either is one parallel pass over (doc_id, text), and the
    driver holds at most the bytes asked for.
    """
    spark = docs.sparkSession
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda y, n: labels.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    kind = {r[0]: r[1] for r in [*pick(1, max_toxic).collect(), *pick(0, max_clean).collect()]}
    if not kind:
        return [], np.zeros(0, dtype=bool)
    ids = F.broadcast(spark.createDataFrame([(i,) for i in kind], "doc_id long"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    own = rows.join(ids, "doc_id").groupBy("doc_id").agg(F.min(F.struct("mark", F.octet_length("text").alias("size"))).alias("least"))
    sizes = own.select("doc_id", "least.mark", "least.size").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    chosen, total = [], 0
    for i, mark, size in sizes:
        if total + size <= max_bytes:
            total += size
            chosen.append((i, mark))
    if not chosen:
        return [], np.zeros(0, dtype=bool)
    wanted = F.broadcast(spark.createDataFrame(chosen, "doc_id long, mark long"))
    texts = dict(rows.join(wanted, ["doc_id", "mark"]).groupBy("doc_id").agg(F.min("text")).collect())
    order = [i for i, _ in chosen if i in texts]
    return [texts[i] for i in order], np.array([kind[i] == 1 for i in order], dtype=bool)


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES) -> Model:
    """labels: (doc_id, toxic), training rows only."""
    return train(*labelled_texts(docs, labels, max_toxic, max_clean, max_bytes))


_TAGGED = "struct<score: double, spans: array<struct<start: bigint, end: bigint, p: double>>>"


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """docs' columns, score, and spans: code point offsets [start, end) and largest marginal of each toxic run of tokens."""
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def each(r, o):
        n = len(o) - 1
        score, spans = np.full(n, model.constant or 0.0), [[] for _ in range(n)]
        if model.constant is None:
            s, e, row = tb.words(r, o)
            first = np.ones(len(row), dtype=bool)
            first[1:] = row[1:] != row[:-1]
            p = model.marginals(token_features(r, s, e), first)[0] if len(row) else np.zeros(0)
            score = _sigmoid(_summary(p, row, n) @ model.readout)
            bad = p >= 0.5
            if bad.any():
                point = np.cumsum((r & 0xC0) != 0x80)
                begin = np.flatnonzero(bad & (first | ~np.concatenate([[False], bad[:-1]])))
                stop = np.flatnonzero(bad & np.append(first[1:] | ~bad[1:], True))
                top = np.maximum.reduceat(np.append(p, 0), np.stack([begin, stop + 1], 1).ravel())[::2]
                base = np.concatenate([[0], point])[o]
                for x, y, m in zip(begin.tolist(), stop.tolist(), top.tolist(), strict=True):
                    q = row[x]
                    spans[q].append({"start": int(point[s[x]] - 1 - base[q]), "end": int(point[e[y] - 1] - base[q]), "p": m})
        return pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(spans, arrow)], names=["score", "spans"])

    found = tb.fresh(docs, "tagged")
    others = [c for c in docs.columns if c not in ("score", "spans")]
    rows = tb.small_batches(docs).withColumn(found, tb.of_texts(each, _TAGGED, F.col("text")))
    return rows.select(*others, F.col(found)["score"].alias("score"), F.col(found)["spans"].alias("spans"))
