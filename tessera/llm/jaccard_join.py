"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, exact for any data.

Two documents link when their sets have ``100 * |intersection| >= 85 * |union|``. Equal sets are one class from the
start; copies are never expanded.

* Light: a set of at most ``B`` shingles enumerates its subsets of every fixed size that an
  intersection can have. Two light sets link only if they share such a subset.
* Heavy: a larger set of size s puts its ``s - ceil(0.85 s) + c`` least shingles (by hash) on inverted lists, with
  ``c = 1 + s // 10``. Linked sets share at least c of them (of the smaller set), so sets with fewer shared ones are done.
* B is the size where enumeration stops being cheaper than the lists, from the sizes found; sets near B do both.

Sets that are left keep their rarest lists only: as many of the commonest as c - 1 can go without losing a link. Sets
connected by the lists that remain make blocks. Chance lists chain unrelated sets to blocks that grow with the input, so a block above ``PART_ROWS`` or
``PART_BYTES`` is first cut into the blocks that its sketches connect: a sketch has about a bit for each shingle, the parity of the
shingles that fall on it, so no more bits of two sketches differ than shingles of their sets, and no link is lost. A block's sets meet in one task and all pairs are decided there by
exact intersection sizes; one that is still large is split into parts and each pair of parts is a
task, so no group is held whole. Where it costs fewer transfers of sets, the lists of a large and sparse block are taken one by one instead (split the same
way): sets that only hang together by a chain of lists then never meet, and a pair counts at the least of the lists that it shares.
Tasks return a forest and numbers of links, not pairs.

Shingles are 64-bit hashes; classes are 128-bit sums of them, and so are the ends of links. (Lists carry the first half; where two classes
had the same, neither would lose a list that it needs.) Documents without words have an empty set, link with nothing
and are their own component. Null texts are empty; rows with equal doc_id are documents of their own that share the
smallest id of their component; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm import textbatch as tb
from tessera.llm.graph import components
from tessera.llm.storage import stored

WORDS = 4
PERCENT = 85
PART_ROWS, PART_BYTES = 2000, 12 << 20
#: Parts that sketches are held against each other in, and bits of the shortest sketch.
SKETCH_ROWS, SKETCH_BYTES, SKETCH_BITS = 16_384, 4 << 20, 128
#: Pairs of sketches compared at once.
CELLS = 1 << 18
#: A block in which at least this share of all pairs is near is taken whole: its lists would be as long as itself.
DENSE = 0.125
#: Cost of one entry of an inverted list against one enumerated subset: its list is read and counted.
LIST_COST = 4.0
MOST_LIGHT = 20


def least_common(s: int, percent: int = PERCENT) -> int:
    """Least intersection of a set of s shingles with a set that it links to."""
    return -(-percent * s // 100)


def listed(s: int, percent: int = PERCENT) -> int:
    return s - least_common(s, percent) + 1 + s // 10


def needed(s: int, percent: int = PERCENT) -> int:
    """Listed shingles shared with any linked set: c of the smallest that can link."""
    return 1 + least_common(s, percent) // 10


def light_bound(counts: dict[int, int], percent: int = PERCENT) -> int:
    """B with the least total cost for the given numbers of sets of each size."""
    enum = lambda s: sum(comb(s, i) for i in range(least_common(s, percent), s + 1))

    def cost(b: int) -> float:
        return sum(n * (enum(s) * (s <= b) + LIST_COST * listed(s, percent) * (100 * s > percent * b)) for s, n in counts.items())

    return min(range(MOST_LIGHT + 1), key=cost)


def sets_of(raw: np.ndarray, off: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, offsets)."""
    s, e, row = tb.words(raw, off)
    h, r = tb.shingle_hashes(tb.span_hashes(raw, s, e), row, k)
    edge = np.searchsorted(r, np.arange(len(off)))
    parts = [np.unique(h[edge[i] : edge[i + 1]]) for i in range(len(off) - 1)]
    return (np.concatenate(parts) if parts else h), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _signatures(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tb.mix(h ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(tb.mix(c[off[1:]] - c[off[:-1]] + (off[1:] - off[:-1]).astype(np.uint64)))
    return out[0], out[1]


def sketches(h: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Of each set, bits at the low digits of its hashes, each the parity of the hashes there; as many as it has shingles, rounded up to a power of 2.

    As many bits of two sketches differ as shingles of their sets, or fewer; also if the longer one is folded (its halves xored).
    """
    size = np.diff(off)
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    edge = np.concatenate([[0], np.cumsum(bits)])
    at = tb.mix(h ^ np.uint64(0xA0761D6478BD642F)) & np.repeat(bits - 1, size).astype(np.uint64)
    odd = np.bincount(at.astype(np.int64) + np.repeat(edge[:-1], size), minlength=int(edge[-1])) & 1
    data = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [data[x // 8 : y // 8] if n else b"" for x, y, n in zip(edge[:-1].tolist(), edge[1:].tolist(), size.tolist(), strict=True)]


def _classes(k: int):
    def each(batches):
        for b in batches:
            raw, off = tb.text_bytes(b.column(2))
            for i, j, r, o in tb.slices(raw, off):
                h, e = sets_of(r, o, k)
                s1, s2 = _signatures(h, e)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(np.diff(e)), pa.array(tb.as_long(s1)), pa.array(tb.as_long(s2)), pa.array(sketches(h, e), pa.binary())], names=["rid", "doc_id", "n", "s1", "s2", "sketch"])

    return each


def _postings(k: int, percent: int, bound: int):
    """(key, s1, need, light); sets met before in the task are left out."""

    def each(batches):
        seen: set[int] = set()
        for b in batches:
            raw, off = tb.text_bytes(b.column(0))
            for _, _, r, o in tb.slices(raw, off):
                h, e = sets_of(r, o, k)
                s1, _ = _signatures(h, e)
                key, sig, need, light = [], [], [], []
                for i, (s, name) in enumerate(zip(np.diff(e).tolist(), tb.as_long(s1).tolist(), strict=True)):
                    if not s or name in seen:
                        continue
                    if len(seen) < 200_000:
                        seen.add(name)
                    own = h[e[i] : e[i + 1]]
                    if s <= bound:
                        m = tb.mix(own ^ np.uint64(0xD1B54A32D192ED03))
                        total = int(m.sum(dtype=np.uint64))
                        subs = [(total - sum(gone)) * 0x9E3779B97F4A7C15 + s - d for d in range(s - least_common(s, percent) + 1) for gone in combinations(m.tolist(), d)]
                        subs = tb.mix(np.array([x % (1 << 64) for x in subs], dtype=np.uint64))
                        key.append(subs)
                        sig.append(np.full(len(subs), name))
                        need.append(np.full(len(subs), 1, np.int32))
                        light.append(np.ones(len(subs), bool))
                    if 100 * s > percent * bound:
                        first = own[: listed(s, percent)]
                        key.append(first)
                        sig.append(np.full(len(first), name))
                        need.append(np.full(len(first), needed(s, percent), np.int32))
                        light.append(np.zeros(len(first), bool))
                if key:
                    yield pa.RecordBatch.from_arrays([pa.array(tb.as_long(np.concatenate(key))), pa.array(np.concatenate(sig)), pa.array(np.concatenate(need)), pa.array(np.concatenate(light))], names=["key", "s1", "need", "light"])

    return each


def _shared(batches):
    """Distinct (key, s1) rows, sorted by both, whose key has another s1."""
    held, matched = None, False
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.Table.from_batches([x for x in (held, b) if x is not None]).combine_chunks().to_batches()[0]
        key, sig = b.column(0).to_numpy(), b.column(1).to_numpy()
        new = np.append(True, (key[1:] != key[:-1]) | (sig[1:] != sig[:-1]))
        b = b.filter(pa.array(new))
        key = key[new]
        same = key[1:] == key[:-1]
        hit = np.zeros(len(key), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        hit[0] |= matched
        matched = bool(hit[-1])
        out = b.slice(0, b.num_rows - 1).filter(pa.array(hit[:-1]))
        held = b.slice(b.num_rows - 1)
        if out.num_rows:
            yield out
    if held is not None and matched:
        yield held


def _set_rows(k: int):
    """Replaces text by the set, as bytes; rows whose text is of another class than its row says are left out."""

    def each(batches):
        for b in batches:
            at = b.schema.get_field_index
            raw, off = tb.text_bytes(b.column(at("text")))
            for i, j, r, o in tb.slices(raw, off):
                h, e = sets_of(r, o, k)
                data = h.tobytes()
                sets = pa.array([data[8 * x : 8 * y] for x, y in zip(e[:-1], e[1:], strict=True)], pa.binary())
                own = np.ones(j - i, dtype=bool)
                for name, s in zip(("s1", "s2"), _signatures(h, e), strict=True):
                    own &= b.column(at(name)).slice(i, j - i).to_numpy() == tb.as_long(s)
                yield pa.RecordBatch.from_arrays([sets if c == at("text") else b.column(c).slice(i, j - i) for c in range(b.num_columns)], names=b.schema.names).filter(pa.array(own))

    return each


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """|A & B| for A of rows ``left`` and B of rows ``right``: matrix products, or counts along lists where these are short."""
    size = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.append(True, flat[1:] != flat[:-1])
    token = np.cumsum(new) - 1
    df = np.bincount(token)
    use = df[token] > 1
    token, row = token[use], row[use]
    _, token = np.unique(token, return_inverse=True)
    n_tokens = int(token[-1]) + 1 if len(token) else 0
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not n_tokens:
        return out
    df = np.bincount(token)
    at_l, at_r = np.full(len(sets), -1), np.full(len(sets), -1)
    at_l[left], at_r[right] = np.arange(len(left)), np.arange(len(right))
    if float(len(left)) * len(right) * n_tokens <= 64.0 * float((df.astype(float) ** 2).sum()) + 1e6:
        for a in range(0, n_tokens, 4096):
            x, y = np.searchsorted(token, [a, a + 4096])
            width = min(4096, n_tokens - a)
            m = np.zeros((len(sets), width), dtype=np.float32)
            m[row[x:y], token[x:y] - a] = 1
            out += m[left] @ m[right].T
        return out
    start = np.concatenate([[0], np.cumsum(df)])
    by_row = np.argsort(row, kind="stable")
    edge = np.searchsorted(row[by_row], np.arange(len(sets) + 1))
    for i, r in enumerate(left):
        t = token[by_row[edge[r] : edge[r + 1]]]
        n = df[t]
        at = np.repeat(start[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        other = at_r[row[at]]
        out[i] += np.bincount(other[other >= 0], minlength=len(right))
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row of each row's component."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _near_pairs(n: np.ndarray, sketch: list[bytes], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(least row that is connected to each row, number of near rows that are not smaller): near is what the sketches do not rule out as linked."""
    root, near = np.arange(len(n)), np.zeros(len(n), dtype=np.int64)
    width = np.array([len(x) // 8 for x in sketch])
    words = {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        words[w] = at, np.frombuffer(b"".join(sketch[x] for x in at.tolist()), dtype=np.uint64).reshape(len(at), w)

    def rows(side: np.ndarray, w: int, folded: bool) -> tuple[np.ndarray, np.ndarray]:
        at, x = words.get(w, (np.zeros(0, np.int64), np.zeros((0, w), np.uint64)))
        own = np.isin(at, side)
        if folded and 2 * w in words:
            more, y = words[2 * w]
            also = np.isin(more, side)
            at, x = np.concatenate([at[own], more[also]]), np.concatenate([x[own], y[also, :w] ^ y[also, w:]])
        else:
            at, x = at[own], x[own]
        order = np.argsort(n[at], kind="stable")
        return at[order], np.ascontiguousarray(x[order].T)

    for w in words:
        for a, b in ((left, right),) if left is right else ((left, right), (right, left)):
            at_a, x = rows(a, w, False)
            at_b, y = rows(b, w, True)
            size_b, i = n[at_b], 0
            while i < len(at_a):
                lo = int(np.searchsorted(size_b, n[at_a[i]]))
                j = min(len(at_a), i + max(1, CELLS // max(1, int(np.searchsorted(size_b, 100 * n[at_a[i]] // percent, side="right")) - lo)))
                hi = int(np.searchsorted(size_b, 100 * n[at_a[j - 1]] // percent, side="right"))
                if hi > lo:
                    apart = np.zeros((j - i, hi - lo), dtype=np.int32)
                    for v in range(w):
                        apart += np.bitwise_count(x[v, i:j, None] ^ y[v, None, lo:hi])
                    ok = apart * (100 + percent) <= (n[at_a[i:j], None] + size_b[None, lo:hi]) * (100 - percent)
                    ok &= size_b[None, lo:hi] >= n[at_a[i:j], None]
                    near[at_a[i:j]] += ok.sum(axis=1)
                    ok &= root[at_a[i:j], None] != root[None, at_b[lo:hi]]
                    p, q = np.nonzero(ok)
                    if len(p):
                        root = _roots(len(n), root[at_a[i + p]], root[at_b[lo + q]])[root]
                i = j
    return root, near


def _near(percent: int):
    """(s1, s1 of a set that it is connected to, number of near sets); rows come sorted by task."""

    def one(t: pa.Table):
        part, name = t.column("part").to_numpy(), t.column("s1").to_numpy()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left = np.flatnonzero(part == i)
        right = left if i == j else np.flatnonzero(part == j)
        if len(left) == 0 or len(right) == 0:
            return None
        root, near = _near_pairs(t.column("n").to_numpy(), t.column("sketch").to_pylist(), left, right, percent)
        near -= i == j  # itself
        use = np.flatnonzero(root != np.arange(len(root)))
        use = np.union1d(use, root[use])
        if not len(use):
            return None
        return pa.RecordBatch.from_arrays([pa.array(name[use]), pa.array(name[root[use]]), pa.array(near[use])], names=["a", "b", "near"])

    return _by_task(one, ["block", "i", "j"])


_LINKS = "id binary, root binary, links long"
#: A task's rows: those of a block (or of a list), or of two parts of it.
_TASK = ["listed", "unit", "i", "j"]


def _linked(percent: int):
    """Decides all pairs of a task; rows come sorted by task."""

    def one(t: pa.Table):
        part = t.column("part").to_numpy()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        mult = t.column("mult").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("text").to_pylist()]
        size = np.array([len(s) for s in sets], dtype=np.float64)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        if len(left) == 0 or len(right) == 0 or len(sets) < 2:
            return None
        both = intersections(sets, left, right).astype(np.float64)
        ok = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        if i == j:
            np.fill_diagonal(ok, False)
        a, b = np.nonzero(ok)
        a, b = left[a], right[b]
        if t.column("listed")[0].as_py():  # the pair counts at the least list that both are on
            unit, lists = t.column("unit")[0].as_py(), t.column("lists").to_pylist()
            on = [frozenset(x) for x in lists]
            first = np.array([min(on[x] & on[y]) == unit for x, y in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
            a, b = a[first], b[first]
        if not len(a):
            return None
        links = np.bincount(a, weights=mult[b], minlength=len(sets))
        if i != j:
            links += np.bincount(b, weights=mult[a], minlength=len(sets))
        root = _roots(len(sets), a, b)
        use = np.flatnonzero(links > 0)
        ids = t.column("id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(use)), ids.take(pa.array(root[use])), pa.array(links[use].astype(np.int64))], names=["id", "root", "links"])

    return _by_task(one, _TASK)


def _by_task(one, names: list[str]):
    """Calls one with the rows of each task, which come sorted by these columns."""

    def each(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = np.stack([held.column(c).to_numpy() for c in names])
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if not len(edge):
                continue
            edge = np.append(0, edge)
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                out = one(held.slice(x, y - x))
                if out is not None:
                    yield out
            held = held.slice(int(edge[-1])).combine_chunks()
        if held is not None:
            out = one(held)
            if out is not None:
                yield out

    return each


def _parts(part_rows: int, part_bytes: int):
    """Parts that a group of sets is split into, by their number and their bytes; to be aggregated."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)), F.ceil(F.sum("n") * 8 / F.lit(part_bytes))).cast("int").alias("parts")


def _refined(member: DataFrame, sketched: DataFrame, percent: int, part_rows: int, part_bytes: int, sketch_rows: int) -> DataFrame:
    """member, large blocks cut into those that their sketches connect; near: near sets of each (null in blocks that were small).

    A set of a large block whose sketch is near no other one has no link and is left out.
    """
    split = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(sketch_rows)), F.ceil(F.sum("n") / F.lit(4 * SKETCH_BYTES))).cast("int").alias("split")
    blocks = member.groupBy("block").agg(_parts(part_rows, part_bytes), split).where("parts > 1").select("block", "split")
    blocks = stored(blocks, "jaccard-blocks")
    large = stored(member.join(blocks, "block").join(sketched.dropDuplicates(["rid"]), "rid"), "jaccard-sketched")
    rows = large.select("s1", "n", "sketch", "block", "split", F.pmod(F.xxhash64("id"), F.col("split")).cast("int").alias("part"))
    rows = _in_pairs(rows, "split").select("s1", "n", "sketch", "part", "block", "i", "j")
    rows = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "s1")
    found = stored(rows.mapInArrow(_near(percent), "a long, b long, near long"), "jaccard-near")
    cut = components(found).select(F.col("node").alias("s1"), F.col("root").alias("block"))
    near = found.groupBy(F.col("a").alias("s1")).agg(F.sum("near").alias("near"))
    small = member.join(blocks, "block", "left_anti").withColumn("near", F.lit(None).cast("long"))
    return stored(small.unionByName(large.drop("block", "split", "sketch").join(cut, "s1").join(near, "s1")), "jaccard-refined")


def _in_pairs(rows: DataFrame, parts: str) -> DataFrame:
    """rows, each once for every part of its group, with the pair of parts i <= j that it is for."""
    out = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))
    return out.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))


def _units(member: DataFrame, lists: DataFrame, part_rows: int, part_bytes: int) -> DataFrame:
    """(rid, s1, s2, id, mult, listed, unit, parts, lists): the blocks, or lists, that each class is held against others in.

    A block of n sets in p parts costs n * p transfers of sets, its lists cost the same sum over the lists. Only blocks of
    several parts, few of whose pairs are near, are looked at by their lists.
    """
    blocks = member.groupBy("block").agg(_parts(part_rows, part_bytes), F.count(F.lit(1)).alias("members"), F.sum("near").alias("near"))
    own = ["rid", "s1", "s2", "id", "mult"]
    sparse = blocks.where((F.col("parts") > 1) & (F.col("near") < F.col("members") * F.col("members") * (DENSE / 2))).drop("near")
    large = stored(member.drop("near").join(sparse, "block"), "jaccard-large")
    on = lists.join(large.select("s1", "n", "block", "id"), "s1")
    by_list = on.groupBy("block", "key").agg(_parts(part_rows, part_bytes).alias("list_parts"), F.count(F.lit(1)).alias("on_list")).where("on_list > 1")
    cost = by_list.groupBy("block").agg(F.sum(F.col("on_list") * F.col("list_parts")).alias("by_lists"))
    chosen = large.select("block", "parts", "members").distinct().join(cost, "block").where(F.col("by_lists") < F.col("members") * F.col("parts")).select("block")
    chosen = stored(chosen, "jaccard-chained")
    listed = on.join(chosen, "block").join(by_list.select("block", "key", "list_parts"), ["block", "key"])
    keys = listed.groupBy("id").agg(F.collect_set("key").alias("lists"))
    listed = listed.select("id", F.col("key").alias("unit"), F.col("list_parts").alias("parts")).join(keys, "id").join(large.select(*own), "id")
    whole = member.join(chosen, "block", "left_anti").join(blocks.select("block", "parts"), "block")
    whole = whole.select(*own, F.lit(False).alias("listed"), F.col("block").alias("unit"), "parts", F.array().cast("array<bigint>").alias("lists"))
    return whole.unionByName(listed.select(*own, F.lit(True).alias("listed"), "unit", "parts", "lists"))


def jaccard_classes(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES, bound: int | None = None, sketch_rows: int = SKETCH_ROWS) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, n_links, root) for every row of (doc_id, text); rid is a 128-bit hash of both.

    component_id is the least id in the component, which two components can share or lack; root is the 128-bit signature of a set in it and
    tells components apart (null without words).
    """
    texts = tb.small_batches(docs).select(tb.row_id("doc_id", "text").alias("rid"), "doc_id", "text")
    rows = stored(texts.mapInArrow(_classes(k), "rid binary, doc_id long, n long, s1 long, s2 long, sketch binary"), "jaccard-classes")
    classes = rows.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "rid")).alias("rep"), F.count(F.lit(1)).alias("mult"), F.max("n").alias("n"))
    classes = classes.withColumn("id", F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("s1", "s2")])))
    if bound is None:
        sizes = classes.where(F.col("n") <= MOST_LIGHT + 4).groupBy("n").count().collect()
        bound = light_bound({r["n"]: r["count"] for r in sizes}, percent)
    posts = texts.select("text").mapInArrow(_postings(k, percent, bound), "key long, s1 long, need int, light boolean")
    shared = stored(posts.repartition("key").sortWithinPartitions("key", "s1").mapInArrow(_shared, "key long, s1 long, need int, light boolean"), "jaccard-lists")
    own = ["s1", "light"]
    enough = shared.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).where("n >= need").select(*own)
    lists = shared.join(enough, own, "left_semi")
    df = lists.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rank, whole = Window.partitionBy(*own).orderBy("df", "key"), Window.partitionBy(*own)
    lists = lists.join(df, "key").withColumns({"rank": F.row_number().over(rank), "n": F.count(F.lit(1)).over(whole), "least": F.min("need").over(whole)})
    lists = stored(lists.where("rank <= n - least + 1").select("key", "s1").distinct(), "jaccard-kept")
    low = lists.groupBy("key").agg(F.min("s1").alias("low"))
    edges = lists.join(low, "key").where("s1 <> low").select(F.col("s1").alias("a"), F.col("low").alias("b")).distinct()
    blocks = components(edges).select(F.col("node").alias("s1"), F.col("root").alias("block"))
    member = stored(classes.join(blocks, "s1").select(F.col("rep.rid").alias("rid"), "s1", "s2", "id", "n", "mult", "block"), "jaccard-members")
    member = _refined(member, rows.select("rid", "sketch"), percent, part_rows, part_bytes, sketch_rows)
    units = _units(member, lists, part_rows, part_bytes).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # the texts are dealt by row at every size: what is wanted of them grows with them; rows that repeat are one before that
    sets = texts.select("rid", "text").dropDuplicates(["rid"]).join(units.hint("merge"), "rid")
    schema = "text binary, s1 long, s2 long, id binary, mult long, listed boolean, unit long, parts int, part int, lists array<bigint>"
    sets = sets.select(*[c.split()[0] for c in schema.split(", ")]).mapInArrow(_set_rows(k), schema).drop("s1", "s2")
    sets = _in_pairs(sets, "parts").select("text", "id", "mult", "part", *_TASK, "lists").repartition(*_TASK).sortWithinPartitions(*_TASK, "id")
    found = stored(sets.mapInArrow(_linked(percent), _LINKS), "jaccard-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    linked = links.join(roots, links["id"] == roots["node"]).select("id", "root", "links")
    named = classes.select("s1", "s2", "id", F.col("rep.doc_id").alias("first"), "mult").join(linked, "id", "left")
    lowest = named.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(lowest, "root", "left").select("s1", "s2", F.coalesce("least", "first").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "id").alias("root"))
    full = rows.where("n > 0").join(named, ["s1", "s2"]).select("rid", "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "root")
    empty = rows.where("n = 0").select("rid", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("binary").alias("root"))
    return full.unionByName(empty)
