"""Suffix-array dedup: removes every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

The suffix array is sparse. In each string of LENGTH bytes the leftmost least hash among its runs of ``LEAD``
bytes is an anchor; it depends on the string only, so equal strings have it at the same offset. Comparing suffixes at
anchors (about one in 80 bytes), with the bytes before them, thus finds every repeat.

1. Each task hashes the LEAD bytes at its anchors; hashes that occur once are dropped (a sort by hash finds runs). A hash that a task meets
   again is known to repeat: the task says so once, and these rows are spread over all tasks instead of meeting in one.
2. What is left is cut from the texts: the suffix of LENGTH bytes and the LENGTH - LEAD bytes before it. Equal ones of a batch
   (copies, periodic text) are marked as repeats at once and go on as one.
3. Sampled splitters range-partition the suffixes by their leading bytes, so all with the same LEAD bytes
   share a bucket. A bucket sorts its suffixes, and the reversed left contexts, by multikey quicksort on 8-byte
   words; common prefixes of neighbours give, for each offset l, classes of equal
   strings that start l bytes before the anchor. A class of two or more marks its members.
4. A leading string with more than ``HOT`` suffixes is not held in one task: each of its strings is
   digested with its offset (128 bits), digests are counted across all buckets with partial aggregation, and
   those counted twice or more mark their members.

Matches never cross documents; strings are judged on the input. A row is known by a 128-bit hash of (doc_id, text); rows that repeat both
are copies of each other and lose all strings of LENGTH bytes. Null texts are empty; texts shorter than LENGTH stay whole. An
empty table gives an empty result. Extra columns are kept by ``dedup_documents``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb
from tessera.llm.storage import stored

LENGTH, LEAD = 200, 40
HOT = 120_000
#: Suffixes that a bucket sorts at once, at least one leading string.
CHUNK = 16_384
_SEGMENT = 1 << 22


def anchors(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray]:
    """(positions in raw, hashes of the lead bytes there), ascending."""
    w, n = length - lead + 1, len(raw)
    pos, key = [], []
    ends = off[1:]
    for a in range(0, max(n - length + 1, 0), _SEGMENT):
        part = raw[a : min(n, a + _SEGMENT + length - 1)]
        m = len(part)
        if m < length:
            break
        pw, inv = tb.powers(m + 1)
        c = np.empty(m + 1, dtype=np.uint64)
        c[0] = 0
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * pw[:-1], out=c[1:])
        h = tb.mix((c[lead:] - c[:-lead]) * inv[: m - lead + 1])
        v = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= w:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        if span < w:
            v = np.minimum(v[: len(v) - (w - span)], v[w - span :])
        v = v[: m - length + 1]
        # strings that end within the document they start in
        first = np.searchsorted(off, a, side="right") - 1
        last = np.searchsorted(off, a + len(v), side="left")
        ok = np.zeros(len(v), dtype=bool)
        for d in range(max(first, 0), min(last, len(ends))):
            x, y = max(off[d] - a, 0), ends[d] - length + 1 - a
            if y > x:
                ok[x:y] = True
        at = (v[ok] & np.uint64(0xFFFFFF)).astype(np.int64)
        if len(at):
            at = at[np.append(True, at[1:] != at[:-1])]
            pos.append(at + a)
            key.append(h[at])
    if not pos:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pos, key = np.concatenate(pos), np.concatenate(key)
    new = np.append(True, pos[1:] != pos[:-1])
    return pos[new], key[new]


#: What an anchor's row is: not met before in its task; met there already, so a repeat; said once by a task for a hash that repeats in it.
ALONE, AGAIN, SAID = 0, 1, 2
#: Hashes that a task remembers to repeat in it.
MEMORY = 200_000


def _anchor_rows(batches):
    """(key, rid, pos, kind) of every anchor. However often a hash occurs, a task has few rows of it that other tasks must see."""
    known = np.zeros(0, dtype=np.uint64)
    for b in batches:
        raw, off = tb.text_bytes(b.column(1))
        rid = b.column(0)
        for i, _, r, o in tb.slices(raw, off):
            at, key = anchors(r, o)
            if not len(at):
                continue
            row = np.searchsorted(o, at, side="right") - 1
            sole, which, times = np.unique(key, return_inverse=True, return_counts=True)
            before = np.isin(sole, known, assume_unique=True)
            kind = np.where(before | (times > 1), AGAIN, ALONE)[which]
            new = sole[~before & (times > 1)]
            if len(known) < MEMORY:
                known = np.concatenate([known, new])
            cols = [np.concatenate([x, y]) for x, y in ((tb.as_long(key), tb.as_long(new)), (at - o[row], np.zeros(len(new), np.int64)), (kind, np.full(len(new), SAID)))]
            keys, pos, kinds = (pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int32(), pa.int8()), strict=True))
            rows = pa.concat_arrays([rid.take(pa.array(i + row)), pa.nulls(len(new), rid.type)])
            yield pa.RecordBatch.from_arrays([keys, rows, pos, kinds], names=["key", "rid", "pos", "kind"])


def _runs(batches):
    """(rid, pos) of the repeats, and of rows whose key, in sorted order, equals a neighbour's; one row is carried from batch to batch."""
    held, matched = None, False
    for b in batches:
        again = b.column(3).to_numpy() == AGAIN
        if again.any():
            yield b.filter(pa.array(again)).select(["rid", "pos"])
            b = b.filter(pa.array(~again))
        if not b.num_rows:
            continue
        b = pa.Table.from_batches([x for x in (held, b) if x is not None]).combine_chunks().to_batches()[0]
        key = b.column(0).to_numpy()
        same = key[1:] == key[:-1]
        hit = np.zeros(len(key), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        hit[0] |= matched
        matched = bool(hit[-1])
        out = b.slice(0, b.num_rows - 1).filter(pa.array((hit & (b.column(3).to_numpy() == ALONE))[:-1]))
        held = b.slice(b.num_rows - 1)
        if out.num_rows:
            yield out.select(["rid", "pos"])
    if held is not None and matched and held.column(3)[0].as_py() == ALONE:
        yield held.select(["rid", "pos"])


def _packed(batches):
    """Texts as compressed bytes: they are shuffled, and stand on disk meanwhile."""
    import zstandard

    code = zstandard.ZstdCompressor(level=1)
    for b in batches:
        i = b.schema.get_field_index("text")
        raw, off = tb.text_bytes(b.column(i))
        data = raw.tobytes()
        packed = pa.array([code.compress(data[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([packed if c == i else b.column(c) for c in range(b.num_columns)], names=b.schema.names)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    code = zstandard.ZstdDecompressor()
    texts = [code.decompress(x.as_buffer()) for x in column]
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _contexts(batches):
    """Suffixes at the anchors of each text, with what stands before them; padded with zeros."""
    before = LENGTH - LEAD
    window = np.arange(-before, LENGTH)
    for b in batches:
        raw, off = _unpacked(b.column(b.schema.get_field_index("text")))
        rid = b.column(b.schema.get_field_index("rid"))
        lists = b.column(b.schema.get_field_index("at"))
        count = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(b.num_rows), count)
        at = lists.flatten().to_numpy().astype(np.int64)
        for x in range(0, len(at), 8192):
            p, q = at[x : x + 8192], row[x : x + 8192]
            size = off[q + 1] - off[q]
            keep = p + LEAD <= size
            p, q, size = p[keep], q[keep], size[keep]
            if not len(p):
                continue
            left, right = np.minimum(p, before), np.minimum(size - p, LENGTH)
            cell = (off[q] + p)[:, None] + window
            inside = (window >= -left[:, None]) & (window < right[:, None])
            text = np.where(inside, raw[np.clip(cell, 0, max(len(raw) - 1, 0))], 0).astype(np.uint8)
            # equal rows meet here already: all their strings are repeats, and one row stands for them from here on
            whole = np.concatenate([text, np.stack([left, right], axis=1).astype("<u2").view(np.uint8)], axis=1)
            _, first, same, times = np.unique(np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True)
            many = (times[same] > 1) & (left + right >= LENGTH)
            yield _rows(rid.take(pa.array(q[first])), p[first], left[first], right[first], text[first])
            if many.any():
                yield _rows(rid.take(pa.array(q[many])), p[many] - left[many], np.full(many.sum(), -1), p[many] + right[many], text[:0])


def _rows(rid: pa.Array, pos, nl, nr, text: np.ndarray) -> pa.RecordBatch:
    """Suffixes with their contexts; or, with nl -1 and no text, marked stretches [pos, nr)."""
    width = text.shape[1] if len(text) else 0
    data = pa.Array.from_buffers(pa.binary(), len(rid), [None, pa.py_buffer((np.arange(len(rid) + 1) * width).astype(np.int32)), pa.py_buffer(text.tobytes())])
    return pa.RecordBatch.from_arrays([rid, *(pa.array(x.astype(np.int32)) for x in (pos, nl, nr)), data], names=["rid", "pos", "nl", "nr", "ctx"])


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of unsigned words: multikey quicksort, all equal parts refined together by the next word."""
    n = len(words)
    order = np.argsort(words[:, 0], kind="stable")
    if n < 2:
        return order
    k = words[order, 0]
    part = np.cumsum(np.append(0, (k[1:] != k[:-1]).astype(np.int64)))
    for depth in range(1, words.shape[1]):
        same = part[1:] == part[:-1]
        if not same.any():
            break
        open_ = np.zeros(n, dtype=bool)
        open_[1:] |= same
        open_[:-1] |= same
        i = np.flatnonzero(open_)
        k = words[order[i], depth]
        o = np.lexsort((k, part[i]))
        order[i] = order[i][o]
        k, p = k[o], part[i]
        new = np.append(False, (k[1:] != k[:-1]) & (p[1:] == p[:-1]))
        step = np.zeros(n, dtype=np.int64)
        step[i] = new
        part = part + np.cumsum(step)
    return order


def _common(m: np.ndarray, order: np.ndarray, avail: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbours in the order; entry i is of rows i - 1 and i, entry 0 is -1."""
    a, b = m[order[:-1]], m[order[1:]]
    diff = a != b
    lcp = np.where(diff.any(axis=1), diff.argmax(axis=1), m.shape[1])
    return np.append(-1, np.minimum(lcp, np.minimum(avail[order[:-1]], avail[order[1:]])))


def _words(m: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(m).view(">u8").astype(np.uint64)


def repeated(ctx: np.ndarray, nl: np.ndarray, nr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) l of each row such that its LENGTH bytes from l before the anchor occur in another row too; -1 if none."""
    before, n = LENGTH - LEAD, len(ctx)
    low, high = np.full(n, -1), np.full(n, -1)
    right, left = ctx[:, before:], np.ascontiguousarray(ctx[:, :before][:, ::-1])
    r_order, l_order = multikey_order(_words(right)), multikey_order(_words(left))
    r_lcp, l_lcp = _common(right, r_order, nr), _common(left, l_order, nl)
    r_best, l_best = np.empty(n, np.int64), np.empty(n, np.int64)
    r_best[r_order] = np.maximum(r_lcp, np.append(r_lcp[1:], -1))
    l_best[l_order] = np.maximum(l_lcp, np.append(l_lcp[1:], -1))
    if not ((r_best + l_best) >= LENGTH).any():
        return low, high
    rc, lc = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(before + 1):  # noqa: E741
        can = (l <= nl) & (LENGTH - l <= nr) & (r_best >= LENGTH - l) & (l_best >= l)
        i = np.flatnonzero(can)
        if len(i) < 2:
            continue
        rc[r_order] = np.cumsum(r_lcp < LENGTH - l)
        if l:
            lc[l_order] = np.cumsum(l_lcp < l)
        else:
            lc[:] = 0
        key = rc[i] * (n + 1) + lc[i]
        o = np.argsort(key)
        same = key[o][1:] == key[o][:-1]
        hit = np.zeros(len(i), dtype=bool)
        hit[o[1:][same]] = True
        hit[o[:-1][same]] = True
        j = i[hit]
        high[j] = l
        low[j] = np.where(low[j] < 0, l, low[j])
    return low, high


#: Random values of the bytes, for two independent sums.
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, (2, 256)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FOUND = "rid binary, start int, end int, d1 long, d2 long"


def _bucket(batches, hot: int = HOT, chunk: int = CHUNK):
    """Marked strings of a bucket sorted by leading bytes; digests where a leading string is hot."""
    before = LENGTH - LEAD

    def emit(t: pa.Table):
        ctx = np.frombuffer(t.column("ctx").combine_chunks().buffers()[2], dtype=np.uint8)
        col = t.column("ctx").combine_chunks()
        ctx = ctx[col.offset * (before + LENGTH) :][: len(col) * (before + LENGTH)].reshape(len(col), -1)
        nl, nr, pos = (t.column(c).to_numpy().astype(np.int64) for c in ("nl", "nr", "pos"))
        low, high = repeated(ctx, nl, nr)
        i = np.flatnonzero(low >= 0)
        none = pa.nulls(len(i), pa.int64())
        return pa.RecordBatch.from_arrays([t.column("rid").combine_chunks().take(pa.array(i)), pa.array((pos[i] - high[i]).astype(np.int32)), pa.array((pos[i] - low[i] + LENGTH).astype(np.int32)), none, none], names=["rid", "start", "end", "d1", "d2"])

    def digests(t: pa.Table):
        """128-bit digests of every string of LENGTH bytes around the anchors: two sums over random values of the bytes, by prefixes."""
        col = t.column("ctx").combine_chunks()
        width = before + LENGTH
        ctx = np.frombuffer(col.buffers()[2], dtype=np.uint8)[col.offset * width :][: len(col) * width].reshape(len(col), -1)
        nl, nr, pos = (t.column(c).to_numpy().astype(np.int64) for c in ("nl", "nr", "pos"))
        rid = t.column("rid").combine_chunks()
        pw, inv = tb.powers(width + 1)
        l = np.arange(before + 1)  # noqa: E741
        inside = (l >= LENGTH - nr[:, None]) & (l <= nl[:, None])
        row, l = np.nonzero(inside)  # noqa: E741
        start = before - l
        two = []
        for values in _BYTES:
            c = np.zeros((len(ctx), width + 1), dtype=np.uint64)
            np.cumsum(values[ctx] * pw[:width], axis=1, out=c[:, 1:])
            two.append(tb.as_long(tb.mix((c[row, start + LENGTH] - c[row, start]) * inv[start] + l.astype(np.uint64))))
        at = pos[row] - l
        return pa.RecordBatch.from_arrays([rid.take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array((at + LENGTH).astype(np.int32)), *map(pa.array, two)], names=["rid", "start", "end", "d1", "d2"])

    held: pa.Table | None = None
    flowing: bytes | None = None  # the hot leading string whose rows are digested as they come
    for b in batches:
        done = b.column(b.schema.get_field_index("nl")).to_numpy() < 0
        if done.any():
            t = b.filter(pa.array(done))
            none = pa.nulls(t.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(t.column(t.schema.get_field_index(c)) for c in ("rid", "pos", "nr")), none, none], names=["rid", "start", "end", "d1", "d2"])
            b = b.filter(pa.array(~done))
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        while held is not None and held.num_rows:
            if flowing is None and held.num_rows < chunk:
                break
            lead = held.column("lead").combine_chunks()
            first, last = lead[0].as_py(), lead[-1].as_py()
            if flowing is not None:
                n = held.num_rows if last == flowing else _until(lead, flowing)
                for x in range(0, n, 512):
                    yield digests(held.slice(x, min(512, n - x)))
                if n < held.num_rows:
                    flowing = None
                held = held.slice(n)
                if flowing is not None:
                    break
            elif first == last:
                if held.num_rows <= hot:
                    break
                flowing = first
            else:
                n = _from(lead, last)
                yield from _parts(held.slice(0, n), emit, digests, hot, chunk)
                held = held.slice(n)
                if held.num_rows <= hot:
                    break
    if held is not None and held.num_rows:
        yield from _parts(held, emit, digests, hot, chunk)


def _parts(t: pa.Table, emit, digests, hot: int, chunk: int):
    """Whole leading strings, about ``chunk`` suffixes at a time."""
    lead = t.column("lead").combine_chunks()
    m = np.frombuffer(lead.buffers()[2], dtype=np.uint8)[lead.offset * LEAD :][: len(lead) * LEAD].reshape(len(lead), LEAD)
    edge = np.append(np.flatnonzero(np.append(True, (m[1:] != m[:-1]).any(axis=1))), len(lead))
    i = 0
    while i < len(edge) - 1:
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + chunk, side="right")) - 1)
        part = t.slice(edge[i], edge[j] - edge[i])
        if j == i + 1 and part.num_rows > hot:
            for x in range(0, part.num_rows, 512):
                yield digests(part.slice(x, 512))
        else:
            yield emit(part)
        i = j


def _from(lead: pa.Array, value: bytes) -> int:
    """First row with the given value; rows are sorted."""
    lo, hi = 0, len(lead)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if lead[mid].as_py() < value else (lo, mid)
    return lo


def _until(lead: pa.Array, value: bytes) -> int:
    lo, hi = 0, len(lead)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if lead[mid].as_py() <= value else (lo, mid)
    return lo


def with_row_id(docs: DataFrame, name: str = "rid") -> DataFrame:
    return docs.withColumn(name, tb.row_id("doc_id", "text"))


def repeated_spans(texts: DataFrame, dealt: DataFrame, hot_rows: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """(rid, start, end): overlapping stretches to remove. ``texts`` has (rid, text), ``dealt`` the same packed and partitioned by rid."""
    keys = tb.small_batches(texts).select("rid", "text").mapInArrow(_anchor_rows, "key long, rid binary, pos int, kind byte")
    # rows that are known to be repeats pass through any task
    dealt_by = F.when(F.col("kind") == AGAIN, F.xxhash64("rid", "pos")).otherwise(F.col("key"))
    shared = keys.repartition(dealt_by).sortWithinPartitions("key").mapInArrow(_runs, "rid binary, pos int")
    at = shared.groupBy("rid").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    cut = dealt.join(at, "rid").select("rid", "text", "at").mapInArrow(_contexts, "rid binary, pos int, nl int, nr int, ctx binary")
    # marked stretches only pass through; they are spread over the buckets
    lead = F.when(F.col("nl") >= 0, F.substring("ctx", LENGTH - LEAD + 1, LEAD)).otherwise(F.sha1(F.concat("rid", F.encode(F.col("pos").cast("string"), "UTF-8"))).cast("binary"))
    buckets = cut.repartitionByRange(lead).withColumn("lead", lead).sortWithinPartitions("lead")
    found = stored(buckets.mapInArrow(lambda x: _bucket(x, hot_rows, chunk), _FOUND), "repeats")
    plain = found.where("d1 is null").select("rid", "start", "end")
    hot = found.where("d1 is not null")
    twice = hot.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
    return plain.unionByName(hot.join(twice, ["d1", "d2"]).select("rid", "start", "end"))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _digest_rows(batches):
    for b in batches:
        col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        raw, off = _unpacked(col["text"])
        spans = col["spans"].to_pylist()
        data = raw.tobytes()
        removed, runs, sha = [], [], []
        for i, own in enumerate(spans):
            text = data[off[i] : off[i + 1]]
            cut = _merge([(s["start"], s["end"]) for s in own or ()])
            h, at = hashlib.sha256(), 0
            for a, z in cut:
                h.update(text[at:a])
                at = z
            h.update(text[at:])
            removed.append(sum(z - a for a, z in cut))
            runs.append(len(cut))
            sha.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([col["doc_id"], pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _spans(docs: DataFrame, hot_rows: int = HOT, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    texts = with_row_id(docs.select("doc_id", "text")).select("rid", "doc_id", "text")
    dealt = texts.mapInArrow(_packed, "rid binary, doc_id long, text binary").repartition("rid")
    spans = repeated_spans(texts, dealt, hot_rows, chunk)
    return dealt, spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def removed_digest(docs: DataFrame, hot_rows: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text)."""
    dealt, spans = _spans(docs, hot_rows, chunk)
    return dealt.join(spans, "rid", "left").select("doc_id", "text", "spans").mapInArrow(_digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut out of ``text`` (characters cut in part go whole); ``n_chars`` follows where there is one.

    Documents of which nothing is left stay, with an empty text.
    """
    names = docs.columns

    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        raw, off = tb.text_bytes(texts)
        data, null, out = raw.tobytes(), texts.is_null().to_pylist(), []
        for i, own in enumerate(found.to_pylist()):
            text, at, kept = data[off[i] : off[i + 1]], 0, []
            for a, z in _merge([(s["start"], s["end"]) for s in own or ()]):
                kept.append(text[at:a].decode("utf-8", "ignore"))
                at = z
            kept.append(text[at:].decode("utf-8", "ignore"))
            out.append(None if null[i] else "".join(kept))
        return pa.array(out, pa.string())

    cut.__annotations__ = {"texts": pa.Array, "found": pa.Array, "return": pa.Array}
    _, spans = _spans(docs)
    key, found = tb.fresh(docs, "rid"), tb.fresh(docs, "spans")
    rows = with_row_id(docs, key).join(spans.select(F.col("rid").alias(key), F.col("spans").alias(found)), key, "left")
    # texts without a repeat stay in the JVM
    left = F.arrow_udf(cut, "string").asNondeterministic()(F.when(F.col(found).isNotNull(), F.col("text")), F.col(found))
    out = rows.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(left)).select(*names)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
