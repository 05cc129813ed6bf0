"""Benchmark decontamination: finds passages of benchmark items in documents, also edited ones.

Item and document are read as characters, lower-cased with white space collapsed. From every character a random walk of the CGK
embedding starts: at each of its ``steps`` it writes the character it stands on and moves on by one or not at all, as random bits of (step,
character) say. An edit between two texts thus puts their walks out of step for a while only, and edit distance becomes
Hamming distance of what is written. Bit sampling: ``bits`` of the written places, drawn once for each walk, make the key of a start.

Keys that an item and a document share are counted over windows of the size of the item: pairs of starts lie on diagonals (place in
the document less place in the item), and a part of the document within k edits of the item keeps to k + 1 diagonals. Where so many diagonals
together hold ``least`` equal keys the item is a candidate. (Bands of at least k diagonals are counted first, and the diagonals only
where two neighbouring bands hold enough.) ``plan`` simulates k edits of characters in texts of the item's length, at random or even
distances, letters only or mixed with insertions and deletions, and chooses the walk, how often it is repeated with other random bits, and
``least`` so that a share ``RECALL`` of the texts keeps enough; the longest walk comes first, repetitions are added, then shorter walks follow.
Items of up to ``SHORT`` characters, and any that no walk finds often enough, are looked for by one run of characters that k edits
cannot all break (by pigeonhole, nothing is lost). Nothing else stands before the verification: the edit distance
between the whole item and the best part of the stretch of text that the diagonals span.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` bytes, each of which is broadcast and held against all documents;
documents are never shuffled. Texts are read whole.

Defined results: null, empty and blank texts match nothing; every other item is looked for, however short and with or without
spaces, so one of few characters is found wherever these stand, also inside a word; equal items are each reported, an item without
an id with a null item_id; repeated rows are each reported; an empty table gives an empty result.
Extra columns are dropped by ``leaks`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textbatch as tb

SIMILARITY = 0.8
RECALL = 0.95
BLOCK_BYTES = 4 << 20
#: Items of so many characters or fewer are found for certain.
SHORT = 24
#: Walks that are tried for longer items: steps, sampled places, characters passed at least, and the equal keys wanted of an edited item.
WALKS = ((7, 6, 4, 6), (6, 5, 3, 3))
#: A walk moves on where one of so many random bits is set. With one, as first published, keys tell less apart at the same recall.
COINS = 3
REPETITIONS = 3
#: Longest run of characters that is looked for in items without a walk.
LONGEST_RUN = 6
TRIALS = 200
#: Characters worked on at once, cells and pairs of places held at once.
SEGMENT, CELLS, PAIRS = 1 << 18, 1 << 21, 1 << 21
_TABLE = 20


def allowed(m: int, similarity: float = SIMILARITY) -> int:
    """Edits that an item of m characters may have."""
    return int((1 - similarity) * m + 1e-9)


def _scrambled(points: np.ndarray, seed: int) -> np.ndarray:
    """32 random bits of each character."""
    h = points * np.uint32(0x9E3779B1) + np.uint32(seed * 0x85EBCA6B & 0xFFFFFFFF)
    for shift, odd in ((15, 0x2C1B3C6D), (12, 0x297A2D39)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(odd)
    return h ^ (h >> np.uint32(15))


@lru_cache(maxsize=None)
def sampled(steps: int, bits: int, draw: int) -> tuple[int, ...]:
    """The places of a walk's writing that make its key: one drawn from each of ``bits`` equal stretches."""
    rng = np.random.default_rng([steps, bits, draw])
    return tuple(int(x) for x in (np.arange(bits) + rng.random(bits)) * steps / bits)


def walk_keys(points: np.ndarray, steps: int, bits: int, least: int, draw: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, starts, stops) of the walks from every character that pass ``least`` characters or more. Beyond the end everything is 0.

    Worked out from the last step to the first: what a walk writes from a step on depends only on where it stands.
    """
    n = len(points)
    move = np.zeros(n + steps + 1, dtype=np.uint32)
    move[:n] = _scrambled(points, 2 * draw + 1)
    for coin in range(1, COINS):
        move[:n] |= _scrambled(points, 1000 * coin + draw)
    written = np.zeros(n + steps + 1, dtype=np.uint32)
    written[:n] = _scrambled(points, 2 * draw + 2)
    at = set(sampled(steps, bits, draw))
    key = np.zeros(n + steps + 1, dtype=np.uint32)
    far = np.zeros(n + steps + 1, dtype=np.uint8)
    for j in range(steps - 1, -1, -1):
        m = n + j + 1
        if j < steps - 1:
            bit = (move[:m] >> np.uint32(j)).astype(np.uint8) & np.uint8(1)
            forward = bit.view(bool)
            key = np.where(forward, key[1 : m + 1], key[:m])
            far = np.where(forward, far[1 : m + 1], far[:m])
            far += bit
        if j in at:
            key = key[:m] * np.uint32(0x01000193)
            key += written[:m]
    start = np.flatnonzero(far[:n] >= least)
    key = key[start]
    key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return key >> np.uint32(32 - _TABLE), start, start + far[start]


def _edited(m: int, k: int, even: bool, mixed: bool, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(random texts of m letters, the same with k edits, place of each character in the latter or -1); TRIALS texts, a 0 after each."""
    text = rng.integers(97, 123, (TRIALS, m + 1)).astype(np.uint32)
    text[:, m] = 0
    kind = np.zeros((TRIALS, m + 1), dtype=np.int64)  # 1: another letter, 2: gone, 3: one put before
    at = ((np.arange(k) + rng.random((TRIALS, k))) * m / k).astype(np.int64) if even else rng.random((TRIALS, m)).argpartition(k - 1, axis=1)[:, :k]
    np.put_along_axis(kind, at, rng.integers(1, 4, (TRIALS, k)) if mixed else 1, axis=1)
    kind = kind.ravel()
    size = np.choose(kind, [1, 1, 0, 2])
    end = np.cumsum(size)
    other = rng.integers(97, 123, int(end[-1])).astype(np.uint32)
    kept = (kind == 0) | (kind == 3)
    other[end[kept] - 1] = text.ravel()[kept]
    return text.ravel(), other, np.where(kept, end - 1, -1)


@lru_cache(maxsize=None)
def survivors(m: int, k: int, walk: tuple[int, int, int], draw: int, seed: int = 7) -> np.ndarray:
    """Equal keys on their own diagonal that k simulated edits leave to items of m characters: a row for each way to edit."""
    out = []
    for way, (even, mixed) in enumerate(((False, False), (False, True), (True, False), (True, True))):
        text, other, place = _edited(m, k, even, mixed, np.random.default_rng([seed, m, k, way]))
        own, start, stop = walk_keys(text, *walk, draw)
        keys, at, _ = walk_keys(other, *walk, draw)
        found = np.full(len(other) + 1, 1 << _TABLE, dtype=np.uint32)
        found[at] = keys
        trial = start // (m + 1)
        same = (own == found[place[start]]) & (stop - trial * (m + 1) < m)
        out.append(np.bincount(trial[same], minlength=TRIALS))
    return np.array(out)


@lru_cache(maxsize=None)
def plan(m: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[tuple[int, int, int], int, int]:
    """(walk, repetitions, least): how an item of m characters is looked for.

    A walk has (steps, sampled places, characters passed). With 0 places, ``steps`` is the length of the runs of characters instead, of which one is enough. Half of the misses that the
    recall leaves are kept for chance in the simulation; of the ways to edit, the worst counts.
    """
    k = allowed(m, similarity)
    sure = max(1, min(m // (k + 1), LONGEST_RUN))
    if m <= SHORT or k == 0:
        return (sure, 0, 0), 1, 1
    # lengths are rounded down to some that are simulated: at the same share of edits a longer item keeps more
    step = 1 << max(k.bit_length() - 4, 0)
    fewest = ceil((k - k % step) / (1 - similarity) - 1e-9)
    if fewest < m:
        return plan(fewest, similarity, recall) if fewest > SHORT else ((sure, 0, 0), 1, 1)
    if m > 1000:  # the share that survives varies less the longer the item is
        walk, times, least = plan(1000, similarity, recall)
        return (walk, times, least * m // 1000) if walk[1] else ((sure, 0, 0), 1, 1)
    for *walk, wanted in WALKS:
        total = np.zeros((4, TRIALS), dtype=np.int64)
        for draw in range(REPETITIONS):
            total = total + survivors(m, k, tuple(walk), draw)
            least = int(np.sort(total, axis=1)[:, int((1 - recall) / 2 * TRIALS + 1e-9)].min())
            if least >= wanted:
                return tuple(walk), draw + 1, least
    return (sure, 0, 0), 1, 1


def _runs(points: np.ndarray, q: int) -> np.ndarray:
    """Hashes of _TABLE bits of every run of q characters."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = points[:n] * np.uint32(0x9E3779B1)
    for i in range(1, q):
        h = (h ^ points[i : i + n]) * np.uint32(0x85EBCA6B) + (h >> np.uint32(15))
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - _TABLE)


def _points(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(characters, first of each row and the end): lower-cased, white space collapsed, a line feed after each row."""
    space = tb.SPACE[raw]
    fresh = np.zeros(len(raw) + 1, dtype=bool)
    fresh[off] = True
    keep = ~space
    keep[1:] |= ~space[:-1] & ~fresh[1:-1]
    low = np.where(space, np.uint8(32), tb.LOWER[raw])[keep].tobytes()
    edge = np.concatenate([[0], np.cumsum(keep)])[off].tolist()
    flat = b"\n".join([low[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)] + [b""])
    points = np.frombuffer(flat.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    return points, np.concatenate([[0], np.flatnonzero(points == 10) + 1])


def _nearest(masks: dict[int, int], m: int, text: list[int], most: int, anchored: bool = False) -> tuple[int, int]:
    """(least edit distance between the pattern and a part of text, end of the first such part); anchored parts start at 0.

    Ends early where no part can come down to ``most`` any more.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    spare = most + len(text)
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & top:
            score += 1
            if score > spare - j:
                break
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
                if not best:
                    break
        ph = ph << 1 | anchored
        up = (mh << 1 | ~(xv | ph)) & full
        down = ph & xv & full
    return best, end


def _masks(points: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, c in enumerate(points):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def edit_distance_within(item: np.ndarray, stretch: np.ndarray) -> int:
    """Least edit distance between item and any part of stretch (arrays of code points)."""
    return _nearest(_masks(item.tolist()), len(item), stretch.tolist(), len(item))[0] if len(item) else 0


@dataclass
class Group:
    """Items that are looked for with the same walks; a band has 2 ** shift diagonals."""

    walk: tuple[int, int, int]
    times: int
    items: np.ndarray
    edits: np.ndarray
    shift: np.ndarray
    longest: int
    least: np.ndarray
    keys: np.ndarray  # sorted
    item: np.ndarray  # of each key, as an index into items
    place: np.ndarray
    spot: np.ndarray  # place and repetition
    tables: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # whether and how many keys there are of each value, and the first; made where they are used

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.tables is None:
            count = np.bincount(self.keys, minlength=1 << _TABLE)
            self.tables = count > 0, count.astype(np.int32), (np.cumsum(count) - count).astype(np.int32)
        return self.tables

    def of(self, points: np.ndarray, inside: bool = False):
        """(keys, starts) for each repetition; ``inside``: of walks that end within the text only."""
        if not self.walk[1]:
            yield (h := _runs(points, self.walk[0])), np.arange(len(h))
            return
        for draw in range(self.times):
            h, start, stop = walk_keys(points, *self.walk, draw)
            h = h ^ np.uint32(draw * 0x5BD1E & (1 << _TABLE) - 1)  # repetitions share the tables of the keys
            yield (h[stop < len(points)], start[stop < len(points)]) if inside else (h, start)


class Index:
    """Places of the keys of one block of the benchmark."""

    def __init__(self, ids: list[int | None], texts: list[str], similarity: float = SIMILARITY, recall: float = RECALL):
        self.similarity = similarity
        self.ids, self.points, self.masks = [], [], []
        same: dict[str, list[int | None]] = {}  # equal texts are looked for once
        for i, t in zip(ids, texts, strict=True):
            same.setdefault(t or "", []).append(i)
        for t, i in same.items():
            raw = np.frombuffer(t.encode(), dtype=np.uint8)
            points = _points(raw, np.array([0, len(raw)]))[0][:-1]
            points = points[:-1] if len(points) and points[-1] == 32 else points
            if len(points):
                self.ids.append(i)
                self.points.append(points)
                self.masks.append(_masks(points.tolist()))
        self.edits = [allowed(len(p), similarity) for p in self.points]
        kinds: dict[tuple, list[tuple[int, int]]] = {}
        for k, p in enumerate(self.points):
            *way, least = plan(len(p), similarity, recall)
            kinds.setdefault(tuple(way), []).append((k, least))
        self.groups: list[Group] = []
        for way, members in sorted(kinds.items()):
            members.sort(key=lambda m: self.edits[m[0]])
            room, own = 0.0, []
            for k, least in members:
                cells = max(1.0, SEGMENT / (1 << self._shift(k)))
                if own and room + cells > CELLS:
                    self.groups.append(self._group(way, own))
                    room, own = 0.0, []
                room += cells
                own.append((k, least))
            self.groups.append(self._group(way, own))

    def _shift(self, k: int) -> int:
        return max(2, (self.edits[k] - 1).bit_length() if self.edits[k] else 0)

    def _group(self, way: tuple, own: list[tuple[int, int]]) -> Group:
        which = np.array([k for k, _ in own])
        longest = max(len(self.points[k]) for k, _ in own)
        empty = np.zeros(0, np.int32)
        g = Group(*way, which, np.array(self.edits)[which], np.array([self._shift(k) for k, _ in own]), longest, np.array([n for _, n in own]), empty, empty, empty, empty)
        keys, item, place, spot = [], [], [], []
        for x, (k, _) in enumerate(own):
            for draw, (h, at) in enumerate(g.of(self.points[k], inside=True)):
                keys.append(h)
                item.append(np.full(len(h), x, dtype=np.int32))
                place.append(at.astype(np.int32))
                spot.append(at * g.times + draw)
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        g.keys, g.item, g.place, g.spot = flat[order], np.concatenate(item)[order], np.concatenate(place)[order], np.concatenate(spot)[order]
        return g

    def _candidates(self, g: Group, points: np.ndarray):
        """(item, first and end of the stretch) of every run of neighbouring diagonals that hold enough."""
        some, count, first = g.places()
        beyond = 2 * g.longest + (4 << int(g.shift.max())) + g.walk[0]
        step = max(SEGMENT, 4 * beyond)
        for start in range(0, len(points), step):
            part = points[start : start + step + beyond]
            at, h = [], []
            for keys, starts in g.of(part):
                hit = np.flatnonzero(some[keys])
                at.append(starts[hit])
                h.append(keys[hit])
            at, h = np.concatenate(at), np.concatenate(h)
            n = count[h]
            upto = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            nb = ((len(part) + g.longest) >> g.shift) + 2  # bands of each item
            base = np.concatenate([[0], np.cumsum(nb)])
            own_base, own_shift = base[:-1][g.item], g.shift[g.item].astype(np.int32)

            def pairs():
                """(key of an item, diagonal, band) of all pairs of equal keys, some at a time."""
                a = 0
                while a < len(at):
                    b = max(a + 1, int(np.searchsorted(upto, upto[a] + PAIRS, side="right")) - 1)
                    p = np.repeat((first[h[a:b]] - (upto[a:b] - upto[a])).astype(np.int32), n[a:b])
                    p += np.arange(len(p), dtype=np.int32)
                    diagonal = np.repeat((at[a:b] + g.longest).astype(np.int32), n[a:b])
                    diagonal -= g.place[p]
                    yield p, diagonal, own_base[p] + (diagonal >> own_shift[p])
                    a = b

            cells = np.zeros(int(base[-1]), dtype=np.int32)
            once = list(pairs()) if upto[-1] <= PAIRS else None
            for *_, cell in once or pairs():
                cells += np.bincount(cell, minlength=len(cells)).astype(np.int32)
            least = np.repeat(g.least, nb)
            hot = np.zeros(len(cells) + 1, dtype=bool)
            hot[:-2] = cells[:-1] + cells[1:] >= least[:-1]  # the last band of an item is empty
            if not hot.any():
                continue
            hot[1:] |= hot[:-1]
            span = 2 * (len(part) + g.longest) + (8 << int(g.shift.max()))
            keys, spots = [], []
            for p, diagonal, cell in once or pairs():
                ok = np.flatnonzero(hot[cell])
                keys.append(g.item[p[ok]].astype(np.int64) * span + diagonal[ok])
                spots.append(g.spot[p[ok]])
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            every, spot = key[order], np.concatenate(spots)[order]
            item = every // span
            enough = np.searchsorted(every, every + g.edits[item], side="right") - np.arange(len(every)) >= g.least[item]
            key, item = every[enough], item[enough]
            if not len(key):
                continue
            edits = g.edits[item]
            new = np.flatnonzero(np.append(True, key[1:] > key[:-1] + edits[:-1]))
            last = np.append(new[1:], len(key)) - 1
            lo, hi = np.searchsorted(every, key[new], side="left"), np.searchsorted(every, key[last] + edits[last], side="right")
            for r, x, y, a, b in zip(item[new].tolist(), (key % span)[new].tolist(), (key % span)[last].tolist(), lo.tolist(), hi.tolist(), strict=True):
                k = int(g.items[r])
                if len(np.unique(spot[a:b])) < g.least[r]:  # one place met often
                    continue
                low, high = start + x - g.longest, start + y - g.longest + self.edits[k]
                yield k, max(low - self.edits[k], 0), min(high + len(self.points[k]) + self.edits[k], len(points))

    def search(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int | None, int, float, int]]:
        """(row, item id, first word, similarity, distance): the best place of each item found in each row."""
        if not self.groups or not len(raw):
            return []
        points, edge = _points(raw, off)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for g in self.groups:
            for k, a, b in self._candidates(g, points):
                m, most = len(self.points[k]), self.edits[k]
                for r in range(int(np.searchsorted(edge, a, side="right")) - 1, int(np.searchsorted(edge, b, side="left"))):
                    x, y = max(a, int(edge[r])), min(b, int(edge[r + 1]) - 1)
                    held = best.get((r, k))
                    if y - x < m - most or (held and held[0] == 0):
                        continue
                    d, end = _nearest(self.masks[k], m, points[x:y].tolist(), most)
                    if d <= most and (held is None or d < held[0]):
                        best[r, k] = (d, x, x + end)
        out = []
        for (r, k), (d, x, end) in sorted(best.items()):
            m = len(self.points[k])
            back = _nearest(_masks(self.points[k][::-1].tolist()), m, points[x:end][::-1].tolist(), d, True)[1]
            word = int((points[edge[r] : end - back] == 32).sum()) + int(points[end - back] == 32)
            out += [(r, i, word, 1 - d / m, d) for i in self.ids[k]]
        return out


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Indexes of distinct texts, about ``block_bytes`` of them each, with the ids of all items that have them."""
    items = benchmark.where(F.col("text").isNotNull()).groupBy("text").agg(F.sort_array(F.collect_list(F.struct("item_id"))).alias("ids"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).orderBy("text").collect()
        yield Index([i[0] for r in rows for i in r["ids"]], [r["text"] for r in rows for _ in r["ids"]])


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, first_word, similarity, distance), one row for each document and item found in it."""
    out = None
    for index in _blocks(benchmark, block_bytes):

        def each(batches, index=index):
            for b in batches:
                doc = b.column(0)
                raw, off = tb.text_bytes(b.column(1))
                for i, _, r, o in tb.slices(raw, off):
                    found = index.search(r, o)
                    if found:
                        row, item, first, like, d = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([doc.take(pa.array([i + x for x in row])), pa.array(item, pa.int64()), pa.array(first, pa.int64()), pa.array(like, pa.float64()), pa.array(d, pa.int64())], names=["doc_id", "item_id", "first_word", "similarity", "distance"])

        part = tb.small_batches(docs).select("doc_id", "text").mapInArrow(each, "doc_id long, item_id long, first_word long, similarity double, distance long")
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs in which no item is found, with their columns. Documents are filtered where they are read."""
    for index in _blocks(benchmark, block_bytes):

        def each(raw, off, index=index):
            keep = np.ones(len(off) - 1, dtype=bool)
            keep[[x[0] for x in index.search(raw, off)]] = False
            return pa.array(keep)

        docs = tb.small_batches(docs).where(tb.of_texts(each, "boolean", F.col("text")))
    return docs
