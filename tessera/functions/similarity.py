"""String similarities. Two empty strings have 1, one empty string 0.

Token and length measures are column expressions. Edit-based ones have no built-in and run in Arrow batches: each distinct pair once a
batch, all pairs of a batch side by side (``*_many``). The functions of two strings say what is computed, one pair at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bits of one integer for the places of a."""
    if len(a) < len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """2 LCS / (lengths): one minus the normalized insertion-deletion distance."""
    if not a or not b:
        return float(a == b)
    return 1.0 if a == b else 2 * _lcs(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio among the shared words and these with either side's own words."""
    if not a or not b:
        return float(a == b)
    x, y = set(a.split()), set(b.split())
    both, only_a, only_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_a or not only_b):
        return 1.0
    one, two = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    best = ratio(one, two)
    return max(best, ratio(both, one), ratio(both, two)) if both else best


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of its length in the longer, shorter windows at both ends included.

    Of two equally long strings either is the window's.
    """
    if not a or not b:
        return float(a == b)
    best = 0.0
    for s, t in ((a, b), (b, a)):
        if len(s) <= len(t):
            best = max(best, *(ratio(s, t[max(i, 0) : i + len(s)]) for i in range(1 - len(s), len(t))))
    return best


def jaro_winkler(a: str, b: str) -> float:
    """Jaro with up to four letters of common prefix at weight 0.1, where Jaro is above 0.7."""
    if not a or not b:
        return float(a == b)
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    other = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(hits, other, strict=True)) // 2
    m = len(hits)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


# --- the same measures for many pairs at once: bits of 64-bit words for the places of one string, one lane for each pair

#: Cells (place of a, place of b) worked on at once; bounds memory and keeps a step's arrays in cache.
CELLS = 1 << 21


def _matrix(strings: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points and one, padded to one width; lengths)."""
    size = np.array([len(x) for x in strings], dtype=np.int64)
    out = np.full((len(strings), max(int(size.max(initial=1)), 1)), pad, dtype=np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4") + np.uint32(1)
    return out, size


def _matches(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each character of b stands in a, as bits: pairs x places of b x words; lengths of a; lengths of b)."""
    (x, n), (y, m) = _matrix(a, 0), _matrix(b, 0xFFFFFFFF)
    if x.max(initial=0) < 255:  # the padding of b, and what is no character of a, are one number that is none of a's
        x, y = x.astype(np.uint8), np.minimum(y, 255).astype(np.uint8)
    words = -(-x.shape[1] // 64)
    equal = np.zeros((len(a), y.shape[1], 64 * words), dtype=bool)
    np.equal(y[:, :, None], x[:, None, :], out=equal[:, :, : x.shape[1]])
    return np.packbits(equal, axis=2, bitorder="little").view("<u8"), n, m


def _step(v: list[np.ndarray], at: list[np.ndarray]) -> list[np.ndarray]:
    """One character of the second string: bits of v that are 0 count the common subsequence so far."""
    out, carry = [], None
    for word, here in zip(v, at, strict=True):
        u = word & here
        total = word + u
        over = total < word
        if carry is not None:
            total = total + carry
            over |= total < carry
        carry = over.astype(np.uint64)
        out.append(total | (word & ~here))
    return out


def _chunks(a: list[str], b: list[str], cost) -> Iterator[tuple[np.ndarray, list[str], list[str]]]:
    """Pairs of about equal lengths, so many at a time that their cost stays within CELLS."""
    order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
    start = 0
    while start < len(order):
        end = start + 1
        wide, long = len(a[order[start]]), len(b[order[start]])
        while end < len(order):
            wide, long = max(wide, len(a[order[end]])), max(long, len(b[order[end]]))
            if cost(wide, long) * (end + 1 - start) > CELLS or wide > len(a[order[start]]) + 8:
                break
            end += 1
        rows = order[start:end]
        yield np.array(rows), [a[i] for i in rows], [b[i] for i in rows]
        start = end


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    out = np.zeros(len(a), dtype=np.int64)
    for rows, x, y in _chunks(a, b, lambda n, m: (64 * -(-n // 64) or 64) * max(m, 1)):
        at, _, _ = _matches(x, y)
        v = [np.full(len(x), ~np.uint64(0)) for _ in range(at.shape[2])]
        for j in range(at.shape[1]):
            v = _step(v, [at[:, j, w] for w in range(at.shape[2])])
        out[rows] = 64 * len(v) - sum(np.bitwise_count(w).astype(np.int64) for w in v)
    return out


def _decided(a: list[str], b: list[str]) -> tuple[np.ndarray, list[int]]:
    """Values of the pairs that are equal or have an empty side, and the numbers of the others."""
    out = np.array([float(x == y) for x, y in zip(a, b, strict=True)])
    return out, [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y]


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    out, rest = _decided(a, b)
    if rest:
        x, y = [a[i] for i in rest], [b[i] for i in rest]
        out[rest] = 2 * lcs_many(x, y) / np.array([len(p) + len(q) for p, q in zip(x, y, strict=True)])
    return out


def token_sort_many(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: " ".join(sorted(x.split())) for x in dict.fromkeys(a + b)}
    return ratio_many([known[x] for x in a], [known[x] for x in b])


def token_set_many(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: frozenset(x.split()) for x in dict.fromkeys(a + b)}
    out = np.zeros(len(a))
    ask, one, two, least = [], [], [], []
    for i, (p, q) in enumerate(zip(a, b, strict=True)):
        if not p or not q:
            out[i] = float(p == q)
            continue
        x, y = known[p], known[q]
        both = x & y
        if both and (len(both) == len(x) or len(both) == len(y)):
            out[i] = 1.0
            continue
        common, left, right = (" ".join(sorted(s)) for s in (both, x - y, y - x))
        ask.append(i)
        one.append(f"{common} {left}".strip())
        two.append(f"{common} {right}".strip())
        # the shared words are the start of either side, so their ratio with it needs no search
        least.append(max(2 * len(common) / (len(common) + len(s)) for s in (one[-1], two[-1])) if both else 0.0)
    if ask:
        out[ask] = np.maximum(ratio_many(one, two), least)
    return out


def _windows(short: list[str], long: list[str]) -> np.ndarray:
    """Best ratio of each short string, all of one length, with the windows of its length in the long one.

    A whole window takes a search of its own. Those that an end cuts short are the starts of the long string, or of both strings read
    backwards, and one search passes through all of them.
    """
    at, n, m = _matches(short, long)
    size, words = int(n[0]), at.shape[2]
    common = lambda v: 64 * words - sum(np.bitwise_count(w).astype(np.int64) for w in v)
    starts = np.arange(at.shape[1] - size + 1)
    v = [np.full((len(short), len(starts)), ~np.uint64(0)) for _ in range(words)]
    for r in range(size):
        v = _step(v, [at[:, r : r + len(starts), w] for w in range(words)])
    best = np.where(starts <= m[:, None] - size, 2 * common(v) / (2 * size), 0.0).max(axis=1)
    for ends in (at, _matches([s[::-1] for s in short], [s[::-1] for s in long])[0]):
        v = [np.full(len(short), ~np.uint64(0)) for _ in range(words)]
        for r in range(size - 1):
            v = _step(v, [ends[:, r, w] for w in range(words)])
            best = np.maximum(best, 2 * common(v) / (r + 1 + size))
    return best


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    out, rest = _decided(a, b)
    by_size: dict[int, list[tuple[int, str, str]]] = {}
    cells = lambda n, m: 64 * -(-n // 64) * m
    for i in rest:
        s, t = (a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i])
        if s in t:
            out[i] = 1.0
            continue
        by_size.setdefault(len(s), []).append((i, s, t))
        if len(s) == len(t):
            by_size[len(s)].append((i, t, s))
    for size, pairs in by_size.items():
        pairs.sort(key=lambda p: len(p[2]))
        start = 0
        while start < len(pairs):
            end = start + 1
            while end < len(pairs) and cells(size, len(pairs[end][2])) * (end + 1 - start) <= CELLS and len(pairs[end][2]) <= len(pairs[start][2]) + 8:
                end += 1
            part = pairs[start:end]
            np.maximum.at(out, [i for i, _, _ in part], _windows([s for _, s, _ in part], [t for _, _, t in part]))
            start = end
    return out


def _jaro_winkler_chunk(a: list[str], b: list[str]) -> np.ndarray:
    """Pairs of which b has 64 characters at most."""
    at, m, n = _matches(b, a)
    one = np.uint64(1)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    used, hit = np.zeros(len(a), dtype=np.uint64), np.zeros((len(a), at.shape[1]), dtype=bool)
    below = lambda k: np.where(k >= 64, ~np.uint64(0), (one << np.minimum(k, 63).astype(np.uint64)) - one)
    for i in range(at.shape[1]):
        free = at[:, i, 0] & ~used & below(np.minimum(m, i + reach + 1)) & ~below(np.maximum(i - reach, 0))
        free = np.where(i < n, free, np.uint64(0))
        used |= free & (~free + one)
        hit[:, i] = free != 0
    taken = np.unpackbits(used.astype("<u8").view(np.uint8).reshape(len(a), 8), axis=1, bitorder="little").astype(bool)
    x, y = _matrix(a, 0)[0].astype(np.int64), _matrix(b, 0)[0].astype(np.int64)
    count = hit.sum(axis=1)
    order = lambda codes_, flags: np.take_along_axis(codes_, np.argsort(~flags, axis=1, kind="stable"), axis=1)
    width = int(count.max(initial=0))
    p, q = order(x, hit)[:, :width], order(y, taken[:, : y.shape[1]])[:, :width]
    swaps = ((p != q) & (np.arange(width) < count[:, None])).sum(axis=1) // 2
    some = np.maximum(count, 1)
    jaro = np.where(count > 0, (count / n + count / m + (count - swaps) / some) / 3, 0.0)
    w = min(4, x.shape[1], y.shape[1])
    same = (x[:, :w] == y[:, :w]) & (np.arange(w) < np.minimum(n, m)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


def jaro_winkler_many(a: list[str], b: list[str]) -> np.ndarray:
    out, rest = _decided(a, b)
    brief = [i for i in rest if len(b[i]) <= 64]
    for i in set(rest) - set(brief):
        out[i] = jaro_winkler(a[i], b[i])
    if brief:
        x, y = [a[i] for i in brief], [b[i] for i in brief]
        found = np.zeros(len(brief))
        for rows, p, q in _chunks(x, y, lambda n, m: 64 * max(n, 1)):
            found[rows] = _jaro_winkler_chunk(p, q)
        out[brief] = found
    return out


def _column(many: Callable[[list[str], list[str]], np.ndarray]) -> Callable[[Column, Column], Column]:
    def measure(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = list(zip(*([x or "" for x in c.to_pylist()] for c in (a, b)), strict=True))
        number = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
        values = many([p[0] for p in number], [p[1] for p in number]) if number else np.zeros(0)
        return pa.array(values[[number[p] for p in pairs]] if pairs else values, pa.float64())

    measure.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    call = F.arrow_udf(measure, "double")
    return lambda a, b: call(a, b)


def ratio_column(a: Column, b: Column) -> Column:
    return _column(ratio_many)(a, b)


def token_sort_column(a: Column, b: Column) -> Column:
    return _column(token_sort_many)(a, b)


def token_set_column(a: Column, b: Column) -> Column:
    return _column(token_set_many)(a, b)


def partial_column(a: Column, b: Column) -> Column:
    return _column(partial_many)(a, b)


def jaro_winkler_column(a: Column, b: Column) -> Column:
    return _column(jaro_winkler_many)(a, b)


def _sides(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(value)


def jaccard(a: Column, b: Column) -> Column:
    x, y = F.split(a, " "), F.split(b, " ")
    return _sides(a, b, F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def exact(a: Column, b: Column) -> Column:
    return ((a == b) & (a != "")).cast("double")


def length_ratio(a: Column, b: Column) -> Column:
    x, y = F.char_length(a), F.char_length(b)
    return _sides(a, b, F.least(x, y) / F.greatest(x, y))
