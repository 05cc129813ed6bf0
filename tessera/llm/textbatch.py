"""Arrow string columns as flat byte arrays, and vectorised word and shingle hashing.

Words are ``[^\\x20\\x09-\\x0D]+``; A-Z are lower-cased. All of these bytes are ASCII,
so UTF-8 texts are cut safely on bytes. Nulls are read as empty texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_blas_thread() -> None:
    """Tasks already use all cores; a pool of BLAS threads for each Python process only makes them wait."""
    import ctypes
    import glob
    import os

    for lib in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            call = getattr(ctypes.CDLL(lib), name, None)
            if call is not None:
                call(1)
                break


_one_blas_thread()

#: Bytes of text worked on at once. Bounds the memory of a Python worker: temporaries take
#: about 60 times as much. A single longer text is still worked on whole.
SLICE_BYTES = 1 << 20

#: Bytes of an Arrow batch between the JVM and Python; the session's own 64 MB are held several times over on both sides.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << 16
    while size < n:
        size *= 2
    a, b = _powers(size)
    return a[:n], b[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "")
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, offsets, data = column.buffers()
    step = np.int64 if wide else np.int32
    off = np.frombuffer(offsets, dtype=step)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(off) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]]
    return raw, off - off[0]


def small_batches(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches bounded to ``BATCH_BYTES`` (a single longer row is still a batch)."""
    conf = df.sparkSession.conf
    now = re.fullmatch(r"(\d+)b?", conf.get(_BATCH_SETTING))
    if now is None or int(now[1]) > BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have (Spark does not tell upper from lower case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_id(*columns: str) -> Column:
    """128 bits that rows with equal columns share, as binary."""
    halves = (F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns)))
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def of_texts(each, returns: str, text: Column) -> Column:
    """A column worked out from the texts alone: each(bytes, offsets) gives the values of one slice as an Arrow array.

    The other columns never leave the JVM.
    """

    def call(column: pa.Array) -> pa.Array:
        raw, off = text_bytes(column)
        parts = [each(r, o) for _, _, r, o in slices(raw, off)]
        return pa.concat_arrays(parts) if parts else each(raw, off)

    call.__annotations__ = {"column": pa.Array, "return": pa.Array}
    # marked so that a filter and a column of the same name are worked out once
    return F.arrow_udf(call, returns).asNondeterministic()(text)


def slices(raw: np.ndarray, off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows, about ``most`` bytes each."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(raw: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word of every row."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off[(off >= 0) & (off <= len(raw))]] = True
    before = np.empty(len(raw), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(raw), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    row = np.searchsorted(off, starts, side="right") - 1
    return starts, ends, row


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit content hashes of the spans; equal bytes (after lower-casing) have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    pw, inv = powers(len(raw) + 1)
    c = np.empty(len(raw) + 1, dtype=np.uint64)
    c[0] = 0
    np.cumsum(((LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)) * pw[:-1], out=c[1:])
    h = (c[ends] - c[starts]) * inv[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(word: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k words; a row with fewer words gives one, its whole sequence."""
    n = len(word)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    odd = [np.uint64((0xA24BAED4963EE407 * (2 * i + 1) + 0x9FB21C651E98DF25 * i) % (1 << 64) | 1) for i in range(k)]
    m = n - k + 1
    if m > 0:
        h = word[:m] * odd[0]
        for i in range(1, k):
            h = h + mix(word[i : i + m] ^ odd[i]) * odd[i]
        full = row[:m] == row[k - 1 :]
        hs, rs = mix(h[full]), row[:m][full]
    else:
        hs, rs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(row, minlength=int(row[-1]) + 1)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.searchsorted(row, short)
        extra = []
        for r, f in zip(short.tolist(), first.tolist(), strict=True):
            h = np.uint64(count[r])
            for w in word[f : f + count[r]].tolist():
                h = mix(np.array([(int(h) * 0x9FB21C651E98DF25 + w) % (1 << 64)], dtype=np.uint64))[0]
            extra.append(h)
        hs = np.concatenate([hs, np.array(extra, np.uint64)])
        rs = np.concatenate([rs, short])
        order = np.argsort(rs, kind="stable")
        hs, rs = hs[order], rs[order]
    return hs, rs


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)
