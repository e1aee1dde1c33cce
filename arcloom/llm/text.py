"""Whole-batch text handling in numpy: words of many documents at once, and their 64-bit hashes."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text that one numpy pass handles; a longer document makes a pass of its own.
PASS_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, a-z and every byte over 0x7F.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 256), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def passes(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, row starts)``: the rows' lower-cased UTF-8 bytes, one space after each row.

    A null counts as empty. ``row starts`` has one entry more than there are rows.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lens = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    n, i = len(lens), 0
    ends = np.cumsum(lens)
    while i < n:
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + PASS_BYTES, "right")))
        part = pc.fill_null(col.slice(i, j - i).cast(pa.large_binary()), b"")
        joined = pc.binary_join_element_wise(part, pa.scalar(b" ", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + j - i + 1]
        data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        yield i, j, LOWER[data], offsets - offsets[0]
        i = j


def word_bounds(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes."""
    m = np.zeros(len(data) + 2, np.int8)
    m[1:-1] = table[data]
    d = np.diff(m)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


#: Longest word that is hashed eight bytes at a time, and the factors of a step of two and of eight bytes.
_LONG_WORD, _TWO, _EIGHT = 64, *_powers(9)[[2, 8]]


@functools.cache
def _eights() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What two bytes add to a hash, what the zeros after n of eight bytes add, and the bits of the first n."""
    pair, p = np.arange(1 << 16, dtype=np.uint64), _powers(8)[:8]
    two = (pair & np.uint64(255)) + np.uint64(1) + ((pair >> np.uint64(8)) + np.uint64(1)) * _BASE
    after = np.array([p[n:].sum(dtype=np.uint64) for n in range(9)], np.uint64)
    return two, after, np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _sum_eights(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """`_sum_bytes` of words of some bytes: eight are read at once, and every two of them looked up."""
    two, after, keep = _eights()
    eight = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    out, word, scale = np.zeros(len(starts), np.uint64), np.arange(len(starts)), _powers(1)
    while len(word):
        n = np.minimum(lens, 8)
        pairs = (eight[starts] & keep[n]).astype("<u8", copy=False).view("<u2").reshape(-1, 4)
        own = two[pairs[:, 3]]
        for j in (2, 1, 0):
            own *= _TWO
            own += two[pairs[:, j]]
        own -= after[n]
        out[word] += own * scale
        more = np.flatnonzero(lens > 8)
        word, starts, lens, scale = word[more], starts[more] + 8, lens[more] - 8, scale * _EIGHT
    return out


def _sum_bytes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Every word's polynomial of its bytes plus one."""
    first = np.cumsum(lens) - lens
    inside = np.arange(int(lens.sum())) - np.repeat(first, lens)
    byte = data[np.repeat(starts, lens) + inside].astype(np.uint64) + np.uint64(1)
    byte *= _powers(int(lens.max()))[inside]
    return np.add.reduceat(byte, first)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``; the same bytes give the same hash everywhere."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    sums = _sum_eights(data, starts, np.minimum(lens, _LONG_WORD))
    if len(long := np.flatnonzero(lens > _LONG_WORD)):
        sums[long] = _sum_bytes(data, starts[long], lens[long])
    return mix(sums + lens.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def words(col: pa.Array, table: np.ndarray = NOT_SPACE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, word hashes, row starts in words)`` for passes over the rows."""
    for i, j, data, rows in passes(col):
        starts, ends = word_bounds(data, table)
        yield i, j, hash_words(data, starts, ends), np.searchsorted(starts, rows)


#: Rows of an Arrow batch between the JVM and a worker; at some thousand bytes a text that is a few MB.
BATCH_ROWS = 1_000


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's rows per Arrow batch to BATCH_ROWS: texts are long, the default is for numbers."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def tidy() -> None:
    """Give memory that a finished partition has freed back to the system; workers are kept and used again."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most`` bytes of ``column``, one row at least."""
    try:
        yield from _split(batches, column, most)
    finally:
        tidy()


def _split(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, i = np.cumsum(lens), 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
            yield b.slice(i, j - i)
            i = j


def documents(spark, sf_dir: str, *columns: str):
    """The named columns of the documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
