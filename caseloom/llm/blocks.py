"""Texts of Arrow batches as byte arrays, vectorised word hashes, and packed exchange of arrays between tasks.

All functions work on one block of a task; blocks hold about a megabyte of text, so the arrays stay small however long the
partition is (one text longer than a block is a block of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
# White space that separates words: tab to carriage return, and the space. Fixed values.
SPACES = (9, 10, 11, 12, 13, 32)
WORD = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_LOWER_CODES = _BYTE_CODES[LOWER]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for k, base in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any span of ``data`` in constant time."""
    power, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER_CODES if lower else _BYTE_CODES)[data] * power[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal bytes have equal hashes wherever they stand."""
    _, inverse = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def sequence_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` neighbouring codes."""
    count = max(0, len(codes) - width + 1)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out = out * _BASE + codes[k : k + count]
    return mix(out)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string or binary column as one array with 64-bit offsets; nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large binary array, and the offsets of its rows in them (one more than rows)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first row, bytes, offsets) of pieces of about ``most`` bytes."""
    data, offsets = buffers(as_bytes(column))
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def owners(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offsets, positions, "right") - 1


def row_starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """A flag for each byte: the first one of its row."""
    flags = np.zeros(length + 1, bool)
    flags[offsets[:-1]] = True
    flags[length] = True
    return flags


def word_spans(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words (runs of bytes that are not white space)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~spaces[data]
    first = row_starts(offsets, len(data))
    before = np.concatenate(([True], ~inside[:-1])) | first[:-1]
    after = np.concatenate((~inside[1:], [True])) | first[1:]
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    return starts, ends, owners(offsets, starts)


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z as a-z, and their rows."""
    starts, ends, rows = word_spans(data, offsets)
    return span_hashes(prefix_sums(data, lower=True), starts, ends), rows


def distinct_pairs(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) pairs in order, and how often each occurs."""
    if not len(rows):
        return rows, codes, np.zeros(0, np.int64)
    order = np.lexsort((codes, rows))
    rows, codes = rows[order], codes[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])))
    at = np.flatnonzero(new)
    return rows[at], codes[at], np.diff(np.append(at, len(rows)))


def parted(parts: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """(part, slice of each array) for every part that has entries; the order within a part is kept."""
    if not len(parts):
        return
    order = np.argsort(parts, kind="stable")
    parts, arrays = parts[order], [a[order] for a in arrays]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(parts[a]), *(x[a:b] for x in arrays)


def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows of integers and arrays as a record batch; arrays become binary values."""
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array([x.tobytes() if isinstance(x, np.ndarray) else x for x in c], f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def unpacked(column: pa.Array | pa.ChunkedArray, dtype: str) -> np.ndarray:
    """The arrays of a binary column, one after another."""
    return buffers(as_bytes(column))[0].view(dtype) if len(column) else np.zeros(0, dtype)


def squeezed(values: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers as a compressed value, like bytes of all numbers together; ``ordered`` integers as their differences."""
    values = np.diff(values, prepend=values.dtype.type(0)) if ordered else values
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def expanded(value: bytes, dtype: str, ordered: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    values = np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if ordered else values


def lengths(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The number of entries in each array of a binary column."""
    return np.diff(buffers(as_bytes(column))[1]) // width


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def normal_documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as bigint and the text, null texts as empty ones; further columns on request."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def text_bytes(docs: DataFrame) -> tuple[int, int]:
    """Rows and bytes of all texts."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def part_count(spark: SparkSession, size: int, each: int) -> int:
    """Parts of about ``each`` bytes for ``size`` bytes, at least one for every task that can run at once."""
    return max(spark.sparkContext.defaultParallelism, -(-size // each), 1)
