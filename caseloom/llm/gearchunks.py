"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes; where its top bits are zero, and no such place lies shortly before, a chunk ends. The rule looks at
the last bytes only, so the same passage is cut alike wherever it stands and whatever was inserted before it. The first chunk with a
digest (smallest document, then position) stays; of the others, runs of neighbouring duplicates of ``shortest`` bytes or more go.

Chunks travel to their digest's bucket as packed arrays. A batch sends only its first chunk with a digest; the others are known to be
repeats at once and skip the bucket, so a passage that stands in a third of all documents does not burden one task.

Defined results: a null text is empty; chunks never cross documents; rows with equal id and text are one document and do not remove
each other; cuts fall between characters; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B, spans as S

WINDOW = 32
CUT_BITS = 4
LEAST_GAP = 12
LONGEST = 64
SHORTEST_RUN = 100
_GEAR = (B.mix(np.arange(1000, 1256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: byte codes shifted by one for every byte that follows, over 32 bytes."""
    out = _GEAR[data]
    width = 1
    while width < WINDOW:  # sums of 2, 4, ... bytes from sums of half as many
        wider = out.copy()
        wider[width:] += out[:-width] << np.uint32(width)
        out, width = wider, 2 * width
    return out


def chunk_starts(data: np.ndarray, offsets: np.ndarray, bits: int = CUT_BITS, gap: int = LEAST_GAP, longest: int = LONGEST) -> np.ndarray:
    """Where chunks start, text starts included."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    hits = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - bits) == 0) + 1
    hits = hits[hits < size]
    own = B.owners(offsets, hits)
    # Within the first window of a text the hash would depend on its neighbour.
    hits = hits[hits - offsets[own] >= WINDOW]
    if len(hits):
        lone = np.concatenate(([True], np.diff(hits) >= gap))
        hits = hits[lone]
        hits = hits[(data[hits] & 0xC0) != 0x80]
    texts = offsets[:-1][np.diff(offsets) > 0]
    starts = np.unique(np.concatenate((texts, hits)))
    sizes = np.diff(np.append(starts, size))
    long = np.flatnonzero(sizes > longest)
    if len(long):
        count = (sizes[long] - 1) // longest
        more = np.repeat(starts[long], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + 1) * longest
        for _ in range(3):
            more = more - ((data[more] & 0xC0) == 0x80)
        starts = np.unique(np.concatenate((starts, more)))
    return starts


def repeated_chunks(base: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Spans of all chunks that have an equal chunk before them, as rows of ``spans.KIND``."""
    schema = pa.schema([("bucket", pa.int64()), ("digests", pa.binary()), *list(S.SCHEMA)[1:]])

    def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(batch.column(0).fill_null(S.NULL_ID))
        found = []
        for row, data, offsets in B.blocks(batch.column(1)):
            starts = chunk_starts(data, offsets)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(data))
            sums = B.prefix_sums(data)
            own = B.owners(offsets, starts)
            digests = B.span_hashes(sums, starts, ends)
            found.append((digests, ids[row + own], S.tags_of(sums, offsets)[own], (starts - offsets[own]).astype(np.uint32), (ends - offsets[own]).astype(np.uint32)))
        if not found:
            return
        digests, doc, tag, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, tag, doc, digests))
        digests, doc, tag, start, end = (x[order] for x in (digests, doc, tag, start, end))
        first = first_of(digests, doc, tag, start)
        # The bucket comes from other bits than the digest's order, so digests of a bucket differ in more than 64 bits in effect.
        bucket = (B.mix(digests[first] + np.uint64(99)) % np.uint64(buckets)).astype(np.int64)
        rows = list(B.parted(bucket, digests[first], doc[first], tag[first], start[first], end[first]))
        known = ~first
        empty = np.zeros(0, np.uint64)
        rows += [(part % buckets, empty, *arrays) for part, *arrays in S.by_part(parts, doc[known], tag[known], start[known], end[known])]
        yield B.packed(rows, schema)

    def repeats(table: pa.Table) -> pa.Table:
        bare = np.asarray(B.lengths(table["digests"], 8)) == 0
        known, open_ = table.filter(pa.array(bare)), table.filter(pa.array(~bare))
        out = S.by_part(parts, *(B.unpacked(known[c], t) for c, t in (("ids", "i8"), ("tags", "u8"), ("starts", "u4"), ("ends", "u4")))) if known.num_rows else []
        if open_.num_rows:
            digests, doc, tag, start, end = (B.unpacked(open_[c], t) for c, t in (("digests", "u8"), ("ids", "i8"), ("tags", "u8"), ("starts", "u4"), ("ends", "u4")))
            order = np.lexsort((start, tag, doc, digests))
            digests, doc, tag, start, end = (x[order] for x in (digests, doc, tag, start, end))
            again = ~first_of(digests, doc, tag, start)
            out += S.by_part(parts, doc[again], tag[again], start[again], end[again])
        return pa.Table.from_batches([B.packed(out, S.SCHEMA)])

    kind = "bucket long, digests binary, ids binary, tags binary, starts binary, ends binary"
    return B.per_batch(base, chunks, kind).groupBy("bucket").applyInArrow(repeats, S.KIND)


def first_of(digests: np.ndarray, doc: np.ndarray, tag: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of entries sorted by digest and place: those at the first place of their digest."""
    new = np.concatenate(([True], digests[1:] != digests[:-1]))
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (doc == doc[lead]) & (tag == tag[lead]) & (start == start[lead])


def dedup(docs: DataFrame, shortest: int = SHORTEST_RUN, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining text of every document."""
    base = B.normal_documents(docs)
    _, size = B.text_bytes(base)
    parts = B.part_count(docs.sparkSession, size, S.PART_BYTES)
    return S.without_spans(S.dealt_documents(base, parts), repeated_chunks(base, parts, parts), shortest, texts)


def cleaned(docs: DataFrame, shortest: int = SHORTEST_RUN) -> DataFrame:
    """The documents with repeated passages cut out; columns as they were."""
    _, size = B.text_bytes(docs)
    parts = B.part_count(docs.sparkSession, size, S.PART_BYTES)
    repeated = repeated_chunks(B.normal_documents(docs), parts, parts)
    return S.with_new_texts(docs, S.without_spans(S.dealt_documents(S.with_rest(docs), parts), repeated, shortest, texts=True))


def op10_gear_chunks(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"), texts=False)
