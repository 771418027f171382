"""Dedup of long repeated strings by winnowed anchors and hashed windows: bytes covered by a string that also starts earlier are removed.

Stands in for suffix-array dedup by prefix-free parsing and has its results: triggers play the part of its phrase bounds, but no parse is
written and no suffix array of dictionary or parse is built; windows are matched by hash and nothing is put in corpus order.

Parsing: a rolling hash runs over all 32-byte strings; a string is a trigger where its hash is the smallest of any 100-byte window.
Triggers depend on the bytes around them only and cut all texts into phrases; every 100-byte window holds a trigger, so windows can
only be equal if they stand around equal triggers.

Dictionary: the context of a trigger, all windows that hold it, is one entry; equal contexts are one entry with its first place.
Later places are repeats as a whole and need no further look. Only where one trigger has several contexts are the windows themselves
compared: the first place of each context sends its bytes, windows are grouped by 64-bit hashes, and a window is a repeat if an
equal one starts before it. Text that occurs once never gets that far, so windows are sorted (by hash, then place) only where
the text repeats.

Everything moves as packed arrays. A batch sends only its first place of each context. A trigger with very many contexts (a passage
in very many documents) sends its windows one by one, dealt by window instead of by trigger.

Defined results: a null text is empty; strings never cross documents; texts shorter than the string keep all; rows with equal id
and text are one document; documents with equal ids and other texts stand in the order of a hash of the text; null ids come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import stage
from . import blocks as B, spans as S

STRING = 100
TRIGGER = 32
MANY = 4096


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    done, out = 1, values
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(out) - (width - done)], out[width - done :]) if width > done else out


def triggers(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, string: int = STRING, width: int = TRIGGER) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the triggers in a block, and their hashes."""
    size, span = len(data), string - width + 1
    if size < string:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(size - width + 1)
    hashes = B.span_hashes(sums, at, at + width)
    lowest = sliding(hashes, span, np.minimum)
    room = np.repeat(offsets[1:], np.diff(offsets))[: len(lowest)] - np.arange(len(lowest))
    lowest = np.where(room >= string, lowest, 0)
    around = np.concatenate((np.zeros(span - 1, np.uint64), lowest, np.zeros(span - 1, np.uint64)))
    found = np.flatnonzero((sliding(around, span, np.maximum) == hashes) & (hashes != 0))
    return found, hashes[found]


def _extent(at: np.ndarray, low: np.ndarray, high: np.ndarray, string: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of all windows around triggers at ``at`` in texts from ``low`` to ``high``."""
    return np.maximum(at + width - string, low), np.minimum(at + string, high)


def found_triggers(base: DataFrame, buckets: int, parts: int, string: int, width: int) -> DataFrame:
    """Spans that are repeats as a whole, and places whose windows must be compared (``kind`` 0 and 1; 2: with many contexts)."""
    fields = (("triggers", "u8"), ("contexts", "u8"), ("ids", "i8"), ("tags", "u8"), ("ats", "u4"), ("starts", "u4"), ("ends", "u4"))
    sent = pa.schema([("bucket", pa.int64()), *((n, pa.binary()) for n, _ in fields)])
    kept = pa.schema([("kind", pa.int32()), *list(S.SCHEMA)[:3], ("ats", pa.binary()), *list(S.SCHEMA)[3:], ("triggers", pa.binary())])

    def first_places(arrays: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Entries by trigger, context and place; which are at the first place of their context."""
        trigger, context, doc, tag, at = arrays[:5]
        order = np.lexsort((at, tag, doc, context, trigger))
        arrays = [x[order] for x in arrays]
        trigger, context, doc, tag, at = arrays[:5]
        new = np.concatenate(([True], (trigger[1:] != trigger[:-1]) | (context[1:] != context[:-1])))
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        return arrays, (doc == doc[lead]) & (tag == tag[lead]) & (at == at[lead])

    def parse(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(batch.column(0).fill_null(S.NULL_ID))
        found = []
        for row, data, offsets in B.blocks(batch.column(1)):
            sums = B.prefix_sums(data)
            at, hashes = triggers(data, offsets, sums, string, width)
            if not len(at):
                continue
            own = B.owners(offsets, at)
            low, high = _extent(at, offsets[own], offsets[own + 1], string, width)
            contexts = B.mix(B.span_hashes(sums, low, high) + (at - low).astype(np.uint64))
            base_at = offsets[own]
            found.append((hashes, contexts, ids[row + own], S.tags_of(sums, offsets)[own], *((x - base_at).astype(np.uint32) for x in (at, low, high))))
        if not found:
            return
        arrays, first = first_places([np.concatenate(x) for x in zip(*found, strict=True)])
        mine = [x[first] for x in arrays]
        rows = list(B.parted((B.mix(mine[0] + np.uint64(99)) % np.uint64(buckets)).astype(np.int64), *mine))
        known = [x[~first] for x in arrays]
        none = np.zeros(0, np.uint64)
        for part, doc, tag, low, high in S.by_part(parts, known[2], known[3], known[5], known[6]):
            rows.append((part % buckets, none, none, doc, tag, none, low, high))
        yield B.packed(rows, sent)

    def resolve(table: pa.Table) -> pa.Table:
        bare = np.asarray(B.lengths(table["triggers"], 8)) == 0
        known, open_ = table.filter(pa.array(bare)), table.filter(pa.array(~bare))
        rows: list[tuple] = []

        def whole(doc: np.ndarray, tag: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            none = np.zeros(0, np.uint64)
            rows.extend((0, p, d, t, none, a, b, none) for p, d, t, a, b in S.by_part(parts, doc, tag, low, high))

        def add(kind: int, arrays: list[np.ndarray]) -> None:
            trigger, _, doc, tag, at, low, high = arrays
            rows.extend((kind, *x) for x in B.parted(S.parts_of(doc, tag, parts), doc, tag, at, low, high, trigger))

        if known.num_rows:
            doc, tag, low, high = (B.unpacked(known[c], t) for c, t in (("ids", "i8"), ("tags", "u8"), ("starts", "u4"), ("ends", "u4")))
            whole(doc, tag, low, high)
        if open_.num_rows:
            arrays, first = first_places([B.unpacked(open_[c], t) for c, t in fields])
            doc, tag, low, high = (arrays[k][~first] for k in (2, 3, 5, 6))
            whole(doc, tag, low, high)
            arrays = [x[first] for x in arrays]
            trigger, context = arrays[0], arrays[1]
            new = np.concatenate(([True], trigger[1:] != trigger[:-1]))
            group = np.cumsum(new) - 1
            fresh = np.concatenate(([True], new[1:] | (context[1:] != context[:-1])))
            count = np.bincount(group, fresh)[group]
            # Equal windows of one text that overlap have their trigger in different contexts, the first of them at the edge of the repeat.
            for kind, chosen in ((1, (count > 1) & (count <= MANY)), (2, count > MANY)):
                if chosen.any():
                    add(kind, [x[chosen] for x in arrays])
        return pa.Table.from_batches([B.packed(rows, kept)])

    kind = "bucket long, " + ", ".join(f"{n} binary" for n, _ in fields)
    out = "kind int, part long, ids binary, tags binary, ats binary, starts binary, ends binary, triggers binary"
    return B.per_batch(base, parse, kind).groupBy("bucket").applyInArrow(resolve, out)


def compared_windows(documents: DataFrame, asked: DataFrame, buckets: int, parts: int, string: int, width: int) -> DataFrame:
    """Spans of the repeated windows around the places asked for."""
    sent = pa.schema([("bucket", pa.int64()), ("triggers", pa.binary()), ("ids", pa.binary()), ("tags", pa.binary()), ("ats", pa.binary()), ("starts", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])
    span = string - width + 1

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            part = S.Part(left)
            sums = None
            kinds = np.asarray(right["kind"])
            for kind in (1, 2):
                some = right.filter(pa.array(kinds == kind))
                if not some.num_rows:
                    continue
                trigger, doc, tag, at, low, high = (B.unpacked(some[c], t) for c, t in (("triggers", "u8"), ("ids", "i8"), ("tags", "u8"), ("ats", "u4"), ("starts", "u4"), ("ends", "u4")))
                base_at = np.array([part.offsets[part.rows[key][0]] for key in zip(doc.tolist(), tag.tolist(), strict=True)], np.int64)
                if kind == 1:
                    sizes = (high - low).astype(np.int64)
                    data = part.data[_spread(base_at + low, sizes)]
                    bucket = (B.mix(trigger + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
                    ends = np.cumsum(sizes)
                    for b, where in B.parted(bucket, np.arange(len(bucket))):
                        rows.append((b, trigger[where], doc[where], tag[where], at[where], low[where], sizes[where].astype(np.uint32), data[_spread(ends[where] - sizes[where], sizes[where])]))
                    continue
                sums = B.prefix_sums(part.data) if sums is None else sums
                owner, start = _windows(low.astype(np.int64), high.astype(np.int64), string)
                window = B.mix(B.span_hashes(sums, base_at[owner] + start, base_at[owner] + start + string) ^ trigger[owner])
                bucket = (window % np.uint64(buckets)).astype(np.int64)
                none = np.zeros(0, np.uint8)
                for b, w, d, t, s in B.parted(bucket, window, doc[owner], tag[owner], start.astype(np.uint32)):
                    rows.append((b, w, d, t, none.view(np.uint32), s, none.view(np.uint32), none))
        return pa.Table.from_batches([B.packed(rows, sent)])

    def order(table: pa.Table) -> pa.Table:
        single = np.asarray(B.lengths(table["sizes"], 4)) == 0
        found = []
        lone, many = table.filter(pa.array(single)), table.filter(pa.array(~single))
        if lone.num_rows:
            found.append(tuple(B.unpacked(lone[c], t) for c, t in (("triggers", "u8"), ("ids", "i8"), ("tags", "u8"), ("starts", "u4"))))
        if many.num_rows:
            trigger, doc, tag, low, sizes, data = (B.unpacked(many[c], t) for c, t in (("triggers", "u8"), ("ids", "i8"), ("tags", "u8"), ("starts", "u4"), ("sizes", "u4"), ("data", "u1")))
            sizes = sizes.astype(np.int64)
            begin = np.cumsum(sizes) - sizes
            first = 0
            while first < len(sizes):  # a few megabytes at a time
                last = max(first + 1, int(np.searchsorted(begin, begin[first] + B.BLOCK_BYTES)))
                piece = slice(first, last)
                sums = B.prefix_sums(data[begin[first] : begin[last - 1] + sizes[last - 1]])
                owner, start = _windows(np.zeros(last - first, np.int64), sizes[piece], string)
                at = begin[piece][owner] - begin[first] + start
                window = B.mix(B.span_hashes(sums, at, at + string) ^ trigger[piece][owner])
                found.append((window, doc[piece][owner], tag[piece][owner], (low[piece][owner] + start).astype(np.uint32)))
                first = last
        if not found:
            return S.SCHEMA.empty_table()
        window, doc, tag, start = (np.concatenate(x) for x in zip(*found, strict=True))
        order_ = np.argsort(window, kind="stable")
        new = np.concatenate(([True], window[order_][1:] != window[order_][:-1]))
        twice = ~(new & np.append(new[1:], True))  # windows that stand alone are done
        order_ = order_[twice]
        window, doc, tag, start = (x[order_] for x in (window, doc, tag, start))
        if not len(window):
            return S.SCHEMA.empty_table()
        order_ = np.lexsort((start, tag, doc, window))
        window, doc, tag, start = (x[order_] for x in (window, doc, tag, start))
        new = np.concatenate(([True], window[1:] != window[:-1]))
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        later = (doc != doc[lead]) | (tag != tag[lead]) | (start != start[lead])
        doc, tag, start = doc[later], tag[later], start[later].astype(np.int64)
        # Windows that follow each other become one span.
        order_ = np.lexsort((start, tag, doc))
        doc, tag, start = doc[order_], tag[order_], start[order_]
        if not len(doc):
            return S.SCHEMA.empty_table()
        head = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + string)))
        at = np.flatnonzero(head)
        ends = start[np.append(at[1:], len(doc)) - 1] + string
        return pa.Table.from_batches([B.packed(S.by_part(parts, doc[at], tag[at], start[at], ends), S.SCHEMA)])

    kind = "bucket long, triggers binary, ids binary, tags binary, ats binary, starts binary, sizes binary, data binary"
    pieces = documents.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(fetch, kind)
    return pieces.groupBy("bucket").applyInArrow(order, S.KIND)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the bytes of many spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _windows(low: np.ndarray, high: np.ndarray, string: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows in each span: the span's number and the window's start."""
    count = high - low - string + 1
    return np.repeat(np.arange(len(low)), count), _spread(low, count)


def dedup(docs: DataFrame, string: int = STRING, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining text (bytes that no longer form a character are replaced)."""
    base = B.normal_documents(docs)
    _, size = B.text_bytes(base)
    width = min(TRIGGER, max(4, string // 3))
    parts = B.part_count(docs.sparkSession, size, S.PART_BYTES)
    found = stage(found_triggers(base, parts, parts, string, width), "phrases")
    documents = S.dealt_documents(base, parts)
    compared = compared_windows(documents, found.where(F.col("kind") > 0), parts, parts, string, width)
    spans = found.where(F.col("kind") == 0).select(*S.SCHEMA.names).unionByName(compared)
    return S.without_spans(documents, spans, 1, texts)


def op8_prefix_free(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"), texts=False)
