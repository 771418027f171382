"""Spans of bytes found by other tasks are brought back to their documents and cut out.

A document is known by its id and a 63-bit tag of its text; rows that agree in both are one document. Order among documents is that
of (id, tag), null ids first. Documents are dealt to parts of a few megabytes by a hash of that pair; spans travel as packed arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from . import blocks as B

NULL_ID = -(1 << 63)
PART_BYTES = 8 << 20
KIND = "part long, ids binary, tags binary, starts binary, ends binary"
SCHEMA = pa.schema([("part", pa.int64()), ("ids", pa.binary()), ("tags", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])


def tags_of(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The tag of each text of a block, from the block's prefix sums; 63 bits, so that it keeps its order as a signed long."""
    return B.span_hashes(sums, offsets[:-1], offsets[1:]) >> np.uint64(1)


def parts_of(ids: np.ndarray, tags: np.ndarray, parts: int) -> np.ndarray:
    return (B.mix(ids.view(np.uint64) ^ tags) % np.uint64(parts)).astype(np.int64)


def by_part(parts: int, ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple]:
    """Rows of KIND for these spans."""
    return list(B.parted(parts_of(ids, tags, parts), ids, tags, starts.astype(np.uint32), ends.astype(np.uint32)))


def dealt_documents(base: DataFrame, parts: int) -> DataFrame:
    """(part, doc_id, tag, text) with compressed texts, from doc_id and text; a third column ``rest`` is carried along."""
    rest = [f"rest {f.dataType.simpleString()}" for f in base.schema.fields[2:]]

    def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        texts = B.as_bytes(batch.column(1))
        tags = np.concatenate([tags_of(B.prefix_sums(data), offsets) for _, data, offsets in B.blocks(texts)])
        ids = np.asarray(batch.column(0).fill_null(NULL_ID))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts_of(ids, tags, parts)), batch.column(0), pa.array(tags.astype(np.int64)), pa.array([squeeze.compress(t) for t in texts.to_pylist()], pa.binary()), *batch.columns[2:]],
            ["part", "doc_id", "tag", "text", *["rest" for _ in rest]],
        )

    return B.per_batch(base, deal, ", ".join(["part long, doc_id long, tag long, text binary", *rest]))


def with_rest(docs: DataFrame) -> DataFrame:
    """doc_id, text and all columns of the documents but the text as one value, so that their names do not matter."""
    return B.normal_documents(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("rest"))


def with_new_texts(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the new text and, where there is one, its ``n_chars``."""
    new = {"text": F.col("text"), **({"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})}
    return changed.select(*((new[c] if c in new else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


class Part:
    """The documents of one part, texts one after another."""

    def __init__(self, table: pa.Table) -> None:
        expand = zstandard.ZstdDecompressor()
        self.doc_ids = table["doc_id"].to_pylist()
        texts = [expand.decompress(z) for z in table["text"].to_pylist()]
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        keys = zip((NULL_ID if d is None else d for d in self.doc_ids), table["tag"].to_pylist(), strict=True)
        self.rows: dict[tuple[int, int], list[int]] = {}
        for k, key in enumerate(keys):
            self.rows.setdefault(key, []).append(k)

    def column(self) -> pa.Array:
        """The texts as an Arrow array."""
        return pa.Array.from_buffers(pa.large_binary(), len(self.doc_ids), [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)])

    def covered(self, spans: pa.Table) -> np.ndarray:
        """A flag for each byte that a span covers."""
        cover = np.zeros(len(self.data) + 1, np.int32)
        ids, tags = B.unpacked(spans["ids"], "i8"), B.unpacked(spans["tags"], "u8")
        starts, ends = B.unpacked(spans["starts"], "u4").astype(np.int64), B.unpacked(spans["ends"], "u4").astype(np.int64)
        if len(ids):
            order = np.lexsort((tags, ids))
            ids, tags, starts, ends = ids[order], tags[order], starts[order], ends[order]
            cuts = np.concatenate(([0], np.flatnonzero((ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])) + 1, [len(ids)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                for row in self.rows[(int(ids[a]), int(tags[a]))]:
                    np.add.at(cover, self.offsets[row] + starts[a:b], 1)
                    np.add.at(cover, self.offsets[row] + ends[a:b], -1)
        return np.cumsum(cover)[:-1] > 0

    def runs(self, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the maximal covered runs; they end with their text."""
        if not len(covered):
            none = np.zeros(0, np.int64)
            return none, none, none
        first = B.row_starts(self.offsets, len(covered))
        before = np.concatenate(([True], ~covered[:-1])) | first[:-1]
        after = np.concatenate((~covered[1:], [True])) | first[1:]
        starts = np.flatnonzero(covered & before)
        return starts, np.flatnonzero(covered & after) + 1, B.owners(self.offsets, starts)


def without_spans(documents: DataFrame, spans: DataFrame, shortest: int = 1, texts: bool = False) -> DataFrame:
    """Cuts covered runs of at least ``shortest`` bytes out of the dealt documents.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, the remaining text if asked for, and ``rest`` if there is one."""
    rest = [f.dataType.simpleString() for f in documents.schema if f.name == "rest"]
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        *([("text", pa.string())] if texts else []),
    ])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([], pa.schema([*schema, *(left.schema.field("rest") for _ in rest)]))
        part = Part(left)
        covered = part.covered(right)
        starts, ends, rows = part.runs(covered)
        for a, b in zip(starts[ends - starts < shortest].tolist(), ends[ends - starts < shortest].tolist(), strict=True):
            covered[a:b] = False
        kept = ends - starts >= shortest
        starts, ends, rows = starts[kept], ends[kept], rows[kept]
        count = len(part.doc_ids)
        removed = np.bincount(rows, ends - starts, count).astype(np.int64)
        left_over = []
        for a, b, gone in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), removed.tolist(), strict=True):
            left_over.append((part.data[a:b][~covered[a:b]] if gone else part.data[a:b]).tobytes())
        columns = [
            pa.array(part.doc_ids, pa.int64()), pa.array(np.diff(part.offsets)), pa.array(removed), pa.array(np.bincount(rows, minlength=count).astype(np.int64)),
            pa.array([hashlib.sha256(x).hexdigest() for x in left_over], pa.string()),
            *([pa.array([x.decode("utf-8", "replace") for x in left_over], pa.string())] if texts else []),
        ]
        out = pa.Table.from_arrays(columns, schema=schema)
        return out.append_column("rest", left["rest"]) if rest else out

    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * texts + "".join(f", rest {t}" for t in rest)
    return documents.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(run, kind)
