"""I-Match fingerprints over several randomised lexicons.

The lexicon holds the words whose inverse document frequency lies in a band. A lexicon subset keeps a random part of it; the
fingerprint of a text has one signature per subset: the hash of the text's distinct, sorted words in that subset. The subsets thin
out in steps (all words, a half, a quarter, ...), several of each: the dense ones tell equal word sets apart, the thin ones still
agree when a part of a text has changed.

The band is given as document frequencies relative to all documents. As the frequencies of all words add up to the mean number of
distinct words of a text, at most that mean divided by the lower edge can lie in the band, whatever the corpus: with the defaults
a few hundred thousand 8-byte hashes. That bound is checked before the lexicon is broadcast.

Defined results: a null text is an empty one; a text without a word of the band uses all its words; a text without words has
empty signatures. Equal texts have equal fingerprints. Documents with equal ids stand in the order of their texts; a null id comes
after all others. The only document is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from . import blocks as B

LOWEST_SHARE, HIGHEST_SHARE = 0.001, 0.1
STEPS, EACH = 11, 8
BUCKET_BYTES = 8 << 20


def document_counts(docs: DataFrame) -> DataFrame:
    """Number of documents that hold each word: (bucket, words, counts), arrays of 64-bit hashes and counts.

    Counts are added up per batch first; a batch sends one packed array to each bucket, so a frequent word costs one entry per
    batch."""
    rows, size = B.text_bytes(docs)
    buckets = np.uint64(B.part_count(docs.sparkSession, size, BUCKET_BYTES))
    schema = pa.schema([("bucket", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        for _, data, offsets in B.blocks(batch.column(0)):
            codes, owner = B.hashed_words(data, offsets)
            seen.append(B.distinct_pairs(owner, codes)[1])
        words, counts = np.unique(np.concatenate(seen), return_counts=True)
        yield B.packed(list(B.parted((words % buckets).astype(np.int64), words, counts.astype(np.uint32))), schema)

    def total(table: pa.Table) -> pa.Table:
        words, at = np.unique(B.unpacked(table["words"], "u8"), return_inverse=True)
        counts = np.bincount(at, B.unpacked(table["counts"], "u4"), len(words)).astype(np.int64)
        return pa.Table.from_batches([B.packed([(table["bucket"][0].as_py(), words, counts)], schema)])

    kind = "bucket long, words binary, counts binary"
    parts = B.per_batch(docs.select("text"), count, kind)
    return parts.groupBy("bucket").applyInArrow(total, kind)


def lexicon(docs: DataFrame, rows: int, lowest: float = LOWEST_SHARE, highest: float = HIGHEST_SHARE) -> np.ndarray:
    """Sorted hashes of the words that at least ``lowest`` and at most ``highest`` of all documents hold (two documents at least)."""
    least, most = max(2.0, lowest * rows), highest * rows
    schema = pa.schema([("words", pa.binary()), ("total", pa.int64())])

    def chosen(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, counts = B.unpacked(batch.column(0), "u8"), B.unpacked(batch.column(1), "i8")
        yield B.packed([(words[(counts >= least) & (counts <= most)], int(counts.sum()))], schema)

    found = B.per_batch(document_counts(docs).select("words", "counts"), chosen, "words binary, total long").toArrow()
    words = np.sort(B.unpacked(found["words"], "u8"))
    bound = sum(found["total"].to_pylist()) / least if found.num_rows else 0
    if len(words) > bound:
        raise AssertionError(f"{len(words)} words in the band, at most {bound:.0f} can be")
    return words


def signatures(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, steps: int = STEPS, each: int = EACH) -> np.ndarray:
    """A row for each text, a column for each lexicon subset; 0 is the signature of no word."""
    codes, owner = B.hashed_words(data, offsets)
    owner, codes, _ = B.distinct_pairs(owner, codes)
    rows = len(offsets) - 1
    known = np.zeros(len(codes), bool)
    if len(words):
        at = np.minimum(np.searchsorted(words, codes), len(words) - 1)
        known = words[at] == codes
    bare = np.bincount(owner[known], minlength=rows) == 0
    keep = known | bare[owner]
    owner, codes = owner[keep], codes[keep]
    out = np.zeros((rows, steps * each), np.uint32)
    for e in range(each):
        draw = B.mix(codes ^ np.uint64(0xA5A5A5A5 + 7919 * e))
        # The hash of a sorted set as the sum of scrambled members: the order of the words does not matter.
        member = B.mix(draw + np.uint64(0x51ED27))
        for s in range(steps):
            inside = (draw >> np.uint64(64 - s)) == 0 if s else np.ones(len(draw), bool)
            who, what = owner[inside], member[inside]
            sums = np.zeros(len(what) + 1, np.uint64)
            np.cumsum(what, out=sums[1:])
            cuts = np.searchsorted(who, np.arange(rows + 1))
            out[:, e * steps + s] = (sums[cuts[1:]] - sums[cuts[:-1]]) >> np.uint64(32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signatures among those that are not empty on both sides; 1 for two fingerprints without any word."""
    some = (a != 0) | (b != 0)
    count = some.sum(axis=1)
    return np.where(count == 0, 1.0, ((a == b) & some).sum(axis=1) / np.maximum(count, 1))


def as_text(fingerprints: np.ndarray) -> list[str]:
    width = fingerprints.shape[1] * 8
    hexed = fingerprints.astype(">u4").tobytes().hex()
    return [hexed[k : k + width] for k in range(0, len(hexed), width)]


def fingerprints(docs: DataFrame, lowest: float = LOWEST_SHARE, highest: float = HIGHEST_SHARE) -> DataFrame:
    """doc_id and fingerprint of every document."""
    base = B.normal_documents(docs)
    words = docs.sparkSession.sparkContext.broadcast(lexicon(base, B.text_bytes(base)[0], lowest, highest))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints: list[str] = []
        for _, data, offsets in B.blocks(batch.column(1)):
            prints += as_text(signatures(data, offsets, words.value))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return B.per_batch(base, run, "doc_id long, fingerprint string")


def _neighbours(base: DataFrame, parts: int) -> DataFrame:
    """Documents in ranges of descending ids: (part, place, doc_id, text), texts compressed.

    A range also gets the first documents of the range below it, as ``place`` 1, so that every document's next one is in its
    range. Ranges are cut at quantiles of the ids; one row per range tells which ids come first below."""
    spark = base.sparkSession
    ids = base.select(F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("place_id"))
    edges = sorted(set(ids.approxQuantile("place_id", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    bounds = spark.sparkContext.broadcast(np.array([int(x) for x in edges], np.int64))

    def first_of_range(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = np.asarray(batch.column(0))
        below, at = np.unique(np.searchsorted(bounds.value, places, "right"), return_inverse=True)
        most = np.full(len(below), -(1 << 63), np.int64)
        np.maximum.at(most, at, places)
        yield pa.RecordBatch.from_arrays([pa.array(below.astype(np.int64)), pa.array(most)], ["below", "guest"])

    ranges = B.per_batch(ids, first_of_range, "below long, guest long").groupBy("below").agg(F.max("guest").alias("guest"))
    above = F.lead("below").over(Window.orderBy("below"))  # one row per range
    guests = ranges.select("guest", F.coalesce(above, F.min("below").over(Window.partitionBy())).alias("host")).collect()
    hosts = spark.sparkContext.broadcast({int(r["guest"]): int(r["host"]) for r in guests})

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc_ids = batch.column(0)
        places = np.asarray(doc_ids.fill_null(-(1 << 63)))
        own = np.searchsorted(bounds.value, places, "right")
        squeeze = zstandard.ZstdCompressor(level=1)
        texts = [squeeze.compress(t) for t in B.as_bytes(batch.column(1)).to_pylist()]
        sent = [k for k, x in enumerate(places.tolist()) if x in hosts.value]
        take = np.concatenate((np.arange(len(texts)), np.array(sent, np.int64))).astype(np.int64)
        to = np.concatenate((own, np.array([hosts.value[int(places[k])] for k in sent], np.int64))).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(to), pa.array(np.repeat([0, 1], [len(texts), len(sent)]).astype(np.int32)), doc_ids.take(pa.array(take)), pa.array([texts[k] for k in take], pa.binary())],
            ["part", "place", "doc_id", "text"],
        )

    return B.per_batch(base, pack, "part long, place int, doc_id long, text binary")


def edited(text: bytes, following: bytes) -> bytes:
    """``text`` with its last half replaced by the first as many characters of ``following``."""
    own, other = text.decode("utf-8", "replace"), following.decode("utf-8", "replace")
    half = len(own) // 2
    return (own[: len(own) - half] + other[:half]).encode("utf-8", "replace")


def with_edits(docs: DataFrame, lowest: float = LOWEST_SHARE, highest: float = HIGHEST_SHARE) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and their likeness to these and to the next document's."""
    base = B.normal_documents(docs)
    rows, size = B.text_bytes(base)
    context = docs.sparkSession.sparkContext
    words = context.broadcast(lexicon(base, rows, lowest, highest))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def prints(texts: list[bytes]) -> np.ndarray:
        return np.concatenate([signatures(data, offsets, words.value) for _, data, offsets in B.blocks(pa.array(texts, pa.large_binary()))])

    def piece(ids: list, texts: list[bytes], mine: int) -> pa.RecordBatch:
        """``texts`` holds the next document of the last of the ``mine`` first ones as well."""
        changed = [edited(texts[k], texts[k + 1]) for k in range(mine)]
        before, after = prints(texts), prints(changed)
        own = before[:mine]
        return pa.RecordBatch.from_arrays([
            pa.array(ids[:mine], pa.int64()), pa.array([len(t.decode("utf-8", "replace")) for t in texts[:mine]], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed]), pa.array(as_text(own)), pa.array(as_text(after)),
            pa.array(likeness(own, after)), pa.array(likeness(own, before[1 : mine + 1])),
        ], schema=schema)

    def run(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor()
        ids, places = table["doc_id"].to_pylist(), table["place"].to_pylist()
        texts = [expand.decompress(z) for z in table["text"].to_pylist()]
        # Descending ids, null last; equal ids by text. Guests come after all documents of the range.
        order = sorted(range(len(ids)), key=lambda k: (places[k], ids[k] is None, -(ids[k] or 0), texts[k]))
        mine, out, first = places.count(0), [], 0
        while first < mine:
            last, held = first, 0
            while last < mine and (last == first or held < B.BLOCK_BYTES):
                held += len(texts[order[last]])
                last += 1
            picked = order[first : last + 1]
            out.append(piece([ids[k] for k in picked], [texts[k] for k in picked], last - first))
            first = last
        return pa.Table.from_batches(out, schema)

    parts = _neighbours(base, B.part_count(docs.sparkSession, size, BUCKET_BYTES))
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return parts.groupBy("part").applyInArrow(run, kind)


def op1_imatch(docs: DataFrame) -> DataFrame:
    return with_edits(docs.select("doc_id", "text"))
