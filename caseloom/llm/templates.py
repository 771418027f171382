"""Line dedup by a log-template tree: recurring templates are dropped from all documents but the first that has them.

The tree has a fixed depth: a line goes by its number of tokens, then by its first three tokens, to a leaf; tokens with a digit count
as a variable field. In a leaf, a token that recurs at its position stays, any other becomes a variable field too; if few tokens do,
the line's template is what remains, else the line is a template of its own. A template recurs if it stands in at least ``least``
documents of as many different contents (a hash of all words of the document, none masked): a header or licence line does, and so do
the lines of forms and logs that differ in their fields only; a line of a document that has merely been copied does not.

A line of ``LEAST_WORDS`` words or more that stands word for word in two unrelated documents recurs as well. Documents are unrelated if
they do not share half of the lines of the one with fewer lines, so near copies do not empty each other here. Each document of a line
is compared with the one with most and the one with fewest lines among them.

Leaves, lines, tokens of a leaf and templates are counted by key after adding up per part or per task, so no leaf, line or template is
brought together in one task, however frequent. A part sends at most ``least`` contents of a leaf and two of a line, enough to decide.

Defined results: lines end at line feeds, and a dropped line takes one with it; lines without tokens are kept; the first document (of a
template or, if only that recurs, of a line) is the one with the smallest id (null first), among equal ids by a hash of the text; rows with equal id and text are one document; a text of
which all lines go becomes empty, its row stays; a null text becomes empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import stage
from . import blocks as B, spans as S

DEPTH = 3
LEAST = 10
LEAST_WORDS = 5
LEAST_CONSTANT = 0.8
LEAVES, EXACT = 0, 1
VARIABLE = np.uint64(0x7A5EED)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """The lines of the texts of a block: bounds, rows, leaves, hashes of their words and of their texts, and of their masked tokens."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        breaks = data == 10
        first = B.row_starts(offsets, len(data))[:-1]
        begins = first.copy()
        begins[1:] |= breaks[:-1]
        self.starts = np.flatnonzero(begins)
        self.rows = B.owners(offsets, self.starts)
        following = np.append(self.starts[1:], len(data))
        self.ends = np.minimum(following, offsets[self.rows + 1])  # with the line feed
        words, ends, _ = B.word_spans(data, offsets)
        digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
        self.tokens = np.where(digits[ends] > digits[words], VARIABLE, B.span_hashes(B.prefix_sums(data), words, ends))
        at = np.searchsorted(words, self.starts)
        self.first, self.sizes = at, np.diff(np.append(at, len(words)))
        leaf = B.mix(self.sizes.astype(np.uint64))
        padded = np.append(self.tokens, np.zeros(DEPTH, np.uint64))
        for k in range(DEPTH):
            leaf = B.mix(leaf * np.uint64(31) + np.where(self.sizes > k, padded[np.minimum(at + k, len(padded) - 1)], 0))
        self.leaves = leaf
        self.exact = self._exact(B.span_hashes(B.prefix_sums(data), words, ends))
        self.contents = self._contents(len(offsets) - 1)

    def _exact(self, words: np.ndarray) -> np.ndarray:
        """A hash of the words of each line, nothing masked."""
        order = np.arange(len(words)) - np.repeat(self.first, self.sizes)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(B.mix(words) * (order.astype(np.uint64) * np.uint64(2) + np.uint64(1)))))
        return B.mix(sums[self.first + self.sizes] - sums[self.first] + self.sizes.astype(np.uint64))

    def _contents(self, rows: int) -> np.ndarray:
        """For each line, a hash of all lines of its text, own words and variable fields included: equal for copies of a text,
        different for texts with a field or a line of their own."""
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.where(self.sizes > 0, B.mix(self.exact), np.uint64(0)))))
        cuts = np.searchsorted(self.rows, np.arange(rows + 1))
        return B.mix(sums[cuts[1:]] - sums[cuts[:-1]])[self.rows]

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What goes with each line: its line feed, or the one before if it has none."""
        closed = data[self.ends - 1] == 10
        return np.where(closed | (self.starts == offsets[self.rows]), self.starts, self.starts - 1), self.ends


def recurring_keys(documents: DataFrame, buckets: int, least: int) -> DataFrame:
    """(part, kind, keys): for each part those of its leaves that have at least ``least`` contents in all documents, and those of its
    lines of ``LEAST_WORDS`` words or more that have at least two."""
    asked = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("contents", pa.binary())])
    told = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary())])
    enough = {LEAVES: least, EXACT: 2}

    def ask(table: pa.Table) -> pa.Table:
        part = S.Part(table)
        found: dict[int, list] = {LEAVES: [], EXACT: []}
        for _, data, offsets in B.blocks(part.column()):
            lines = Lines(data, offsets)
            for kind, keys, some in ((LEAVES, lines.leaves, lines.sizes > 0), (EXACT, lines.exact, lines.sizes >= LEAST_WORDS)):
                found[kind].append((keys[some], lines.contents[some]))
        number, rows = table["part"][0].as_py(), []
        for kind, pairs in found.items():
            key, content, _ = B.distinct_pairs(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
            new = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
            place = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            key, content = key[place < enough[kind]], content[place < enough[kind]]
            rows += [(b, kind, number, x, y) for b, x, y in B.parted((key % np.uint64(buckets)).astype(np.int64), key, content)]
        return pa.Table.from_batches([B.packed(rows, asked)])

    def decide(table: pa.Table) -> pa.Table:
        key, content, kind = B.unpacked(table["keys"], "u8"), B.unpacked(table["contents"], "u8"), table["kind"][0].as_py()
        from_part = np.repeat(np.asarray(table["part"]), np.asarray(B.lengths(table["keys"], 8)))
        values, counts = np.unique(B.distinct_pairs(key, content)[0], return_counts=True)
        often = values[counts >= enough[kind]]
        chosen = np.isin(key, often)
        rows = [(p, kind, np.unique(x)) for p, x in B.parted(from_part[chosen], key[chosen])]
        return pa.Table.from_batches([B.packed(rows, told)])

    requests = documents.groupBy("part").applyInArrow(ask, "bucket long, kind int, part long, keys binary, contents binary")
    return requests.groupBy("bucket", "kind").applyInArrow(decide, "part long, kind int, keys binary")


def candidate_lines(documents: DataFrame, recurring: DataFrame) -> DataFrame:
    """Every line of a recurring leaf or recurring word for word: id, tag, start, end, leaf, content, line (hash), its masked tokens (hashes;
    null if the leaf does not recur), exact (hash of the words; null if they do not recur), the number of distinct lines of its document and,
    with the first such line of each document, ``all``: the hashes of these lines."""
    schema = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("leaf", pa.int64()), ("content", pa.int64()), ("line", pa.int64()), ("exact", pa.int64()), ("lines", pa.int64()), ("all", pa.binary()), ("tokens", pa.list_(pa.int64()))])

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        part = S.Part(left)
        often, twice = (B.unpacked(right.filter(pa.array(np.asarray(right["kind"]) == kind))["keys"], "u8") for kind in (LEAVES, EXACT))
        ids = np.array([S.NULL_ID if d is None else d for d in part.doc_ids], np.int64)
        tags = np.asarray(left["tag"])
        out = []
        for row, data, offsets in B.blocks(part.column()):
            lines = Lines(data, offsets)
            by_leaf, by_words = (lines.sizes > 0) & np.isin(lines.leaves, often), (lines.sizes >= LEAST_WORDS) & np.isin(lines.exact, twice)
            at = np.flatnonzero(by_leaf | by_words)
            if not len(at):
                continue
            start, end = (x[at] for x in lines.cuts(data, offsets))
            own, sizes = lines.rows[at], lines.sizes[at]
            ends = np.cumsum(sizes)
            tokens = lines.tokens[np.arange(ends[-1]) + np.repeat(lines.first[at] - (ends - sizes), sizes)]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(B.mix(tokens) * (np.arange(len(tokens), dtype=np.uint64) - np.repeat(ends - sizes, sizes).astype(np.uint64) + np.uint64(1)))))
            line = B.mix(sums[ends] - sums[ends - sizes]) ^ lines.leaves[at]
            some = lines.sizes > 0
            doc, of_doc, _ = B.distinct_pairs(lines.rows[some], lines.exact[some])
            cuts = np.searchsorted(doc, np.arange(len(offsets)))
            words_at, first = np.flatnonzero(by_words[at]), np.full(len(at), False)
            first[words_at[np.unique(own[words_at], return_index=True)[1]]] = True
            every = pa.array([of_doc[cuts[k] : cuts[k + 1]].tobytes() if f else None for k, f in zip(own.tolist(), first.tolist(), strict=True)], pa.binary())
            columns = [ids[row + own], tags[row + own], start - offsets[own], end - offsets[own], lines.leaves[at].view(np.int64), lines.contents[at].view(np.int64), line.view(np.int64)]
            told = [pa.array(lines.exact[at].view(np.int64), mask=~by_words[at]), pa.array((cuts[1:] - cuts[:-1])[own]), every]
            # Tokens of recurring leaves only.
            keep = np.repeat(by_leaf[at], sizes)
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(by_leaf[at], sizes, 0)))), pa.int32()), pa.array(tokens[keep].view(np.int64)))
            out.append(pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), *told, listed], schema=schema))
        return pa.Table.from_batches(out, schema)

    kind = "id long, tag long, start long, end long, leaf long, content long, line long, exact long, lines long, all binary, tokens array<long>"
    return documents.groupBy("part").cogroup(recurring.groupBy("part")).applyInArrow(pick, kind)


def line_templates(lines: DataFrame, least: int, least_constant: float) -> DataFrame:
    """The template of every distinct line: leaf, line, template."""
    distinct = lines.groupBy("leaf", "line", "content").agg(F.first("tokens").alias("tokens"))
    distinct = distinct.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    tokens = distinct.select("leaf", "line", "n", F.posexplode("tokens").alias("at", "token"))
    support = tokens.groupBy("leaf", "at", "token").agg(F.sum("n").alias("support"))
    masked = tokens.join(support, ["leaf", "at", "token"])
    constant = (F.col("support") >= least) & (F.col("token") != F.lit(int(VARIABLE)))
    kept = F.when(F.col("support") >= least, F.col("token")).otherwise(F.lit(int(VARIABLE)))
    # One entry for each token of the line.
    per_line = masked.groupBy("leaf", "line").agg(F.avg(constant.cast("double")).alias("share"), F.array_sort(F.collect_list(F.struct("at", kept.alias("token")))).alias("masked"))
    general = F.xxhash64("leaf", F.transform("masked", lambda x: x["token"]))
    return per_line.select("leaf", "line", F.when(F.col("share") >= least_constant, general).otherwise(F.xxhash64("leaf", "line")).alias("template"))


def unrelated_lines(lines: DataFrame) -> DataFrame:
    """(exact, first): the lines that stand word for word in two unrelated documents, and their first document."""
    places = lines.where("exact IS NOT NULL").select("exact", "id", "tag", "lines").distinct()
    one = F.struct("lines", "id", "tag")
    ends = places.groupBy("exact").agg(F.min(F.struct("id", "tag")).alias("first"), F.max(one).alias("most"), F.min(one).alias("fewest"))
    compared = places.join(ends, "exact").select("exact", F.struct("id", "tag").alias("a"), F.explode(F.array("most", "fewest")).alias("b"), "first")
    compared = compared.select("exact", "first", "a", F.struct("b.id", "b.tag").alias("b")).where("a <> b")
    compared = stage(compared.select("exact", "first", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "template-compared")
    sets = stage(lines.where("all IS NOT NULL").select(F.struct("id", "tag").alias("doc"), "all").dropDuplicates(["doc"]), "template-documents")
    one, two = (sets.select(F.col("doc").alias(c), F.col("all").alias(f"of_{c}")) for c in "ab")
    schema = "a struct<id:long,tag:long>, b struct<id:long,tag:long>"

    def compare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        far = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            far.append(2 * len(np.intersect1d(x, y, assume_unique=True)) < min(len(x), len(y)))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(far, pa.bool_()))

    pairs = compared.select("a", "b").distinct().join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b")
    return compared.join(B.per_batch(pairs, compare, schema), ["a", "b"]).groupBy("exact").agg(F.first("first").alias("first"))


def later(places: DataFrame) -> DataFrame:
    """The places that are not in the document ``first``."""
    return places.where((F.col("id") != F.col("first.id")) | (F.col("tag") != F.col("first.tag"))).select("id", "tag", "start", "end")


def dropped_spans(documents: DataFrame, parts: int, least: int = LEAST, least_constant: float = LEAST_CONSTANT) -> DataFrame:
    """Spans of the lines to drop, as rows of ``spans.KIND``."""
    lines = stage(candidate_lines(documents, recurring_keys(documents, parts, least)), "template-lines")
    of_leaves = lines.where(F.size("tokens") > 0)
    placed = stage(of_leaves.drop("tokens", "exact", "lines", "all").join(line_templates(of_leaves, least, least_constant), ["leaf", "line"]), "template-places")
    around = placed.select("template", "content").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("contents"))
    owners = placed.select("template", "id", "tag").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("documents"), F.min(F.struct("id", "tag")).alias("first"))
    often = owners.join(around, "template").where((F.col("documents") >= least) & (F.col("contents") >= least)).select("template", "first")
    drops = later(placed.join(often, "template")).unionByName(later(lines.where("exact IS NOT NULL").select("exact", "id", "tag", "start", "end").join(unrelated_lines(lines), "exact")))

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, tags, starts, ends = (np.asarray(c) for c in batch.columns)
        yield B.packed(S.by_part(parts, ids, tags.astype(np.uint64), starts, ends), S.SCHEMA)

    return B.per_batch(drops, pack, S.KIND)


def dedup(docs: DataFrame, least: int = LEAST, least_constant: float = LEAST_CONSTANT, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining text."""
    base = B.normal_documents(docs)
    parts = B.part_count(docs.sparkSession, B.text_bytes(base)[1], S.PART_BYTES)
    documents = S.dealt_documents(base, parts)
    return S.without_spans(documents, dropped_spans(documents, parts, least, least_constant), 1, texts)


def cleaned(docs: DataFrame, least: int = LEAST, least_constant: float = LEAST_CONSTANT) -> DataFrame:
    """The documents without recurring lines; columns as they were."""
    parts = B.part_count(docs.sparkSession, B.text_bytes(docs)[1], S.PART_BYTES)
    spans = dropped_spans(S.dealt_documents(B.normal_documents(docs), parts), parts, least, least_constant)
    return S.with_new_texts(docs, S.without_spans(S.dealt_documents(S.with_rest(docs), parts), spans, 1, texts=True))


def op4_templates(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"), texts=False)
