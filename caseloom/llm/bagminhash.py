"""Near-duplicate detection on multisets of word shingles by BagMinHash signatures, banding, and exact verification.

Equal multisets are one content, found by a 64-bit hash, so thousands of copies cost one row each. Contents that agree in a band of
their signatures are members of a bucket. Every bucket has a centre, with which its members are compared, first by signature, then
exactly by the overlap of the two multisets; links join contents into classes. Where a bucket of three or more then has more than
one class, its members outside its largest class, few in a group of near copies, are compared with its members of other classes. Both
sides are cut into blocks of at most about ``BLOCK_MEMBERS``, and each pair of blocks is a group of its own that returns one link for
each straggler and class. A pair that shares several buckets is compared in the first of them only. So pairs within a class are
never made, and no link between members of a bucket is lost.

Similarity is the weighted Jaccard index: the sum of the smaller counts over the sum of the larger ones.

Defined results: words are runs without white space, A-Z as a-z; a text of one to four words is one shingle; texts without words are
one class; a null text is empty; the class id is the smallest document id of the class, null only if all are; documents with equal ids
are told apart by content; rows with equal id and content (texts that differ in case or white space only, say) are one document, with one
result for each row; ``kept_documents`` returns one row of it, the one with the smallest hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import stage
from . import blocks as B

SHINGLE = 5
COMPONENTS, ROWS_PER_BAND = 96, 4
LEAST_SIMILARITY = 0.8
BLOCK_MEMBERS = 256
_ONE = np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of the distinct shingles of each text; a text with fewer words is one shingle of all its words."""
    words, owner = B.hashed_words(data, offsets)
    rows = len(offsets) - 1
    if len(words) >= width:
        codes = B.sequence_hashes(words, width)
        whole = owner[width - 1 :] == owner[: len(codes)]
        who, what = owner[: len(codes)][whole], codes[whole]
    else:
        who, what = owner[:0], words[:0]
    count = np.bincount(owner, minlength=rows)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        cuts = np.searchsorted(owner, short)
        codes = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            more = count[short] > k
            codes[more] = B.mix(codes[more] * np.uint64(31) + words[cuts[more] + k] + _ONE)
        who, what = np.concatenate((who, short)), np.concatenate((what, codes))
    return B.distinct_pairs(who, what)


def signatures(rows: int, who: np.ndarray, what: np.ndarray, weight: np.ndarray, components: int = COMPONENTS) -> np.ndarray:
    """The signature of each multiset: for every component its smallest point, as the bits of a float; all ones without shingles.

    The weight axis of a shingle is cut into the blocks [0,1), [1,2), [2,4), [4,8), ...; each block has a Poisson process whose rate is
    its length. A point has a place on the weight axis, counts if that lies below the weight, and goes to a random component. Points come
    in ascending order, and only those below a limit are made; texts with an empty component get a higher limit."""
    out = np.full((rows, components), np.inf)
    # One process for each block that starts below the weight.
    owners, seeds, lows, rates, weights = [who], [what], [np.zeros(len(who))], [np.ones(len(who))], [weight]
    low = 1
    while len(who) and low < weight.max():
        some = weight > low
        owners.append(who[some])
        seeds.append(B.mix(what[some] + np.uint64(low * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
        lows.append(np.full(some.sum(), float(low)))
        rates.append(np.full(some.sum(), float(low)))
        weights.append(weight[some])
        low *= 2
    owner, seed, low_, rate, heavy = (np.concatenate(x) for x in (owners, seeds, lows, rates, weights))
    total = np.bincount(who, weight, rows)
    limit = components * (np.log(components) + 2) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        active = np.flatnonzero(todo[owner])
        out[todo] = np.inf
        flat = out.reshape(-1)
        at, step = np.zeros(len(active)), 0
        who_, seed_, low__, rate_, heavy_ = owner[active], seed[active], low_[active], rate[active], heavy[active]
        while len(who_):
            step += 1
            draw = B.mix(seed_ + np.uint64(step * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate_
            near = at < limit[who_]
            if not near.all():
                who_, seed_, low__, rate_, heavy_, at, draw = (x[near] for x in (who_, seed_, low__, rate_, heavy_, at, draw))
            second = B.mix(draw ^ np.uint64(0xC0FFEE))
            place = low__ + rate_ * ((second >> np.uint64(32)).astype(np.float64) * 2.0**-32)
            inside = place < heavy_
            component = ((second & np.uint64(0xFFFFFFFF)) * np.uint64(components)) >> np.uint64(32)
            np.minimum.at(flat, who_[inside] * components + component[inside].astype(np.int64), at[inside])
        todo &= np.isinf(out).any(axis=1)
        limit = np.where(todo, 2 * limit, limit)
    return (B.mix(out.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def contents_of(rows: int, who: np.ndarray, what: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A hash of each multiset, 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(B.mix(what) * weight.astype(np.uint64))))
    cuts = np.searchsorted(who, np.arange(rows + 1))
    return B.mix(sums[cuts[1:]] - sums[cuts[:-1]]).view(np.int64)


def band_keys(signature: np.ndarray, rows_per_band: int = ROWS_PER_BAND) -> np.ndarray:
    """A key for each band of each signature."""
    bands = signature.shape[1] // rows_per_band
    keys = np.zeros((len(signature), bands), np.uint64)
    signature = signature.astype(np.uint64)
    for k in range(rows_per_band):
        keys = B.mix(keys * np.uint64(31) + signature[:, k : bands * rows_per_band : rows_per_band])
    return B.mix(keys + np.arange(bands, dtype=np.uint64))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, content and signature of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("signature", pa.binary())])

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids = [], batch.column(0).to_pylist()
        for first, data, offsets in B.blocks(batch.column(1)):
            count = len(offsets) - 1
            sets = shingles(data, offsets)
            some = np.bincount(sets[0], minlength=count) > 0
            signature, content = signatures(count, *sets), contents_of(count, *sets).tolist()
            rows += [(ids[first + k], content[k], signature[k] if some[k] else signature[k][:0]) for k in range(count)]
        yield B.packed(rows, schema)

    return B.per_batch(B.normal_documents(docs), sign, "doc_id long, content long, signature binary")


def bucket_members(contents: DataFrame) -> DataFrame:
    """(bucket, content) for all buckets of two contents or more."""

    def bands(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = band_keys(B.unpacked(batch.column(1), "u4").reshape(-1, COMPONENTS)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(batch.column(0)), keys.shape[1]))], ["bucket", "content"])

    every = B.per_batch(contents.where(F.octet_length("signature") > 0).select("content", "signature"), bands, "bucket long, content long")
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return every.join(shared, "bucket")


def agreeing(pairs: DataFrame, signatures_: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures do not rule out ``least`` similarity: agreement within five standard errors below it."""
    slack = least - 5 * (least * (1 - least) / COMPONENTS) ** 0.5
    one = signatures_.select(F.col("content").alias("a"), F.col("signature").alias("one"))
    two = signatures_.select(F.col("content").alias("b"), F.col("signature").alias("two"))

    def compare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, y = (B.unpacked(batch.column(k), "u4").reshape(-1, COMPONENTS) for k in (2, 3))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= slack))

    return B.per_batch(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two"), compare, "a long, b long")


def multisets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(content, shingles): the sorted shingle hashes, repeated as often as they occur, of the documents ``wanted``."""
    schema = pa.schema([("content", pa.int64()), ("shingles", pa.binary())])

    def gather(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for _, data, offsets in B.blocks(batch.column(1)):
            count = len(offsets) - 1
            who, what, weight = shingles(data, offsets)
            content = contents_of(count, who, what, weight).tolist()
            what, who = np.repeat(what, weight), np.repeat(who, weight)
            cuts = np.searchsorted(who, np.arange(count + 1))
            rows += [(content[k], what[cuts[k] : cuts[k + 1]]) for k in range(count)]
        yield B.packed(rows, schema)

    def add(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [contents_of(len(offsets) - 1, *shingles(data, offsets)) for _, data, offsets in B.blocks(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(found))], ["doc_id", "text", "content"])

    base = B.normal_documents(docs)
    picked = base.join(wanted.where("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    # Contents of which no document has an id are found by their hash.
    lone = B.per_batch(base.where("doc_id IS NULL"), add, f"doc_id long, text {base.schema['text'].dataType.simpleString()}, content long")
    lone = lone.join(wanted.where("doc_id IS NULL").select("content"), "content", "left_semi").dropDuplicates(["content"])
    picked = picked.select("doc_id", "text").unionByName(lone.select("doc_id", "text"))
    return B.per_batch(picked, gather, "content long, shingles binary").dropDuplicates(["content"])


def overlap(one: np.ndarray, two: np.ndarray) -> float:
    """Weighted Jaccard index of two sorted lists with repeats."""
    values = np.unique(np.concatenate((one, two)))
    a, b = (np.diff(np.searchsorted(x, values, "right"), prepend=0) for x in (one, two))
    both = int(np.minimum(a, b).sum())
    return both / (len(one) + len(two) - both)


def linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity) of the pairs that are similar enough."""
    one = sets.select(F.col("content").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("content").alias("b"), F.col("shingles").alias("two"))

    def verify(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        (x, xs), (y, ys) = (B.buffers(B.as_bytes(batch.column(k))) for k in (2, 3))
        x, xs, y, ys = x.view(np.uint64), xs // 8, y.view(np.uint64), ys // 8
        score = np.array([overlap(x[xs[k] : xs[k + 1]], y[ys[k] : ys[k + 1]]) for k in range(batch.num_rows)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["a", "b", "similarity"]).filter(pa.array(score >= least))

    return B.per_batch(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two"), verify, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(content, root) of all contents with an edge; the root is the smallest content of its component.

    Large-star and small-star steps in turn until the edges are stars; every step is two groupings by node, and each result is written
    before the next begins."""
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        stars = stage(small.distinct(), "minhash-stars")
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if now == before:
            return stars.select(F.col("a").alias("content"), F.col("b").alias("root"))
        before = now


def overlaps(values: np.ndarray, counts: np.ndarray, all_values: np.ndarray, all_counts: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Shared shingles of one multiset (distinct values in order) with each of many."""
    at = np.minimum(np.searchsorted(values, all_values), len(values) - 1)
    return np.bincount(owner, np.where(values[at] == all_values, np.minimum(counts[at], all_counts), 0), rows)


def straggler_blocks(members: DataFrame, contents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and stragglers of the buckets that still have several classes, dealt to a grid of blocks: (bucket, row, block, root,
    content, signature, shingles); a straggler has one row of the grid and stands in all its blocks, a member the other way round.

    ``members``: bucket, content; ``contents``: content, root, signature, shingles."""
    placed = members.join(contents.select("content", "root"), "content")
    sizes = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.groupBy("bucket").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"), F.max(F.struct("n", "root")).alias("largest"))
    # A bucket of two has been compared already.
    open_ = totals.where("classes > 1 AND total > 2").select(
        "bucket", F.col("largest.root").alias("largest"),
        F.ceil((F.col("total") - F.col("largest.n")) / BLOCK_MEMBERS).cast("int").alias("rows"), F.ceil(F.col("total") / BLOCK_MEMBERS).cast("int").alias("blocks"),
    )
    placed = stage(placed.join(open_, "bucket"), "minhash-open")
    row, block = (F.pmod(F.xxhash64("content", F.lit(k)), F.col(n)).cast("int") for k, n in enumerate(("rows", "blocks")))
    every_row, every_block = (F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in ("rows", "blocks"))
    whole = placed.withColumn("row", every_row).withColumn("block", block)
    stragglers = placed.where("root <> largest").withColumn("row", row).withColumn("block", every_block)
    named = contents.select("content", "signature", "shingles")
    columns = ["bucket", "row", "block", "root", "content", "signature", "shingles"]
    one, two = (x.select("bucket", "row", "block", "root", "content").join(named, "content").select(*columns) for x in (whole, stragglers))
    return one, two.select(*(F.col(c).alias(c) for c in columns))


def straggler_links(members: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    """Links between the classes of a bucket that first comparisons have left apart.

    Of the links of a straggler with one class in one pair of blocks only the first is returned."""
    whole, stragglers = straggler_blocks(members, contents)
    slack = least - 5 * (least * (1 - least) / COMPONENTS) ** 0.5
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            signature, root, content = B.unpacked(left["signature"], "u4").reshape(-1, COMPONENTS), np.asarray(left["root"]), np.asarray(left["content"])
            size = B.lengths(left["shingles"], 8)
            owner, value, count = B.distinct_pairs(np.repeat(np.arange(len(size)), size), B.unpacked(left["shingles"], "u8"))
            others = B.unpacked(right["signature"], "u4").reshape(-1, COMPONENTS)
            keys, other_keys, bucket = band_keys(signature), band_keys(others), np.array(left["bucket"][0].as_py()).astype(np.int64).view(np.uint64)
            band = int(np.flatnonzero((other_keys == bucket).any(axis=0))[0])
            roots, names, sets = right["root"].to_pylist(), right["content"].to_pylist(), right["shingles"].to_pylist()
            for k in range(right.num_rows):
                likely = ((signature == others[k]).mean(axis=1) >= slack) & (root != roots[k])
                likely &= ~(keys[:, :band] == other_keys[k, :band]).any(axis=1)  # those have met in an earlier bucket
                if not likely.any():
                    continue
                own = np.frombuffer(sets[k], np.uint64)
                values, counts = np.unique(own, return_counts=True)
                some = likely[owner]
                both = overlaps(values, counts, value[some], count[some], owner[some], len(size))
                score = both / (len(own) + size - both)
                linked_ = np.flatnonzero(likely & (score >= least))
                for at in linked_[np.unique(root[linked_], return_index=True)[1]].tolist():
                    a, b = sorted((names[k], int(content[at])), reverse=True)
                    found.append((a, b, float(score[at])))
        return pa.Table.from_arrays([pa.array([x[j] for x in found], f.type) for j, f in enumerate(out)], schema=out)

    keys_ = ("bucket", "row", "block")
    pairs = whole.groupBy(*keys_).cogroup(stragglers.groupBy(*keys_))
    return pairs.applyInArrow(compare, "a long, b long, similarity double").dropDuplicates(["a", "b"])


def class_links(docs: DataFrame, contents: DataFrame, least: float = LEAST_SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity) that join all classes, and (content, root) of the linked contents.

    ``contents``: content, doc_id, signature."""
    members = stage(bucket_members(contents), "minhash-members")
    known = stage(contents.join(members.select("content").distinct(), "content"), "minhash-contents")
    sets = stage(multisets(docs, known), "minhash-sets")
    # Every bucket has its own centre, so a group of near copies is compared with many of its members.
    centre = members.groupBy("bucket").agg(F.min_by("content", F.xxhash64("content", "bucket")).alias("centre"))
    pairs = members.join(centre, "bucket").where("content <> centre").select(F.greatest("content", "centre").alias("a"), F.least("content", "centre").alias("b"))
    pairs = stage(pairs.distinct(), "minhash-pairs")
    links = stage(linked(agreeing(pairs, known, least), sets, least), "minhash-links")
    roots = components(links)
    placed = known.select("content", "signature").join(sets, "content").join(roots, "content", "left").withColumn("root", F.coalesce("root", "content"))
    more = stage(straggler_links(members, placed, least), "minhash-stragglers")
    links = links.unionByName(more)
    return links, components(links)


def classified(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """doc_id, content, class_id, links (of its content, among those that join the class) and keep, for every document."""
    signed_ = stage(signed(docs), "minhash-signed")
    contents = signed_.groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    links, roots = class_links(docs, contents, least)
    named = contents.select("content", "doc_id")
    ends = links.select(F.col("a").alias("content")).unionByName(links.select(F.col("b").alias("content")))
    counts = ends.groupBy("content").agg(F.count(F.lit(1)).alias("links"))
    named = named.join(roots, "content", "left").join(counts, "content", "left")
    named = named.withColumn("root", F.coalesce("root", "content")).withColumn("links", F.coalesce("links", F.lit(0).cast("bigint")))
    # Null ids last; equal ids by content.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content"))
    classes = named.groupBy("root").agg(first.alias("first"))
    classes = named.join(classes, "root").select("content", "links", F.col("first.doc_id").alias("class_id"), F.col("first.content").alias("class_content"))
    out = signed_.select("doc_id", "content").join(classes, "content")
    return out.select("doc_id", "content", "class_id", "links", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("content") == F.col("class_content"))).alias("keep"))


def kept_documents(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """One row of each class: a row of the document with the smallest id, the one with the smallest hash; columns as they were."""
    columns = docs.columns
    at = columns.index("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "_content long"])

    def add(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [contents_of(len(offsets) - 1, *shingles(data, offsets)) for _, data, offsets in B.blocks(batch.column(at))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))], [*columns, "_content"])

    keys = classified(docs, least).groupBy(F.col("doc_id").alias("_id"), F.col("content").alias("_gone")).agg(F.first("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
    gone = stage(keys.where("NOT keep OR n > 1"), "minhash-gone")
    again = gone.where("keep").select(F.col("_id").alias("_same_id"), F.col("_gone").alias("_same"))
    left = [F.col(f"`{c}`") for c in columns]
    rest = B.per_batch(docs, add, schema)
    rest = rest.join(gone, rest["_content"].eqNullSafe(gone["_gone"]) & rest["doc_id"].cast("bigint").eqNullSafe(gone["_id"]), "left_anti").select(*left)
    # Of repeated rows of a kept document one stays; only rows with such an id are looked at again.
    some = docs.select(*left).join(again.select("_same_id").distinct(), F.col("doc_id").cast("bigint").eqNullSafe(F.col("_same_id")), "left_semi")
    some = B.per_batch(some, add, schema)
    some = some.join(again, some["_content"].eqNullSafe(again["_same"]) & some["doc_id"].cast("bigint").eqNullSafe(again["_same_id"]), "left_semi")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    one = some.groupBy("doc_id", "_content").agg(F.min_by(F.struct(*left), F.xxhash64(*hashed)).alias("_row"))
    return rest.unionByName(one.select(*(F.col(f"_row.`{c}`").alias(c) for c in columns)))


def op9_bagminhash(docs: DataFrame) -> DataFrame:
    return classified(docs.select("doc_id", "text")).drop("content")
