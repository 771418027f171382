"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Index: centroids are fitted on a bounded sample, every vector goes to the list of its nearest centroid. Vectors are rotated by one random
orthogonal matrix, so the first columns of a difference are a fair sample of its length. A query probes the lists nearest to it. In a
list the columns are scanned block by block: from a candidate's partial distance over j of d columns a hypothesis test tells whether its
whole distance can still be among the best found so far; if not (beyond 1 + CONFIDENCE / sqrt(j) times that), the candidate is dropped.
Survivors are measured on the original vectors in double precision.

Lists are split into blocks of bounded size by a hash of the id, so a vector that a third of all rows repeat fills many blocks, each
scanned in a task of its own; queries are cut into blocks of about ``QUERY_ROWS`` too, and a group holds one block of each. It gives at most ``k`` candidates for a query, merged by query.

The share of lists to probe is set for vectors without clusters, as in the test tables: there a query's neighbours are spread over most
lists (recall 0.72 to 0.82 at a share of 0.3, 0.84 to 0.94 at 0.5, 0.97 and more at 0.75). Clustered vectors need far fewer.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither do those whose
dimension is not the most frequent one (the larger of equals); of several vectors under one id the smallest counts (so
repeated rows count once), as query and as candidate; a null id takes no
part; ties go to the smaller id; queries with fewer than ``k`` candidates return all that were found in lists holding at least
MOST_FEW vectors, or in all lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.sinks import stage
from . import blocks as B

SAMPLE_ROWS = 16_384
MOST_LISTS = 1024
PROBED_SHARE = 0.75
LEAST_PROBED = 8
MOST_FEW = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 16384
COLUMNS = 16
CONFIDENCE = 2.1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of doubles) of the rows that take part."""
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    largest = F.lit(float("inf"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < largest)) & F.exists("embedding", lambda x: x != 0)
    base = base.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    base = base.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sizes = base.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return base.where(F.size("embedding") == F.lit(sizes["d"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :], 0)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from distinct points of the sample; a centroid that loses its points stays where it is."""
    points = np.unique(sample, axis=0)
    random = np.random.default_rng(3)
    centres = points[random.permutation(len(points))[:lists]].copy()
    for _ in range(rounds):
        near = squared(sample, centres).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def rotation(dimensions: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(5).standard_normal((dimensions, dimensions)))[0]


def scan(query: np.ndarray, rotated_query: np.ndarray, originals: np.ndarray, rotated: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the best ``k`` candidates of one block, by the adaptive scan."""
    size, dimensions = rotated.shape
    alive = np.flatnonzero(ids != own)
    if not len(alive):
        return ids[:0], np.zeros(0)
    # The first candidates are measured in full; their k-th best distance is what the others are tested against.
    head, alive = alive[: 4 * k], alive[4 * k :]
    lead = ((originals[head] - query) ** 2).sum(1)
    kept = [head]
    if len(alive):
        bound = np.partition(lead, k - 1)[k - 1] if len(lead) >= k else np.inf
        partial = np.zeros(len(alive))
        for first in range(0, dimensions, COLUMNS):
            last = min(dimensions, first + COLUMNS)
            partial += ((rotated[alive, first:last] - rotated_query[first:last]) ** 2).sum(1)
            if last < dimensions:
                near = partial * (dimensions / last) <= bound * (1 + CONFIDENCE / last**0.5) ** 2
            else:
                near = partial <= bound * (1 + 1e-9) + 1e-12
            alive, partial = alive[near], partial[near]
            if not len(alive):
                break
        kept.append(alive)
    kept = np.concatenate(kept)
    score = np.sqrt(((originals[kept] - query) ** 2).sum(1))
    best = np.lexsort((ids[kept], score))[:k]
    return ids[kept][best], score[best]


def query_blocks_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each query."""
    return (B.mix(ids.view(np.uint64) + np.uint64(5)) % np.uint64(blocks)).astype(np.int64)


def search(vectors: DataFrame, is_query: Column, k: int = 10, probed_share: float = PROBED_SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the ``k`` nearest rows found for each query."""
    spark = vectors.sparkSession
    base = stage(usable(vectors), "vectors")
    sample = base.orderBy(F.xxhash64("vec_id", F.lit(17)), "vec_id").limit(SAMPLE_ROWS).toArrow()
    kind = "query_id long, rank int, vec_id long, score double"
    if not sample.num_rows:
        return spark.createDataFrame([], kind)
    points = matrix(sample["embedding"].combine_chunks())
    rows = base.count()
    turn = rotation(points.shape[1])
    centres = spark.sparkContext.broadcast(fit_centroids(points, int(min(MOST_LISTS, max(1, len(points) // 16), max(4, rows**0.5)))))
    turned = spark.sparkContext.broadcast(turn)
    query_blocks = max(1, -(-base.where(is_query).count() // QUERY_ROWS))
    indexed = pa.schema([("list", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def assign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data = matrix(batch.column(1))
        near = np.concatenate([squared(data[a : a + 4096], centres.value).argmin(1) for a in range(0, len(data), 4096)])
        ids = np.asarray(batch.column(0))
        # Blocks by id hash: a list is cut into as many as it needs once its size is known.
        yield B.packed([(n, 0, i, v) for n, i, v in B.parted(near.astype(np.int64), ids, data)], indexed)

    index = stage(B.per_batch(base, assign, "list long, block long, ids binary, vectors binary"), "vector-lists")
    counts = {r["list"]: r["n"] // 8 for r in index.groupBy("list").agg(F.sum(F.octet_length("ids")).alias("n")).collect()}  # one row per list
    lists = np.array(sorted(counts), np.int64)
    sizes = np.array([counts[x] for x in lists.tolist()], np.int64)
    splits = dict(zip(lists.tolist(), (-(-sizes // BLOCK_ROWS)).tolist(), strict=True))
    least = max(LEAST_PROBED, int(np.ceil(probed_share * len(lists))))

    met = pa.schema([("list", pa.int64()), ("block", pa.int64()), ("query_block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for n, raw_ids, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            ids = np.frombuffer(raw_ids, np.int64)
            data = np.frombuffer(raw).reshape(len(ids), -1)
            block = (B.mix(ids.view(np.uint64)) % np.uint64(splits[n])).astype(np.int64)
            rows += [(n, b, q, i, v) for b, i, v in B.parted(block, ids, data) for q in range(query_blocks)]
        yield B.packed(rows, met)

    def probe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, ids = matrix(batch.column(1)), np.asarray(batch.column(0))
        order = squared(data, centres.value[lists]).argsort(1)
        reach = np.cumsum(sizes[order], axis=1)
        wanted = np.maximum(least, (reach < MOST_FEW).sum(1) + 1)
        who, place = np.nonzero(np.arange(len(lists))[None, :] < wanted[:, None])
        rows = []
        query_block = query_blocks_of(ids, query_blocks)
        for cell, i, v in B.parted(lists[order[who, place]] * query_blocks + query_block[who], ids[who], data[who]):
            n, q = divmod(cell, query_blocks)
            rows += [(n, b, q, i, v) for b in range(splits[n])]
        yield B.packed(rows, met)

    def scan_block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        ids, own = B.unpacked(left["ids"], "i8"), B.unpacked(right["ids"], "i8")
        originals, queries = B.unpacked(left["vectors"], "f8").reshape(len(ids), -1), B.unpacked(right["vectors"], "f8").reshape(len(own), -1)
        rotated, rotated_queries = originals @ turned.value, queries @ turned.value
        found = [scan(queries[q], rotated_queries[q], originals, rotated, ids, own[q], k) for q in range(len(own))]
        count = [len(x) for x, _ in found]
        return pa.Table.from_arrays([pa.array(np.repeat(own, count)), pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([y for _, y in found]))], schema=out)

    layout = "list long, block long, query_block long, ids binary, vectors binary"
    candidates = B.per_batch(index, deal, layout)
    queries = B.per_batch(base.where(is_query), probe, layout)
    found = candidates.groupBy("list", "block", "query_block").cogroup(queries.groupBy("list", "block", "query_block")).applyInArrow(scan_block, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")  # at most k rows of every probed block
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_adscan(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 100 == 0)
