"""Hard-negative mining over Hilbert-ordered blocks of candidates with zone maps.

Layout: vectors become integers (each component floor(scale * x)). All rows are range-sorted by label, then by their place on a Hilbert
curve through the dimensions that vary most, and cut into blocks of BLOCK_ROWS rows, one Parquet row each. A block carries its zone map
(minimum and maximum of every dimension, and of the label); blocks are filed in at most MOST_SHELVES folders ("shelves"), which have zone
maps of their own.

Search: an anchor asks for windows: the best ``k`` rows of the same (or of another) label with a score between two bounds. By interval
arithmetic a zone map bounds every score in its block: a component q of the anchor times [lo, hi] lies in [min(q*lo, q*hi),
max(q*lo, q*hi)], and the sums of these bound the inner product. A shelf is listed, and a block's vectors are unpacked, only if that
interval meets a window of a fitting label; a window's lower bound rises to the k-th best score found so far. No row that could be a
result is skipped, so results are exact whatever the data are; how much is skipped depends on how well they cluster.

Anchors are taken in rounds of at most ROUND_BYTES, in the order of the blocks, so that a round's anchors lie near each other. A round is
broadcast to the candidates, which stay where they are: no vector is shuffled after the blocks are written. Positives start from the fifth
best score in the anchor's own block; negatives start from a pass over one block in SEED_EVERY, then all other blocks are read. A task gives
at most ``k`` rows for a window, merged by window.

Defined results: rows with a null id, a null label, a null vector, or a null or non-finite component take no part; of several rows with one
id the one with the smallest label, then the smallest vector, is taken; components that a shorter vector lacks count as zero; scores that
are beyond 2**62 count as 2**62; an empty table, or one without anchors, gives no rows. Further columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.sinks import new_folder, stage
from . import blocks as B

BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 20
MOST_SHELVES = 1024
SHELF_BYTES = 16 << 20
ROUND_BYTES = 8 << 20
STATS_ROWS = 65_536
SEED_EVERY = 16
CHUNK = 512
EXACT = float(1 << 53)
MOST = 1 << 62
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_BLOCK = "block bigint, shelf int, size int, label_lo bigint, label_hi bigint, lo binary, hi binary, ids binary, labels binary, kind string, parts binary"
_ANCHOR = "place bigint, anchor_id bigint, label bigint, floor bigint, parts binary"
_HITS = ["anchor_id", "partner_id", "partner_score", "score", "vec_id"]
_HIT = ", ".join(f"{c} bigint" for c in _HITS)


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of ``bits``-bit coordinates, at most 63 bits together) on the Hilbert curve through the grid.

    From the top bit down, each coordinate tells how the sub-cube below it is turned: a set bit mirrors the first axis, a clear one swaps it
    with this axis. A Gray code over all coordinates then gives the place, bit plane by bit plane."""
    axes = cells.T.astype(np.int64)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for axis in axes:
            mirrored = (axis >> bit & 1).astype(bool)
            swap = np.where(mirrored, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(mirrored, below, swap)
            axis ^= swap
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    turned = np.zeros(axes.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] >> bit & 1, (1 << bit) - 1, 0)
    axes ^= turned
    place = np.zeros(axes.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = place << 1 | axis >> bit & 1
    return place


def vectors_of(column: pa.Array, scale: float) -> np.ndarray:
    """A list column as a matrix of floor(scale * x); shorter rows end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().fill_null(0))
    out = np.zeros((len(column), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.asarray(column.flatten())
    return np.floor(scale * out)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label and vector of the rows that take part, one for each id."""
    whole = F.forall(F.col("vector"), lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vec_col).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")


def _grid(rows: DataFrame, count: int, scale: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The dimensions of the curve (those that vary most, at most 21) with their mean and spread, from some STATS_ROWS rows.

    They decide the order of the rows alone, not the results."""
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, count // STATS_ROWS))) == 0)
    stats = some.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(
        F.avg(F.col("x") * scale).alias("mean"), F.coalesce(F.stddev_pop(F.col("x") * scale), F.lit(0.0)).alias("spread")
    ).orderBy(F.desc("spread"), "at").limit(21).toArrow()
    spread = np.array(stats["spread"], float)
    return np.array(stats["at"], int).tolist(), np.array(stats["mean"], float), np.where((spread > 0) & np.isfinite(spread), spread, 1.0)


def opened(r: dict) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """The zone map of a block, its ids, labels and vectors."""
    zone = r | {n: np.frombuffer(r[n], "f8") for n in ("lo", "hi")}
    return zone, np.frombuffer(r["ids"], "i8"), np.frombuffer(r["labels"], "i8"), np.frombuffer(r["parts"], r["kind"]).reshape(r["size"], -1)


def _zones(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "f8") for x in column.to_pylist()]


def block_table(rows: DataFrame, count: int, width: int, scale: float) -> DataFrame:
    """The candidate blocks, written in order under one folder for each shelf."""
    spark = rows.sparkSession
    dims, mean, spread = _grid(rows, count, scale)
    bits = min(16, 63 // max(1, len(dims)))
    parts = B.part_count(spark, 2 * count * width, SHELF_BYTES)
    shelves, each = min(parts, MOST_SHELVES), int(min(BLOCK_ROWS, max(1, BLOCK_BYTES // (8 * max(1, width)))))

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = vectors_of(batch.column(2), scale)
        at = np.zeros((len(found), len(dims)))
        inside = [k for k, d in enumerate(dims) if d < found.shape[1]]
        at[:, inside] = found[:, [dims[k] for k in inside]]
        cells = np.clip(((at - mean) / spread / 6 + 0.5) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
        keys = hilbert_places(cells, bits) if dims else np.zeros(len(found), np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], ["vec_id", "label", "vector", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("shelf", pa.int32()), ("size", pa.int32()), ("label_lo", pa.int64()), ("label_hi", pa.int64()), *((n, pa.binary()) for n in ("lo", "hi", "ids", "labels")), ("kind", pa.string()), ("parts", pa.binary())])
        part, made, held = TaskContext.get().partitionId(), 0, []

        def blocks(last: bool) -> Iterator[tuple]:
            nonlocal made, held
            table = pa.Table.from_batches(held)
            cuts = range(0, table.num_rows if last else table.num_rows - table.num_rows % each, each)
            for first in cuts:
                one = table.slice(first, each)
                found, labels = vectors_of(one["vector"], scale), np.asarray(one["label"])
                kind = "i2" if np.abs(found).max(initial=0) < 1 << 15 else "f8"
                yield (part << 24 | made, part * shelves // parts, len(found), int(labels.min()), int(labels.max()), found.min(0), found.max(0), np.asarray(one["vec_id"]), labels, kind, found.astype(kind))
                made += 1
            held = table.slice(len(cuts) * each).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(x.num_rows for x in held) >= each:
                    yield B.packed(list(blocks(False)), schema)
        if held:
            yield B.packed(list(blocks(True)), schema)

    placed = B.per_batch(rows.select("vec_id", "label", "vector"), place, "vec_id bigint, label bigint, vector array<double>, place bigint")
    keys = ["label", "place", F.xxhash64("vec_id")]
    packed = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("vec_id", "label", "vector").mapInArrow(cut, _BLOCK)
    folder = new_folder(spark, "zone-blocks")
    packed.write.partitionBy("shelf").parquet(folder)
    return spark.read.schema(_BLOCK).parquet(folder)


def shelf_zones(table: DataFrame) -> list[dict]:
    """Zone maps of the shelves (at most MOST_SHELVES of them), from those of their blocks."""
    schema = pa.schema([("shelf", pa.int32()), ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("lo", pa.binary()), ("hi", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list | None = None
        for batch in batches:
            for shelf, a, b, lo, hi in zip(*(c.to_pylist() for c in batch.columns[:3]), *map(_zones, batch.columns[3:]), strict=True):
                if whole is None:
                    whole = [shelf, a, b, lo, hi]
                    continue
                n = max(len(lo), len(whole[3]))
                wide = [np.pad(x, (0, n - len(x))) for x in (whole[3], lo, whole[4], hi)]
                whole = [shelf, min(a, whole[1]), max(b, whole[2]), np.minimum(*wide[:2]), np.maximum(*wide[2:])]
        if whole:
            yield B.packed([tuple(whole)], schema)

    zones = table.select("shelf", "label_lo", "label_hi", "lo", "hi").groupBy("shelf").applyInArrow(merge, "shelf int, label_lo bigint, label_hi bigint, lo binary, hi binary")
    return [r | {k: np.frombuffer(r[k], "f8") for k in ("lo", "hi")} for r in zones.toArrow().to_pylist()]


class Windows:
    """The windows of one round: up to ``len(lo[0])`` for each anchor; a window wants the best ``k`` rows with lo <= score <= hi."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, partners: np.ndarray, partner_scores: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, same: bool) -> None:
        self.ids, self.labels, self.vectors, self.partners, self.partner_scores = ids, labels, vectors, partners, partner_scores
        self.lo, self.hi, self.k, self.same = lo, hi, k, same

    def wanted(self, zone: dict) -> np.ndarray:
        """Which windows the scores of a zone can meet."""
        width = min(self.vectors.shape[1], len(zone["lo"]))
        fits = (self.labels >= zone["label_lo"]) & (self.labels <= zone["label_hi"]) if self.same else ~((self.labels == zone["label_lo"]) & (self.labels == zone["label_hi"]))
        at = np.flatnonzero(fits)
        out = np.zeros(self.lo.shape, bool)
        own, lo, hi = self.vectors[at, :width], zone["lo"][:width], zone["hi"][:width]
        up, down = np.maximum(own, 0), np.minimum(own, 0)
        least, most = up @ lo + down @ hi, up @ hi + down @ lo
        sure = np.abs(own) @ np.maximum(np.abs(lo), np.abs(hi)) < EXACT  # else the bounds may be rounded and tell nothing
        out[at] = (self.lo[at] <= self.hi[at]) & (~sure[:, None] | (most[:, None] >= self.lo[at]) & (least[:, None] <= self.hi[at]))
        return out


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    width = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :width], rows[:, :width].astype(float)
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -MOST, MOST).astype(np.int64)


class Best:
    """The best ``k`` hits of every window so far."""

    def __init__(self, windows: Windows) -> None:
        self.windows, self.lo = windows, windows.lo.copy()
        self.window, self.score, self.vec = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        window, score, vec = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, window))
        window, score, vec = window[order], score[order], vec[order]
        first = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1]))) if len(window) else np.zeros(0, int)
        rank = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        full = rank == self.windows.k - 1
        flat = self.lo.reshape(-1)
        flat[window[full]] = np.maximum(flat[window[full]], score[full])
        kept = rank < self.windows.k
        self.window, self.score, self.vec = window[kept], score[kept], vec[kept]

    def look(self, zone: dict, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """All rows of a block that a window wants."""
        w, slots = self.windows, self.lo.shape[1]
        wanted = Windows(w.ids, w.labels, w.vectors, w.partners, w.partner_scores, self.lo, w.hi, w.k, w.same).wanted(zone)
        anchors = np.flatnonzero(wanted.any(1))
        for first in range(0, len(anchors), CHUNK):
            at = anchors[first : first + CHUNK]
            found = scores(w.vectors[at], rows)
            fits = (w.labels[at][:, None] == labels) & (w.ids[at][:, None] != ids) if w.same else w.labels[at][:, None] != labels
            for slot in range(slots):
                own = at[wanted[at, slot]]
                part = slice(None) if len(own) == len(at) else wanted[at, slot]
                a, b = np.nonzero(fits[part] & (found[part] >= self.lo[own, slot, None]) & (found[part] <= w.hi[own, slot, None]))
                if len(a):
                    self.add(own[a] * slots + slot, found[part][a, b], ids[b])


def scan(table: DataFrame, zones: list[dict], windows: Windows) -> DataFrame:
    """The best ``k`` rows for each window, read from the shelves and blocks whose zones meet it; a task gives at most ``k`` for each."""
    shelves = [z["shelf"] for z in zones if windows.wanted(z).any()]
    shared = table.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                best.look(*opened(batch.slice(k, 1).to_pylist()[0]))
        w, slots = best.windows, best.lo.shape[1]
        own, slot = best.window // slots, best.window % slots
        columns = [w.ids[own], w.partners[own, slot], w.partner_scores[own, slot], best.score, best.vec]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _HITS)

    read = ["label_lo", "label_hi", "size", "lo", "hi", "ids", "labels", "kind", "parts"]
    return best_of(table.where(F.col("shelf").isin(shelves)).select(*read).mapInArrow(run, _HIT), windows.k)


def best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "partner_id").orderBy(F.desc("score"), "vec_id")
    return hits.select(*_HITS, F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def anchor_table(table: DataFrame, every: int, positives: int) -> DataFrame:
    """The anchors, their places in the order of the blocks, and a score that each one's ``positives``-th best partner reaches."""
    schema = pa.schema([("place", pa.int64()), ("anchor_id", pa.int64()), ("label", pa.int64()), ("floor", pa.int64()), ("parts", pa.binary())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            _, ids, labels, rows = opened(r)
            rows, picked, out = rows.astype(float), np.flatnonzero(ids % every == 0), []
            for first in range(0, len(picked), CHUNK):
                at = picked[first : first + CHUNK]
                near = np.where((labels[at][:, None] == labels) & (ids[at][:, None] != ids), scores(rows[at], rows), -MOST - 1)
                floor = np.sort(near, 1)[:, -positives] if positives <= len(ids) else np.full(len(at), -MOST - 1)
                out += [(r["block"] << 12 | int(k), int(ids[k]), int(labels[k]), int(f), rows[k]) for k, f in zip(at, floor, strict=True)]
            yield B.packed(out, schema)

    return B.per_batch(table.select("block", "size", "ids", "labels", "label_lo", "label_hi", "lo", "hi", "kind", "parts"), run, _ANCHOR)


def percent(score: np.ndarray, share: int, up: bool) -> np.ndarray:
    """``share`` percent of integer scores, rounded up or down."""
    whole, rest = np.divmod(score, 100)
    return share * whole + (-(-share * rest // 100) if up else share * rest // 100)


def mine_round(table: DataFrame, zones: list[dict], anchors: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for the anchors of one round."""
    ids, labels, floor = (np.asarray(anchors[c], np.int64) for c in ("anchor_id", "label", "floor"))
    order = np.argsort(ids)
    ids, labels, floor = ids[order], labels[order], floor[order]
    own = [np.frombuffer(x, "f8") for x in anchors["parts"].take(pa.array(order)).to_pylist()]
    vectors = np.zeros((len(own), max(map(len, own))))
    for k, x in enumerate(own):
        vectors[k, : len(x)] = x
    none = np.zeros((len(ids), 1), np.int64)
    found = scan(table, zones, Windows(ids, labels, vectors, none, none, floor[:, None], none + MOST, positives, True)).toArrow()
    partners, partner_scores = (np.zeros((len(ids), positives), np.int64) for _ in range(2))
    there = np.zeros(partners.shape, bool)
    at = np.searchsorted(ids, np.asarray(found["anchor_id"], np.int64)), np.asarray(found["rank"], np.int64) - 1
    partners[at], partner_scores[at], there[at] = np.asarray(found["vec_id"], np.int64), np.asarray(found["score"], np.int64), True
    lo, hi = np.where(there, percent(partner_scores, low, True), 1), np.where(there, percent(partner_scores, high, False), 0)
    seed = F.pmod(F.xxhash64("block"), F.lit(SEED_EVERY)) == 0
    first = stage(scan(table.where(seed), zones, Windows(ids, labels, vectors, partners, partner_scores, lo, hi, negatives, False)), "zone-seeds")
    full = first.where(F.col("rank") == negatives).select("anchor_id", "partner_id", "score").toArrow()
    row = np.searchsorted(ids, np.asarray(full["anchor_id"], np.int64))
    slot = (partners[row] == np.asarray(full["partner_id"], np.int64)[:, None]).argmax(1)
    lo = lo.copy()
    lo[row, slot] = np.asarray(full["score"], np.int64)
    rest = scan(table.where(~seed), zones, Windows(ids, labels, vectors, partners, partner_scores, lo, hi, negatives, False))
    return best_of(first.select(*_HITS).unionByName(rest.select(*_HITS)), negatives).selectExpr(
        "anchor_id", "partner_id AS positive_id", "rank", "vec_id AS negative_id", "partner_score AS positive_score", "score AS negative_score")


def mine(table: DataFrame, width: int, every: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The rounds one after another; each one's result is written."""
    spark = table.sparkSession
    zones, anchors = shelf_zones(table), stage(anchor_table(table, every, positives), "zone-anchors")
    rounds = -(-anchors.count() * 8 * max(1, width) // ROUND_BYTES)
    if not rounds:
        return spark.createDataFrame([], RESULT)
    cuts = anchors.agg(F.percentile_approx("place", [k / rounds for k in range(1, rounds)], 100 * rounds)).first()[0] if rounds > 1 else []
    folder = new_folder(spark, "zone-negatives")
    for k, (a, b) in enumerate(itertools.pairwise([-1, *cuts, (1 << 63) - 1])):
        some = anchors.where((F.col("place") > a) & (F.col("place") <= b)).toArrow()
        if some.num_rows:
            mine_round(table, zones, some, positives, negatives, low, high).write.parquet(f"{folder}/round={k}")
    return spark.read.schema(RESULT).parquet(folder).drop("round")


def hard_negatives(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchor_every: int = 50,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """For each anchor (rows whose id ``anchor_every`` divides) and each of its ``positives`` best rows of the same label: the ``negatives``
    best rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's."""
    rows = stage(usable(vectors, id_col, vec_col, label_col), "zone-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    if not size["n"]:
        return vectors.sparkSession.createDataFrame([], RESULT)
    return mine(block_table(rows, size["n"], size["width"], scale), size["width"], anchor_every, positives, negatives, low, high)


def op11_zone_mining(vectors: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))


ORACLE = """
WITH parts AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM scored WHERE same)
  WHERE place <= 5
), negative AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""
