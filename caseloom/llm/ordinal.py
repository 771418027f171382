"""Quality classifier: cumulative-link (ordinal logistic) regression on graded ratings over hashed text features.

Grades: 0 toxic, 1 low quality, 2 good. One weight vector is shared by all grades, ordered thresholds cut its score: the probability of
a grade of at most k is the logistic function of threshold k minus the score. Every document gets its expected grade and the
probability of the top grade, by which it is selected.

Features are hashed into a table of fixed size: words, word beginnings and endings, and binned shares (capitals, signs, repeated
words). The model is fitted on ``most_ratings`` rated documents at most, those whose ids have the smallest hashes; the bound keeps
the fit in one task and everything broadcast is of fixed size. All documents are scored.

Defined results: a rating with toxic not 0 has grade 0 whatever its quality; a rating without toxic counts as not toxic, without
quality it is left out; several ratings of a document all count; ratings without a document or id are left out; a null or empty text has
the binned features only. Without ratings every document gets the same score and probability 0.5, and is kept. Columns of the
result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks as B

SIZE_BITS = 18
# A block's arrays take some 200 bytes for each byte of its text.
BLOCK_BYTES = 1 << 18
GRADES = 3
MOST_RATINGS = 16_384
EPOCHS = 40
BATCH = 128
LEAST_SEEN = 3
RATE = 0.1
SHRINK = 1e-5
LEAST_TAIL = 0.5
_SALTS = {name: np.uint64(k * 0x9E3779B9 + 1) for k, name in enumerate(("word", "begin4", "begin5", "begin6", "end3", "bins"))}
_PLAIN = np.zeros(256, bool)  # letters, digits, white space, full stop, comma, and all bytes beyond ASCII
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *B.SPACES, 44, 46, *range(128, 256)]] = True


def features(data: np.ndarray, offsets: np.ndarray, bits: int = SIZE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature number) pairs of a block, in order."""
    rows = len(offsets) - 1
    starts, ends, owner = B.word_spans(data, offsets)
    sums, exact = B.prefix_sums(data, lower=True), B.prefix_sums(data)
    words = B.span_hashes(sums, starts, ends)
    found = [(owner, words + _SALTS["word"])]
    for size in (4, 5, 6):
        long = ends - starts > size
        found.append((owner[long], B.span_hashes(sums, starts[long], starts[long] + size) + _SALTS[f"begin{size}"]))
    long = ends - starts > 3
    found.append((owner[long], B.span_hashes(exact, ends[long] - 3, ends[long]) + _SALTS["end3"]))
    count = np.bincount(owner, minlength=rows)
    distinct = np.bincount(B.distinct_pairs(owner, words)[0], minlength=rows)
    same = np.zeros(len(owner), bool)
    same[1:] = (owner[1:] == owner[:-1]) & (words[1:] == words[:-1])
    size = np.maximum(np.diff(offsets), 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    some = np.maximum(count, 1)
    shares = (
        per_text((data >= 65) & (data <= 90)) / size, per_text(~_PLAIN[data]) / size, per_text(data == 124) / some,
        np.bincount(owner[same], minlength=rows) / some, distinct / some * np.minimum(1, 4 / np.log2(some + 2)),
    )
    for k, share in enumerate(shares):
        bins = np.minimum(share * 20, 12).astype(np.uint64)
        found.append((np.arange(rows), bins + np.uint64(100 * k) + _SALTS["bins"]))
    who, what = (np.concatenate(x) for x in zip(*found, strict=True))
    who, what, _ = B.distinct_pairs(who, B.mix(what) >> np.uint64(64 - bits))
    return who, what.astype(np.int64)


def fit(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, bits: int = SIZE_BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the likelihood of the grades, by adaptive gradient steps in a fixed order."""
    # A feature of one or two ratings only would be learned by heart.
    common = (np.bincount(columns, minlength=1 << bits) >= LEAST_SEEN)[columns]
    rows, columns = rows[common], columns[common]
    weights, squares = np.zeros(1 << bits), np.full(1 << bits, 1e-6)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES)[:-1]) / max(1, len(grades)), 0.02, 0.98)
    cuts = np.log(share / (1 - share))
    cuts = np.maximum.accumulate(cuts + np.arange(GRADES - 1) * 1e-3)
    cut_squares = np.full(GRADES - 1, 1e-6)
    pointers = np.searchsorted(rows, np.arange(len(grades) + 1))
    random = np.random.default_rng(7)
    for _ in range(epochs):
        order = random.permutation(len(grades))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            sizes = pointers[docs + 1] - pointers[docs]
            places = np.repeat(pointers[docs] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            present = columns[places]
            owner = np.repeat(np.arange(len(docs)), sizes)
            score = np.bincount(owner, weights[present], len(docs))
            padded = np.concatenate(([-np.inf], cuts, [np.inf]))
            y = grades[docs]
            upper, lower = 1 / (1 + np.exp(-np.clip(padded[y + 1] - score, -30, 30))), 1 / (1 + np.exp(-np.clip(padded[y] - score, -30, 30)))
            upper, lower = np.where(y == GRADES - 1, 1.0, upper), np.where(y == 0, 0.0, lower)
            # The likelihood's slope in the score, and in the two thresholds around the grade.
            slope = 1 - upper - lower
            gap = np.maximum(upper - lower, 1e-9)
            by_upper, by_lower = upper * (1 - upper) / gap, -lower * (1 - lower) / gap
            slope = -(by_upper + by_lower)
            step = np.bincount(present, slope[owner], 1 << bits) / len(docs)
            used = np.flatnonzero(step)
            step = step[used] - SHRINK * weights[used]
            squares[used] += step**2
            weights[used] += RATE * step / np.sqrt(squares[used])
            moves = np.array([by_upper[y == k].sum() + by_lower[y == k + 1].sum() for k in range(GRADES - 1)]) / len(docs)
            cut_squares += moves**2
            cuts = np.maximum.accumulate(cuts + RATE * moves / np.sqrt(cut_squares))
    return weights.astype(np.float32), cuts


def rated_sample(docs: DataFrame, ratings: DataFrame, most: int = MOST_RATINGS) -> DataFrame:
    """doc_id, text and grade of at most ``most`` ratings; of several texts under one id the one with the smallest hash."""
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    grade = F.when(toxic != 0, 0).when(quality == 0, 1).when(quality.isNotNull(), GRADES - 1)
    graded = ratings.select(F.col("doc_id").cast("bigint").alias("doc_id"), grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    graded = graded.orderBy(F.xxhash64("doc_id", F.lit(11)), "grade").limit(most)  # its size is bounded by ``most``
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return base.join(F.broadcast(graded), "doc_id").groupBy("doc_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.octet_length("text"))).alias("text"))


def train(docs: DataFrame, ratings: DataFrame, most: int = MOST_RATINGS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """The fitted model: weights of fixed size and thresholds."""

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        grades, ids = np.asarray(batch.column(2)), batch.column(0).to_pylist()
        for first, data, offsets in B.blocks(batch.column(1), BLOCK_BYTES):
            who, what = features(data, offsets)
            cuts = np.searchsorted(who, np.arange(len(offsets)))
            rows += [(ids[first + k], int(grades[first + k]), what[cuts[k] : cuts[k + 1]].astype(np.uint32)) for k in range(len(offsets) - 1)]
        yield B.packed(rows, pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("features", pa.binary())]))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
        sizes = np.asarray(B.lengths(table["features"], 4))
        weights, cuts = fit(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), B.unpacked(table["features"], "u4").astype(np.int32), np.asarray(table["grade"]).astype(np.int64), epochs=epochs)
        return pa.Table.from_batches([B.packed([(weights, cuts)], pa.schema([("weights", pa.binary()), ("cuts", pa.binary())]))])

    sample = rated_sample(docs, ratings, most).select("doc_id", "text", "grade")
    sets = B.per_batch(sample, extract, "doc_id long, grade int, features binary")
    model = sets.groupBy((F.col("grade") * 0).alias("all")).applyInArrow(solve, "weights binary, cuts binary").first()
    if model is None:
        return np.zeros(1 << SIZE_BITS, np.float32), np.zeros(GRADES - 1)
    return np.frombuffer(bytes(model["weights"]), np.float32), np.frombuffer(bytes(model["cuts"]))


def classified(docs: DataFrame, ratings: DataFrame, least_tail: float = LEAST_TAIL, most: int = MOST_RATINGS) -> DataFrame:
    """Adds expected_grade, tail_probability (of the top grade) and keep."""
    weights, cuts = train(docs, ratings, most)
    model = docs.sparkSession.sparkContext.broadcast(weights)
    made = ["expected_grade", "tail_probability", "keep"]
    columns = [c for c in docs.columns if c not in made]
    at = columns.index("text")

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = []
        for _, data, offsets in B.blocks(batch.column(at), BLOCK_BYTES):
            who, what = features(data, offsets)
            scores.append(np.bincount(who, model.value[what], len(offsets) - 1))
        pa.default_memory_pool().release_unused()
        margin = np.concatenate(scores)[:, None] - cuts[None, :]
        above = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))  # probability of a grade above each threshold
        tail = above[:, -1]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(columns))), pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= least_tail)], [*columns, *made])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns), "expected_grade double, tail_probability double, keep boolean"])
    return B.per_batch(docs.select(*columns), score, schema)


def kept_documents(docs: DataFrame, ratings: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The documents whose probability of the top grade is high enough, columns as they were."""
    return classified(docs, ratings, least_tail).where("keep").select(*docs.columns)


def op7_ordinal(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    return classified(docs.select("doc_id", "text"), ratings).drop("text")
