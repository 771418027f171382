"""Mixing sources to target weights by hash-random keys, distributed prefix sums and a cut at each source's exact budget.

Every document gets a key that looks random but depends on its id and text only, so a rerun takes the same documents. Keys are cut into
ranges; the sums of the ranges are added up per source, and only the range that holds the cut is sorted. Nothing but one row per
range and per source is ever brought together, and texts are not moved.

Defined results: a null text has size 0; rows of a null source form a source of their own, the last one; documents with the same
id and text share a key and share what the cut leaves for it in proportion to their sizes, rounded down; an empty table gives an empty mix;
when every source stops at its limit the mix is smaller than asked. A null id has a key like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.sinks import stage
from .blocks import WORD

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
RANGE_DIGITS = 3


def key_of(doc_id: str = "doc_id"):
    """The random key of a document, by its id and text: 32 hexadecimal digits."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and random key of every document."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
        key_of().alias("mix_key"),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Target words of each source from one row per source (source, source_size).

    Sources stand in code point order, null last, and take the weights in turn. The total is shared by weight; a source stops at
    ``most`` times its size and the rest goes to the others. Raising all targets together, sources reach their limits in the order
    of limit over weight, so one sorted pass finds the level at which the total is used up.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    turn = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))).withColumn("most", F.lit(float(most)) * F.col("source_size"))
    ranked = ranked.withColumn("level", F.col("most") / F.col("weight"))
    below = Window.orderBy("level", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = ranked.select(
        "*",
        F.coalesce(F.sum("most").over(below), F.lit(0.0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))).alias("open"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
    )
    # A source is at its limit if all sources from it on would reach its level with what the smaller levels left.
    capped = F.col("level") * F.col("open") <= F.col("total") - F.col("full")
    ranked = ranked.withColumn("capped", capped)
    first = F.first(F.when(~F.col("capped"), (F.col("total") - F.col("full")) / F.col("open")), ignorenulls=True).over(
        Window.orderBy("level", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return ranked.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * first).alias("target"))


def cuts(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, whole epochs, and the key at which the last epoch is cut.

    ``cut_part`` is what the documents with that key give of their ``cut_size`` words; all smaller keys are taken whole.
    """
    keys = stage(sized(docs).groupBy("source", "mix_key").agg(F.sum("size").alias("size")), "mix-keys")
    ranges = stage(keys.groupBy("source", F.substring("mix_key", 1, RANGE_DIGITS).alias("part")).agg(F.sum("size").alias("size")), "mix-ranges")
    sources = targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = sources.withColumn("words", F.floor("target").cast("bigint")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("bigint")
    ).withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
    by_part = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("before", F.coalesce(F.sum("size").over(by_part), F.lit(0)))
    same = starts["source"].eqNullSafe(sources["source"])
    holding = starts.join(sources, same).where((F.col("rest") >= F.col("before")) & (F.col("rest") < F.col("before") + F.col("size")))
    holding = holding.select(starts["source"].alias("of"), "part", "before", "rest")
    inside = keys.join(holding, keys["source"].eqNullSafe(holding["of"]) & (F.substring("mix_key", 1, RANGE_DIGITS) == F.col("part")))
    by_key = Window.partitionBy("source", "part").orderBy("mix_key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(by_key), F.lit(0)))
    cut = inside.where((F.col("rest") >= F.col("start")) & (F.col("rest") < F.col("start") + F.col("size"))).select(
        F.col("source").alias("cut_source"), F.col("mix_key").alias("cut_key"), (F.col("rest") - F.col("start")).alias("cut_part"), F.col("size").alias("cut_size")
    )
    return stage(sources.join(cut, sources["source"].eqNullSafe(cut["cut_source"]), "left").drop("cut_source", "rest", "words"), "mix-cuts")


MADE = ("size", "source_size", "target", "epochs", "last", "taken")


def _taken(docs: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """The documents with a value ``_mix`` that holds MADE."""
    plan = cuts(docs, weights, most)
    plan = plan.select(F.struct(*plan.columns).alias("_plan"))
    base = docs.withColumns({"_key": key_of(), "_size": F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")})
    joined = base.join(plan, F.col("source").cast("string").eqNullSafe(F.col("_plan.source")), "left")
    share = F.floor(F.col("_plan.cut_part") * F.col("_size") / F.greatest("_plan.cut_size", F.lit(1)))
    last = F.when(F.col("_key") < F.col("_plan.cut_key"), F.col("_size")).when(F.col("_key") == F.col("_plan.cut_key"), share).otherwise(0).cast("bigint")
    made = (F.col("_size"), F.col("_plan.source_size"), F.col("_plan.target"), F.col("_plan.epochs"), last, F.col("_plan.epochs") * F.col("_size") + last)
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), F.struct(*(x.alias(n) for x, n in zip(made, MADE, strict=True))).alias("_mix"))


def with_taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``size, source_size, target, epochs, last, taken``: words in the text, its source's words and target, whole epochs,
    words of the last, partial epoch, and all words taken. Columns of these names in ``docs`` are replaced."""
    return _taken(docs, weights, most).select(*(F.col(f"`{c}`") for c in docs.columns if c not in MADE), "_mix.*")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself: a row for every time a document is taken, the last one with its first words only where the budget ends in
    it (``n_chars`` is then that of the shortened text). Documents without words are kept once: they cost nothing."""
    columns = docs.columns
    size, last = F.col("_mix.size"), F.col("_mix.last")
    cut = (last > 0) & (last < size)
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # words, each with the white space before it
    head = F.array_join(F.slice(pieces, F.lit(1), F.greatest(last, F.lit(1)).cast("int")), "")
    copies = F.when(size == 0, F.array(F.lit(False))).otherwise(
        F.concat(F.array_repeat(F.lit(False), F.col("_mix.epochs").cast("int")), F.when(last > 0, F.array(cut)).otherwise(F.array().cast("array<boolean>")))
    )
    rows = _taken(docs, weights, most).withColumn("_cut", F.explode(copies))
    replaced = {"text": F.when(F.col("_cut"), head).otherwise(F.col("text"))}
    if "n_chars" in columns:
        replaced["n_chars"] = F.when(F.col("_cut"), F.length(head).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.select(*(replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in columns))


def op6_mixing(docs: DataFrame) -> DataFrame:
    return with_taken(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n, row_number() OVER (ORDER BY source IS NULL, CAST(source AS BLOB)) - 1 AS turn FROM d GROUP BY source),
w AS (SELECT *, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, sum(n) OVER () AS total FROM s),
levels AS (SELECT w.*, coalesce((SELECT max(least(3 * o.n / o.weight, 1e300)) FROM w o
             WHERE (SELECT sum(least(3 * p.n, p.weight * (3 * o.n / o.weight))) FROM w p) <= w.total), 0) AS low FROM w),
share AS (SELECT *, (total - sum(CASE WHEN 3 * n / weight <= low THEN 3 * n ELSE 0 END) OVER ())
             / nullif(sum(CASE WHEN 3 * n / weight <= low THEN 0 ELSE weight END) OVER (), 0) AS each FROM levels),
t AS (SELECT source, CAST(n AS BIGINT) AS source_size, CASE WHEN 3 * n / weight <= low THEN 3 * n ELSE weight * each END AS target FROM share),
r AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs,
             CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - start)) AS BIGINT) AS taken FROM r
"""
