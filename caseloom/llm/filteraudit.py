"""Audit of five document filters: what each removes at each step of every order in which they can be applied.

A document becomes a mask of the filters it fails. Documents are counted by part and mask (32 masks at most), and only these cells are
folded across the array of all 120 orders, which stands in the plan as a literal: ``aggregate`` walks an order's letters and ``transform``
makes one struct of counts for every order and step, 600 for each cell, weighted by the cell's documents. The structs of a part's cells
are merged by elementwise sums. The work past the counting depends on the number of parts alone.

Whether a text stands under a smaller id too is decided on hashes: rows shrink to (text hash, mask, part, labels) with their smallest id
before the smallest id of a text is looked up, so a text that a third of all rows repeat is a few rows for each task.

Defined results: a null text is an empty one; null parts are the empty string; texts are the same if their SHA-256 is; a row without an id
neither repeats a smaller id nor is one; rows that repeat an id and a text count each and do not repeat each other; a document is good
(toxic) if any of its labels says so; an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
WHITE = r"[\x20\x09-\x0D]+"


def failed_by_text(text: Column) -> Column:
    """The mask of the filters A to D that a text fails; bit k is the k-th filter."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    count = F.size(words)
    fails = [
        count < 200,
        100 * F.size(F.array_distinct(words)) < 50 * count,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Documents by part and mask: all, good and toxic ones."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("same"), failed_by_text(text).alias("mask"),
    )
    # Rows without an id have no labels; they are dealt by their text, not all together.
    facts = facts.withColumn("key", F.coalesce("doc_id", F.xxhash64("same")))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = facts.join(known, (F.col("key") == F.col("labelled")) & F.col("doc_id").isNotNull(), "left").select(
        "doc_id", "part", "same", "mask", *(F.coalesce(c, F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    kinds = ["same", "mask", "part", "good", "toxic"]
    by_id = joined.groupBy(*kinds, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = by_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("same"))
    single = F.col("without_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    halves = groups.withColumn("least", least).select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("mask"), single.alias("n")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - single).alias("n")))))
    return halves.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _struct(**values: Column) -> Column:
    return F.struct(*(v.cast("bigint").alias(k) for k, v in values.items()))


def folded(cell: Column) -> Column:
    """600 structs of counts for one cell: its documents at every step of every order, order by order."""
    bit = F.create_map(*(F.lit(x) for k, f in enumerate(FILTERS) for x in (f, 1 << k)))
    none = F.lit(0)

    def walk(order: Column) -> Column:
        start = F.struct(F.lit(False).alias("gone"), F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>").alias("steps"))

        def step(state: Column, letter: Column) -> Column:
            fails = cell["mask"].bitwiseAND(bit[letter]) != 0
            now = fails & ~state["gone"]
            gone = state["gone"] | fails
            counts = _struct(
                kept=F.when(gone, none).otherwise(cell["n"]), removed=F.when(now, cell["n"]).otherwise(none),
                redundant=F.when(fails & state["gone"], cell["n"]).otherwise(none), unique_fails=F.when(cell["mask"] == bit[letter], cell["n"]).otherwise(none),
                good_lost=F.when(now, cell["good"]).otherwise(none), toxic_lost=F.when(now, cell["toxic"]).otherwise(none))
            return F.struct(gone.alias("gone"), F.concat(state["steps"], F.array(counts)).alias("steps"))

        return F.aggregate(F.split(order, ""), start, step, lambda state: state["steps"])

    return F.flatten(F.transform(F.array(*map(F.lit, ORDERS)), walk))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each part, order and step."""
    zero = F.array_repeat(_struct(**{c: F.lit(0) for c in COUNTS}), len(ORDERS) * len(FILTERS))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: _struct(**{c: x[c] + y[c] for c in COUNTS}))
    merged = cells(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).select(
        "part", F.aggregate(F.transform("cells", folded), zero, add).alias("counts"))
    steps = merged.select("part", F.posexplode("counts").alias("at", "c"))
    letter = F.element_at(F.array(*(F.lit(x) for o in ORDERS for x in o)), F.col("at") + 1)
    steps = steps.select(
        "part", F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("at") / len(FILTERS)).cast("int") + 1).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), letter.alias("filter"), *(F.col("c")[c].alias(c) for c in COUNTS))
    # At most 600 rows for each part.
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def op12_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts
), rated AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT w.part, coalesce(r.good, 0) AS good, coalesce(r.toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM worded w LEFT JOIN rated r ON r.doc_id = w.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
), letters AS (
  SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(l)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l) JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
  JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS l, substr(filter_order, 1, step - 1) AS earlier FROM orders, (VALUES (1), (2), (3), (4), (5)) AS s(step)
), told AS (
  SELECT part, filter_order, step, l, n, good, toxic, fails = l AS only_here, contains(fails, l) AS here,
         length(translate(fails, earlier, '')) < length(fails) AS before
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, l, sum(CASE WHEN here OR before THEN 0 ELSE n END) AS kept, sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN here AND before THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_here THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN here AND NOT before THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, l
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted
"""
