"""Real-time balance (STM1): one balance per customer, updated by every transaction that arrives.

Sums do not depend on the order of arrival, so late transactions need no watermark, and the state is one row per
customer. Each micro-batch writes the balances it changed to ``changes/batch=<n>``; every COMPACT_EVERY batches, before its
changes, the balances so far are merged into ``base/version=<n>``. A reader takes the latest base and the few batches from it
on. A batch that is repeated after a failure overwrites its folders with the same rows. Older folders can be deleted at any time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.ledger import KEY, signed
from ..sources.sinks import new_folder

COMPACT_EVERY = 20


def balances(txns: DataFrame) -> DataFrame:
    """Balance, number of transactions and last transaction time per customer; works on a stream and on a table."""
    return txns.groupBy(*KEY).agg(
        F.sum(signed()).alias("balance"), F.count(F.lit(1)).alias("txns"), F.max("txn_time").alias("last_txn_time")
    )


def start_balance_stream(
    txns: DataFrame, target: str, checkpoint: str, available_now: bool = True, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Starts the stream; changed balances and their compacted bases go to ``target``."""

    schema = balances(txns).schema

    def write_changes(changed: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            so_far = current_balances(changed.sparkSession, target, schema, compact_every, before=batch_id)
            so_far.write.mode("overwrite").parquet(f"{target}/base/version={batch_id}")
        changed.write.mode("overwrite").parquet(f"{target}/changes/batch={batch_id}")

    writer = balances(txns).writeStream.outputMode("update").foreachBatch(write_changes)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_balances(
    spark: SparkSession, target: str, schema: StructType, compact_every: int = COMPACT_EVERY, before: int | None = None
) -> DataFrame:
    """The latest balance of every customer among the batches written so far (those below ``before``); no row without a batch."""
    try:
        changes = spark.read.schema(StructType([*schema, StructField("batch", LongType())])).parquet(f"{target}/changes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if before is not None:
        changes = changes.where(F.col("batch") < before)
    last = changes.agg(F.max("batch")).first()[0]
    base = (last or 0) // compact_every * compact_every
    rows = changes.where(F.col("batch") >= base)
    if base:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{target}/base/version={base}").withColumn("batch", F.lit(-1).cast("bigint")))
    values = [c for c in schema.names if c not in KEY]
    latest = F.max_by(F.struct(*values), "batch")
    return rows.groupBy(*KEY).agg(latest.alias("_v")).select(*KEY, "_v.*")


def run_balance_stream(txns: DataFrame) -> DataFrame:
    """Runs the stream over everything available and returns the current balances."""
    spark = txns.sparkSession
    target, checkpoint = new_folder(spark, "balances"), new_folder(spark, "balance-stream")
    start_balance_stream(txns, target, checkpoint).awaitTermination()
    return current_balances(spark, target, balances(txns).schema)
