"""Result tables (SNK1-SNK3) and staging of an intermediate result."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F


def save_result(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes a result as parquet and returns the table read back (SNK1)."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", **options: str) -> DataFrame:
    """Writes a result as a catalog table and returns it (SNK1); ``path`` as an option makes the table external."""
    df.write.mode(mode).options(**options).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_result(df: DataFrame, path: str) -> DataFrame:
    """Writes a result over whatever the path holds (SNK2); :func:`replace_table` keeps the old rows until the new ones are there."""
    return save_result(df, path, mode="overwrite")


def replace_table(df: DataFrame, name: str, folder: str, drop_old: bool = False) -> DataFrame:
    """Makes ``df`` the content of the catalog table ``name`` and returns the table (SNK2).

    The rows go to a new place in ``folder``; the table points to it only when all are written, so a write that fails
    leaves the table as it was, and ``df`` may read the table itself. Other columns than before mean a new definition of the
    table. The old files stay for readers that have begun, unless ``drop_old``.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    schema = save_result(df, path).schema
    known = spark.catalog.tableExists(name)
    old = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"] if known else None
    if known and spark.table(name).schema != schema:
        spark.sql(f"DROP TABLE {name}")
        known = False
    if known:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.catalog.createTable(name, path, "parquet", schema)
    if old and drop_old:
        remove_folder(spark, old)
    return spark.table(name)


def append_result(df: DataFrame, path: str) -> DataFrame:
    """Appends rows to a result table (SNK3); an append that is repeated adds them again, see :func:`append_batch`."""
    return save_result(df, path, mode="append")


def append_batch(df: DataFrame, path: str, batch: str, column: str = "batch") -> DataFrame:
    """Appends rows as the batch ``batch`` and returns the table, the batch of each row in ``column`` (SNK3).

    A batch that comes again takes the place of its own earlier rows and of no others, and one that fails half way leaves the
    table as it was. An empty batch changes nothing.
    """
    if column in df.columns:
        raise ValueError(f"the rows have a column {column} of their own")
    rows = df.withColumn(column, F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of both inputs, matched by column name; equal rows are kept (ST1)."""
    return df.unionByName(new)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session that runs in one process (tests, a laptop) gets a folder of its own when none is set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="caseloom-"))
        folder = context.getCheckpointDir()
    return folder


def _on(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of results that nobody reads any more."""
    place, files = _on(spark, path)
    files.delete(place, True)


@lru_cache
def _session_folder(spark: SparkSession, shared: str) -> str:
    folder = f"{shared}/caseloom-{uuid.uuid4().hex}"
    place, files = _on(spark, folder)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; it goes when the driver ends."""
    return f"{_session_folder(spark, shared_folder(spark))}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Deletes all that was staged so far. For long sessions, between queries; results that are still lazy read it no more."""
    remove_folder(spark, _session_folder(spark, shared_folder(spark)))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once in the shared folder so several readers do not recompute it, even if executors are lost."""
    return save_result(df, new_folder(df.sparkSession, name))
