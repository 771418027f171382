"""Reading typed tables and JSON text (SRC1-SRC4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import CASE_TABLES, DATA_TABLES, schema


class Tables:
    """Lazy access to the parquet tables of one folder: ``Tables(spark, folder).orders``.

    The schema is declared, so no job runs to infer it, and each scan reads only the columns a query uses.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DATA_TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(schema(DATA_TABLES[name])).parquet(f"{self.folder}/{name}.parquet")


def read_case_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Reads a business-case table with its declared schema."""
    return spark.read.format(fmt).schema(schema(CASE_TABLES[name])).load(path)


def inline_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> DataFrame:
    """Rows written in code, typed by the declared schema (SRC2)."""
    return spark.createDataFrame(list(rows), schema(CASE_TABLES[name]))


def json_fields(df: DataFrame, text: str, ddl: str) -> DataFrame:
    """Replaces a JSON text column by its typed fields; field names may hold dots when back-quoted in ``ddl`` (SRC4).

    A field that is absent, or text that is not JSON, gives NULL.
    """
    parsed = F.from_json(F.col(text), ddl)
    names = [f.name for f in schema(ddl).fields]
    others = [c for c in df.columns if c != text]
    return df.select(*others, parsed.alias("_json")).select(*others, *[F.col("_json").getField(n).alias(n) for n in names])


def json_field(text: Column, key: str) -> Column:
    """One JSON field as text (SF21); the key may hold dots."""
    return F.get_json_object(text, f"$['{key}']")
