"""Readers, sinks, staging and the streamed balance."""

import datetime as dt
import subprocess
import sys
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseloom.plans import ledger as ledger_plans
from caseloom.sources import readers, sinks
from caseloom.sources.schemas import CASE_TABLES, schema
from caseloom.sources.views import Views
from caseloom.streaming import balance

from .conftest import rows


def test_all_declared_schemas_parse(spark):
    for ddl in CASE_TABLES.values():
        assert schema(ddl).fields


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_case_tables_round_trip(spark, case, tmp_path, fmt):
    case("menu").write.format(fmt).save(str(tmp_path / "menu"))
    assert rows(readers.read_case_table(spark, "menu", str(tmp_path / "menu"), fmt)) == rows(case("menu"))


def test_results_are_written_replaced_and_appended(case, tmp_path):
    path = str(tmp_path / "ratings")
    assert sinks.save_result(case("ratings"), path).count() == 8
    assert sinks.append_result(case("ratings"), path).count() == 16
    assert sinks.replace_result(case("ratings"), path).count() == 8
    with pytest.raises(Exception):
        sinks.save_result(case("ratings"), path)


def test_catalog_tables(spark, case, tmp_path):
    table = sinks.save_table(case("ratings"), "saved_ratings", path=str(tmp_path / "t"))
    assert table.count() == 8 and spark.table("saved_ratings").columns == ["rating_id", "order_id", "rating"]
    spark.sql("DROP TABLE saved_ratings")


def test_stage_uses_the_shared_folder(spark, case):
    staged = sinks.stage(case("menu"), "menu")
    assert rows(staged) == rows(case("menu"))
    folder = sinks.shared_folder(spark).removeprefix("file:")
    own = {f.removeprefix("file://").removeprefix(f"{folder}/").split("/")[0] for f in staged.inputFiles()}
    assert len(own) == 1 and own.pop().startswith("caseloom-")
    assert all("/menu-" in f for f in staged.inputFiles())


def test_staged_folders_go(spark, case, tmp_path):
    path = str(tmp_path / "old")
    sinks.save_result(case("menu"), path)
    sinks.remove_folder(spark, path)
    assert not (tmp_path / "old").exists()
    staged = sinks.stage(case("menu"), "menu").inputFiles()[0].removeprefix("file://")
    assert Path(staged).exists()
    sinks.drop_staged(spark)
    assert not Path(staged).exists()
    assert rows(sinks.stage(case("menu"), "menu")) == rows(case("menu"))


def test_staged_folders_go_when_the_driver_ends(tmp_path):
    program = f"""
from caseloom.session import local_session
from caseloom.sources import sinks
spark = local_session(cpus=1, shuffle_partitions=1)
spark.sparkContext.setCheckpointDir({str(tmp_path / "shared")!r})
assert sinks.stage(spark.range(5), "numbers").count() == 5
"""
    subprocess.run([sys.executable, "-c", program], check=True, timeout=180, cwd=Path(__file__).parent.parent)
    for _ in range(100):
        if not list(tmp_path.glob("shared/*/caseloom-*")):
            break
        time.sleep(0.1)
    assert list(tmp_path.glob("shared/*")) and not list(tmp_path.glob("shared/*/caseloom-*"))


def failing(df):
    """Rows of which the last fails when it is written."""
    return df.repartition(4).withColumn("rating", F.when(F.col("order_id") < 10, F.col("rating")).otherwise(F.raise_error(F.lit("stop")).cast("int")))


def test_a_replaced_table_survives_a_failed_write(spark, case, tmp_path):
    folder, ratings = str(tmp_path), case("ratings")
    table = sinks.replace_table(ratings, "replaced_ratings", folder)
    assert rows(table) == rows(ratings)
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(failing(ratings), "replaced_ratings", folder)
    assert rows(spark.table("replaced_ratings")) == rows(ratings)
    # From its own rows, and the old files stay for those who read them.
    half = sinks.replace_table(spark.table("replaced_ratings").where("rating > 3"), "replaced_ratings", folder)
    assert rows(half) == rows(ratings.where("rating > 3")) and rows(table) == rows(ratings)
    # Other columns, and no old files.
    before = half.inputFiles()[0].removeprefix("file://")
    other = sinks.replace_table(ratings.select("order_id"), "replaced_ratings", folder, drop_old=True)
    assert rows(other) == rows(ratings.select("order_id")) and not Path(before).exists()
    spark.sql("DROP TABLE replaced_ratings")


def test_an_append_may_be_repeated(case, tmp_path):
    path, ratings = str(tmp_path / "t"), case("ratings")
    low, high = ratings.where("rating <= 3"), ratings.where("rating > 3")
    sinks.append_batch(low, path, "low")
    table = sinks.append_batch(high, path, "high")
    assert rows(table.drop("batch")) == rows(ratings)
    for _ in range(2):
        table = sinks.append_batch(high, path, "high")
        assert rows(table.drop("batch")) == rows(ratings)
    with pytest.raises(Exception, match="stop"):
        sinks.append_batch(failing(ratings), path, "low")
    assert rows(table.drop("batch")) == rows(ratings)
    sinks.append_batch(high.where("false"), path, "low")
    assert rows(table.where("batch = 'low'").drop("batch")) == rows(low)
    with pytest.raises(ValueError):
        sinks.append_batch(ratings, path, "x", column="rating")


def test_scans_read_only_used_columns(spark):
    orders = readers.Tables(spark, "/root/testdata/sf0.001").orders
    plan = orders.filter("o_orderkey = 5").select("o_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan and "EqualTo(o_orderkey,5)" in plan
    with pytest.raises(AttributeError):
        readers.Tables(spark, "x").nothing


TXN = "customer_id int, txn_time timestamp_ntz, txn_type string, txn_amount decimal(12,2)"


def test_streamed_balance_equals_the_batch_balance(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    at = dt.datetime(2020, 1, 1)
    first = [(1, at, "deposit", Decimal("10.00")), (2, at, "purchase", Decimal("3.00"))]
    # The second file holds an older transaction of customer 1 and a new customer.
    second = [(1, at - dt.timedelta(1), "withdrawal", Decimal("4.50")), (3, at, "deposit", Decimal("1.00"))]

    schema = balance.balances(spark.createDataFrame([], TXN)).schema

    def run():
        stream = spark.readStream.schema(TXN).parquet(source)
        balance.start_balance_stream(stream, target, checkpoint, compact_every=1).awaitTermination()
        return rows(balance.current_balances(spark, target, schema, 1))

    assert rows(balance.current_balances(spark, target, schema)) == []
    spark.createDataFrame(first, TXN).write.parquet(source)
    assert run() == [(1, Decimal("10.00"), 1, at), (2, Decimal("-3.00"), 1, at)]
    spark.createDataFrame(second, TXN).write.mode("append").parquet(source)
    streamed = run()
    assert streamed == [(1, Decimal("5.50"), 2, at), (2, Decimal("-3.00"), 1, at), (3, Decimal("1.00"), 1, at)]
    assert streamed == rows(balance.balances(spark.read.schema(TXN).parquet(source)))
    # Nothing new: a further run changes nothing. The second batch has compacted the first.
    assert run() == streamed
    assert rows(spark.read.parquet(f"{target}/base")) == [(1, Decimal("10.00"), 1, at, 1), (2, Decimal("-3.00"), 1, at, 1)]
    # A batch that comes again writes the same rows to the same place.
    repeated = spark.read.parquet(f"{target}/changes/batch=1").cache()
    repeated.count()
    repeated.write.mode("overwrite").parquet(f"{target}/changes/batch=1")
    assert rows(balance.current_balances(spark, target, schema, 1)) == streamed


def test_stream_reads_a_table_of_several_files(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    parts = ledger_plans.realtime_balance(Views(spark, str(tmp_path)))
    whole = ledger_plans.realtime_balance(Views(spark, "/root/testdata/sf0.001"))
    assert rows(parts) == rows(whole) and parts.count() > 0


def test_append_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(sinks.append_rows(a, b)) == [(1, "x"), (2, "y")]
    assert rows(a.select(F.col("n"))) == [(1,)]
