"""Run context, contract findings, partitioned and verified sinks, all-or-nothing JDBC writes."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.plans.pipeline import RunContext, bronze
from mercato.sources import files, sinks
from mercato.sources.sql import read_jdbc

AS_OF = dt.datetime(2023, 12, 31, 23, 30, tzinfo=dt.timezone(dt.timedelta(hours=-3)))


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


# ---------------------------------------------------------------- Q2
def test_one_timestamp_for_a_run_in_utc(spark):
    df = quality.add_ingestion_metadata(spark.range(2), RunContext(AS_OF).as_of)
    assert df.selectExpr("cast(ingestion_date as string)", "ingestion_year", "ingestion_month").distinct().collect() == [
        ("2024-01-01 02:30:00", 2024, 1)]
    assert RunContext.now().as_of.tzinfo is not None


def test_a_rerun_with_the_same_context_writes_the_same_rows(spark, tmp_path, scratch):
    raw = str(tmp_path / "customers.csv")
    with open(raw, "w") as f:
        f.write('Customer Id,Note\n1,"two\nlines"\n2, blank ends \n2, blank ends \n3,\n')
    out = []
    for fmt in ("parquet", "parquet", "csv"):
        target = scratch("bronze")
        report = bronze(spark, raw, target, fmt=fmt, run=RunContext(AS_OF))
        assert report.rows["bronze"] == 3
        out.append(files.read_parquet(spark, target) if fmt == "parquet" else files.read_csv_bronze(spark, target))
    assert rows(out[0]) == rows(out[1])
    names = ["customer_id", "note"]
    assert rows(out[0].select(names)) == rows(out[2].select(names))


# ---------------------------------------------------------------- Q7
def test_contract_findings(spark):
    df = spark.createDataFrame(
        [("o1", "1", None, "9.5", "x"), ("o2", "b", "card", "7", "y"), ("o3", None, "card", None, "z")],
        "order_id string, payment_sequential string, payment_type string, payment_value string, extra_col string")
    got = {r.column_name: tuple(r)[1:] for r in quality.contract_findings(df, "order_payments").collect()}
    assert got == {
        "order_id": ("string", "string", "ok", 3, 0, 0),
        "payment_sequential": ("int", "string", "uncastable", 3, 1, 1),
        "payment_type": ("string", "string", "null in required", 3, 1, 0),
        "payment_installments": ("int", None, "missing", 3, None, None),
        "payment_value": ("double", "string", "null in required", 3, 1, 0),
        "extra_col": (None, "string", "extra", 3, 0, 0)}
    typed = df.select("order_id", F.lit(1).cast("long").alias("payment_sequential"))
    assert {r.column_name: r.finding for r in quality.contract_findings(
        quality.add_ingestion_metadata(typed), "order_payments").collect()} == {
        "order_id": "ok", "payment_sequential": "other type", "payment_type": "missing",
        "payment_installments": "missing", "payment_value": "missing"}


def test_contract_findings_are_one_aggregate(spark):
    plan = quality.contract_findings(spark.range(5).withColumn("order_id", F.lit("a")), "order_payments")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


# ---------------------------------------------------------------- S6
def test_partitioned_sink_writes_few_files_and_splits_a_hot_partition(spark, scratch):
    df = spark.range(0, 40_000, 1, 16).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.lit(2024).alias("ingestion_year"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 12 + 1).cast("int")).alias("ingestion_month"))

    def files_of(path):
        local = path.removeprefix("file:")
        return {p: len(glob.glob(os.path.join(p, "*.parquet"))) for p in glob.glob(os.path.join(local, "*", "*"))}

    spread, packed = scratch("spread"), scratch("packed")
    sinks.write_parquet_partitioned(df, spread, rebalance=False)
    sinks.write_parquet_partitioned(df, packed)
    assert sum(files_of(spread).values()) > 5 * len(files_of(spread))
    assert max(files_of(packed).values()) <= 2 and len(files_of(packed)) == len(files_of(spread))
    assert rows(files.read_parquet(spark, packed)) == rows(files.read_parquet(spark, spread))

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        split = scratch("split")
        sinks.write_parquet_partitioned(df, split)
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = next(n for p, n in files_of(split).items() if p.endswith("ingestion_month=1"))
    assert hot >= 3
    assert "RebalancePartitions" in df.hint("rebalance", "ingestion_month")._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- S10
@pytest.mark.parametrize("damage", [
    lambda d: d.withColumn("v", F.when(F.col("id") == 3, "other").otherwise(F.col("v"))),
    lambda d: d.withColumn("v", F.when(F.col("id") == 4, "").otherwise(F.col("v"))),  # null became empty
    lambda d: d.withColumnsRenamed({"v": "w", "w": "v"}),  # two columns swapped
    lambda d: d.filter("id <> 5").union(d.filter("id = 6")),  # one row lost, one twice
    lambda d: d.drop("w")])
def test_one_altered_cell_is_found(spark, scratch, damage):
    df = spark.range(50).select("id", F.when(F.col("id") != 4, F.concat(F.lit("v"), "id")).alias("v"),
                                F.concat(F.lit("w"), "id").alias("w"), F.array("id").alias("tags"))
    path = scratch("digest")
    counts = sinks.write_verified(df, lambda d: sinks.write_parquet(d, path), lambda: files.read_parquet(spark, path))
    assert counts == {"expected_rows": 50, "written_rows": 50}
    with pytest.raises(sinks.WriteVerificationError):
        sinks.write_verified(df, lambda d: sinks.write_parquet(d, path), lambda: damage(files.read_parquet(spark, path)))


def test_csv_read_back_is_compared_in_the_written_types(spark, scratch):
    df = spark.createDataFrame([(1, Decimal("1.50"), "a,b", None), (2, Decimal("2.00"), 'say "x"', " blanks ")],
                               "id int, v decimal(18,2), t string, u string")
    path = scratch("csv")
    assert sinks.write_verified(df, lambda d: sinks.write_csv(d, path),
                                lambda: files.read_csv_bronze(spark, path))["written_rows"] == 2


# ---------------------------------------------------------------- S8
URL = "jdbc:derby:memory:staging_test;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def table(spark, name):
    back = read_jdbc(spark, URL, name, PROPS)
    return sorted(map(tuple, back.collect())), back


def test_jdbc_failure_leaves_the_old_rows_and_no_staging_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert sinks.write_jdbc(df, URL, "SAFE", PROPS) == {"expected_rows": 2, "written_rows": 2}
    failing = spark.range(100).select(F.col("id").cast("int").alias("id"),
                                      F.when(F.col("id") == 99, F.raise_error(F.lit("task dies"))).otherwise("n").alias("name"))
    with pytest.raises(Exception, match="task dies"):
        sinks.write_jdbc(failing, URL, "SAFE", PROPS, num_partitions=4)
    assert table(spark, "SAFE")[0] == [(1, "a"), (2, "b")]
    with pytest.raises(sinks.WriteVerificationError):
        sinks.write_jdbc(df.withColumn("unknown", F.lit(1)), URL, "SAFE", PROPS)
    assert table(spark, "SAFE")[0] == [(1, "a"), (2, "b")]
    names = read_jdbc(spark, URL, "SYS.SYSTABLES", PROPS).select("TABLENAME").collect()
    assert not [r[0] for r in names if "STAGING" in r[0]]


def test_jdbc_target_keeps_its_own_types_and_takes_fewer_columns(spark):
    with sinks._jdbc_connection(spark, URL, PROPS) as connection:
        sinks._jdbc_run(connection, "CREATE TABLE TYPED (ID INT NOT NULL PRIMARY KEY, NAME VARCHAR(20), EXTRA INT DEFAULT 7)")
        connection.commit()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    for _ in range(2):
        sinks.write_jdbc(df, URL, "TYPED", PROPS, num_partitions=2)
        got, back = table(spark, "TYPED")
        assert got == [(1, "a", 7), (2, "b", 7)]
    with pytest.raises(Exception):  # the target's key refuses a repeated id; its rows stay
        sinks.write_jdbc(df.union(df), URL, "TYPED", PROPS)
    assert table(spark, "TYPED")[0] == [(1, "a", 7), (2, "b", 7)]
