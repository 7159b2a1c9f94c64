"""Stage functions: raw CSV -> bronze -> silver -> gold -> marts.

Every stage reads the tables the previous stage *wrote*, so lineage is cut at
each layer: a lost executor recomputes at most one stage's tasks from durable
files, never the whole chain.  Row counts come from ``Observation`` during the
write; profiles are one aggregate per table (their output is one row per
column, so collecting it for the log is bounded).
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import quality
from mercato.plans.gold import Gold, Marts
from mercato.session import parallelism
from mercato.sources import files, sinks, testdata

log = logging.getLogger("mercato.pipeline")

SILVER_DATASETS = ("orders", "order_items", "order_payments", "customers", "products",
                   "category_translation", "sellers", "order_reviews")
GOLD_TABLES = ("dim_customers", "dim_products", "dim_sellers", "dim_dates", "fact_orders",
               "fact_order_items")


def describe(spark: SparkSession, text: str) -> None:
    """Label the calling thread's next jobs (shows up in the event log)."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:  # no SparkContext handle (e.g. Spark Connect)
        pass


@dataclass(frozen=True)
class RunContext:
    """What is the same for all tables of one run: a rerun with an equal context writes equal rows."""

    as_of: dt.datetime

    @classmethod
    def now(cls) -> RunContext:
        return cls(dt.datetime.now(dt.timezone.utc))


@dataclass
class StageReport:
    rows: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)


def write_tables(builders: dict[str, Callable[[], DataFrame]], root: str,
                 write: Callable[[DataFrame, str], None] = sinks.write_parquet,
                 workers: int = 1) -> StageReport:
    """Build and write independent tables, up to ``workers`` jobs at a time.

    Each table is its own Spark job; submitting several from a thread pool
    lets small jobs (dimensions, marts over a few months) use cores that a
    single job would leave idle.  Rows are counted with ``Observation``
    during the write.
    """
    report = StageReport()

    def one(name: str) -> tuple[str, int, float]:
        start = time.perf_counter()
        df = builders[name]()
        describe(df.sparkSession, f"write {name}")
        counted, obs = sinks.observed(df, name)
        write(counted, os.path.join(root, name))
        return name, int(obs.get["rows"]), round(time.perf_counter() - start, 3)

    if workers <= 1:
        results = [one(name) for name in builders]
    else:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            results = list(pool.map(one, builders))
    for name, rows, seconds in results:
        report.rows[name] = rows
        report.seconds[name] = seconds
    return report


def _log_profile(name: str, profile: DataFrame) -> list[dict]:
    rows = [r.asDict() for r in profile.where("null_count > 0").collect()]
    for r in rows:
        log.warning("%s: column %s has %d nulls (%.2f%%)", name, r["column_name"],
                    r["null_count"], r["null_pct"] or 0.0)
    return rows


# ------------------------------------------------------------------ bronze
def bronze(spark: SparkSession, raw_csv: str, target: str, fmt: str = "parquet",
           run: RunContext | None = None) -> StageReport:
    """Raw CSV -> bronze: guard, normalise names, full-row dedup, metadata, profile.

    Dedup runs before the ingestion timestamp is added, so it compares source
    columns only.  ``fmt='csv'`` keeps the CSV bronze layout of the source
    pipeline; Parquet is the default.
    """
    report = StageReport()
    run = run or RunContext.now()
    df = files.read_csv_raw(spark, raw_csv)
    quality.assert_non_empty(df)
    df = quality.normalize_columns(df)
    df = quality.add_ingestion_metadata(quality.dedup_full_row(df), run.as_of)
    if fmt == "csv":
        write = lambda d: sinks.write_csv(d, target)
        read = lambda: files.read_csv_bronze(spark, target)
    else:
        write = lambda d: sinks.write_parquet_partitioned(d, target, rebalance=False)
        read = lambda: files.read_parquet(spark, target)
    report.rows["bronze"] = sinks.write_verified(df, write, read)["written_rows"]
    # Profile the written table: the raw CSV is parsed once, not twice.
    report.notes["null_columns"] = _log_profile(raw_csv, quality.null_profile(read()))
    return report


# ------------------------------------------------------------------ silver
def silver(spark: SparkSession, bronze_path: str, dataset: str, target: str,
           bronze_format: str = "parquet", run: RunContext | None = None) -> StageReport:
    """Bronze -> silver: renames, contract check, casts, strict nulls, profile."""
    report = StageReport()
    df = (files.read_parquet(spark, bronze_path) if bronze_format == "parquet"
          else files.read_csv_bronze(spark, bronze_path))
    quality.assert_non_empty(df)
    df = quality.rename_typos(df, dataset)
    report.notes["extra_columns"] = quality.schema_contract(df, dataset)
    df = quality.drop_strict_nulls(quality.cast_to_contract(df, dataset), dataset)
    if "ingestion_year" not in df.columns:
        df = quality.add_ingestion_metadata(df, (run or RunContext.now()).as_of)
    report.rows["silver"] = sinks.write_verified(
        df, lambda d: sinks.write_parquet_partitioned(d, target, rebalance=False),
        lambda: files.read_parquet(spark, target))["written_rows"]
    # Profile the written Parquet (columnar) instead of a second pass over bronze.
    report.notes["optional_nulls"] = _log_profile(
        dataset, quality.optional_null_profile(files.read_parquet(spark, target), dataset))
    return report


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Round-robin a frame read from fewer files than the session has cores
    (e.g. one single-row-group file), so the files written from it, and every
    later scan of them, run in parallel.  Frames read from many files (the
    normal case at scale) are left as they are.  The test looks at file
    metadata only; it runs no job."""
    target = parallelism(spark)
    return df.repartition(target) if len(df.inputFiles()) < target else df


def silver_from_testdata(spark: SparkSession, sf_dir: str, silver_root: str,
                         workers: int = 1, run: RunContext | None = None) -> StageReport:
    """Land the driver tables as canonical silver (partitioned Parquet)."""
    run = run or RunContext.now()
    frames = testdata.load_silver(spark, sf_dir)
    builders = {name: (lambda df=df: quality.add_ingestion_metadata(spread(df, spark), run.as_of))
                for name, df in frames.items()}
    return write_tables(builders, silver_root,
                        lambda d, path: sinks.write_parquet_partitioned(d, path, rebalance=False), workers)


def read_silver(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    return {name: files.read_parquet(spark, os.path.join(silver_root, name))
            for name in SILVER_DATASETS}


# ------------------------------------------------------------------ gold
def gold(spark: SparkSession, silver_root: str, gold_root: str,
         tables: tuple[str, ...] = GOLD_TABLES, workers: int = 1) -> StageReport:
    """Silver -> star schema, one Parquet table per dimension / fact."""
    g = Gold(read_silver(spark, silver_root))
    return write_tables({name: (lambda n=name: getattr(g, n)) for name in tables}, gold_root,
                        workers=workers)


def read_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    return {name: files.read_parquet(spark, os.path.join(gold_root, name)) for name in GOLD_TABLES}


# ------------------------------------------------------------------ marts
ITEM_ROLLUP = "_valid_item_rollup"
USES_ITEM_ROLLUP = ("metrics_revenue_by_category", "metrics_revenue_by_seller", "metrics_abc")


def marts_from_gold(spark: SparkSession, gold_root: str, silver_root: str,
                    item_rollup_path: str | None = None) -> Marts:
    g = read_gold(spark, gold_root)
    reviews = files.read_parquet(spark, os.path.join(silver_root, "order_reviews"))
    rollup = files.read_parquet(spark, item_rollup_path) if item_rollup_path else None
    return Marts(g["fact_orders"], g["fact_order_items"], reviews, item_rollup=rollup)


def marts(spark: SparkSession, gold_root: str, silver_root: str, marts_root: str,
          names: tuple[str, ...] = Marts.NAMES, workers: int = 1) -> StageReport:
    """Gold -> the twelve metric marts, one Parquet table each.

    The valid-item roll-up that three marts share is written once (one semi
    join and one aggregation over the item fact instead of three).  It runs in
    the first wave together with the marts that do not need it; the three
    that read it follow in a second wave.
    """
    base = marts_from_gold(spark, gold_root, silver_root)
    later = tuple(n for n in names if n in USES_ITEM_ROLLUP)
    first = {n: (lambda n=n: getattr(base, n)) for n in names if n not in USES_ITEM_ROLLUP}
    if later:
        first[ITEM_ROLLUP] = lambda: base.item_rollup
    report = write_tables(first, marts_root, workers=workers)
    report.rows.pop(ITEM_ROLLUP, None)
    if later:
        m = marts_from_gold(spark, gold_root, silver_root, os.path.join(marts_root, ITEM_ROLLUP))
        second = write_tables({n: (lambda n=n: getattr(m, n)) for n in later}, marts_root,
                              workers=workers)
        report.rows.update(second.rows)
        report.seconds.update(second.seconds)
    return report


def read_marts(spark: SparkSession, marts_root: str) -> dict[str, DataFrame]:
    return {name: files.read_parquet(spark, os.path.join(marts_root, name)) for name in Marts.NAMES}


def serving_views(spark: SparkSession, gold_root: str, marts_root: str) -> dict[str, DataFrame]:
    """Register gold tables and marts as views for the read side (D1-D40, ad-hoc SQL)."""
    tables = {**read_gold(spark, gold_root), **read_marts(spark, marts_root)}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def run_all(spark: SparkSession, sf_dir: str, root: str, workers: int = 1,
            run: RunContext | None = None) -> dict[str, StageReport]:
    """Driver tables -> silver -> gold -> marts under ``root``; returns row counts."""
    silver_root, gold_root, marts_root = (os.path.join(root, p) for p in ("silver", "gold", "marts"))
    return {
        "silver": silver_from_testdata(spark, sf_dir, silver_root, workers, run),
        "gold": gold(spark, silver_root, gold_root, workers=workers),
        "marts": marts(spark, gold_root, silver_root, marts_root, workers=workers),
    }


def run_from_raw(spark: SparkSession, raw_files: dict[str, str], root: str,
                 workers: int = 1, bronze_format: str = "parquet",
                 run: RunContext | None = None) -> dict[str, StageReport]:
    """Raw CSV files -> bronze -> silver -> gold -> marts under ``root``.

    ``raw_files`` maps each silver dataset name (``mercato.contracts``) to its
    raw CSV path.  Datasets are independent until gold, so each one's
    bronze + silver chain runs as its own job sequence, ``workers`` at a time.  All
    tables get the ingestion time of one ``RunContext``.
    """
    run = run or RunContext.now()
    bronze_root, silver_root, gold_root, marts_root = (
        os.path.join(root, p) for p in ("bronze", "silver", "gold", "marts"))

    def land(name: str) -> tuple[str, StageReport, StageReport]:
        describe(spark, f"land {name}")
        b = bronze(spark, raw_files[name], os.path.join(bronze_root, name), fmt=bronze_format, run=run)
        s = silver(spark, os.path.join(bronze_root, name), name, os.path.join(silver_root, name),
                   bronze_format=bronze_format, run=run)
        return name, b, s

    if workers <= 1:
        landed = [land(n) for n in raw_files]
    else:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            landed = list(pool.map(land, raw_files))
    report = {"bronze": StageReport(), "silver": StageReport()}
    for name, b, s in landed:
        report["bronze"].rows[name] = b.rows["bronze"]
        report["silver"].rows[name] = s.rows["silver"]
        report["silver"].notes[name] = s.notes
    report["gold"] = gold(spark, silver_root, gold_root, workers=workers)
    report["marts"] = marts(spark, gold_root, silver_root, marts_root, workers=workers)
    return report
