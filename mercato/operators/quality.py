"""Data quality, cleansing and contract enforcement (Q1-Q10).

Profiles are single aggregates (one job per table, not one per column) and
guards are ``limit(1)`` probes that stop at the first qualifying row.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.contracts import INGESTION_COLUMNS, RENAMES, SCHEMAS, STRICT


class EmptyDataError(ValueError):
    """A dataset with no rows, or with only null / blank rows."""


class SchemaContractError(ValueError):
    """A dataset misses columns its contract requires."""


# ---------------------------------------------------------------- Q1
def normalize_name(name: str) -> str:
    """lower, strip, runs of non-alphanumerics -> ``_``, trim ``_``."""
    name = re.sub(r"[^a-z0-9]+", "_", name.lower().strip())
    return re.sub(r"_+", "_", name).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column (metadata only, no data movement)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


# ---------------------------------------------------------------- Q2
def add_ingestion_metadata(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Add ``ingestion_date`` and its year and month.

    ``as_of`` is the run's one timestamp (``plans.pipeline.RunContext``), the same for every table and in a
    rerun; an aware datetime is taken in UTC.  Without it the clock at the start of the query counts.
    """
    if as_of is not None and as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    # written as text, so that the driver's own time zone plays no part
    now = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    return df.withColumns({
        "ingestion_date": now,
        "ingestion_year": F.year(now),
        "ingestion_month": F.month(now),
    })


# ---------------------------------------------------------------- Q3
def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop fully identical rows (a partial + final hash aggregate)."""
    return df.dropDuplicates()


# ---------------------------------------------------------------- Q4 / Q10
def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percent per column, from ONE aggregate over the table.

    Output: ``column_name, null_count, total_rows, null_pct`` (one row per
    column, in column order).
    """
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, null_count bigint, total_rows bigint, null_pct double")
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    stacked = counts.select(
        "__total",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column_name"),
                     F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ])).alias("p"),
    )
    return stacked.select(
        F.col("p.column_name").alias("column_name"),
        F.col("p.null_count").alias("null_count"),
        F.col("__total").alias("total_rows"),
        F.round(F.try_divide(F.col("p.null_count").cast("double"), F.col("__total")) * 100, 2)
        .alias("null_pct"),
    )


def optional_columns(dataset: str, df: DataFrame) -> list[str]:
    strict = set(STRICT.get(dataset, []))
    return [f.name for f in SCHEMAS[dataset].fields
            if f.nullable and f.name not in strict and f.name in df.columns]


def optional_null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """Q10: the profile restricted to nullable, non-strict contract columns."""
    return null_profile(df, optional_columns(dataset, df))


# ---------------------------------------------------------------- Q5
def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) == F.lit("")


def all_blank_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """True when every checked column is null or blank.

    Ingestion columns are always filled, so they are left out of the check.
    """
    columns = [c for c in (columns or df.columns) if c not in INGESTION_COLUMNS]
    return reduce(lambda a, b: a & b, [_blank(c) for c in columns])


def emptiness_flags(df: DataFrame) -> DataFrame:
    """One row ``has_rows, has_non_blank_row`` from two ``limit(1)`` probes."""
    any_row = df.limit(1).select(F.lit(1).alias("r"), F.lit(None).cast("int").alias("nb"))
    non_blank = df.where(~all_blank_row(df)).limit(1) \
        .select(F.lit(None).cast("int").alias("r"), F.lit(1).alias("nb"))
    return any_row.unionByName(non_blank).agg(
        (F.count("r") > 0).alias("has_rows"),
        (F.count("nb") > 0).alias("has_non_blank_row"),
    )


def assert_non_empty(df: DataFrame) -> DataFrame:
    """Raise unless the dataset has a row with at least one non-blank value."""
    flags = emptiness_flags(df).first()
    if not flags["has_rows"]:
        raise EmptyDataError("dataset is empty")
    if not flags["has_non_blank_row"]:
        raise EmptyDataError("dataset has only null or blank rows")
    return df


# ---------------------------------------------------------------- Q6 / Q7
def rename_typos(df: DataFrame, dataset: str) -> DataFrame:
    renames = {old: new for old, new in RENAMES.get(dataset, {}).items() if old in df.columns}
    return df.withColumnsRenamed(renames) if renames else df


def schema_contract(df: DataFrame, dataset: str) -> list[str]:
    """Raise on missing contract columns; return the extra ones (kept, warned)."""
    expected = [f.name for f in SCHEMAS[dataset].fields]
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise SchemaContractError(f"{dataset}: missing required columns {missing}")
    return [c for c in df.columns if c not in expected and c not in INGESTION_COLUMNS]


def contract_findings(df: DataFrame, dataset: str) -> DataFrame:
    """Q7 as rows: every contract column and every extra one, with what one pass over the table finds.

    ``column_name, expected_type, found_type, finding, total_rows, null_rows, failed_casts``.  A finding is
    ``missing`` (its counts are null), ``extra`` (kept; ingestion columns are exempt), ``uncastable`` (some value is no
    value of the expected type), ``null in required`` (a null in a strict or non-nullable column), ``other type`` (castable)
    or ``ok``; the first that holds.  All counts come from a single aggregate with partial sums per task.
    """
    fields = {f.name: f for f in SCHEMAS[dataset].fields}
    found = {f.name: f.dataType for f in df.schema.fields}
    strict = set(STRICT.get(dataset, []))
    names = [*fields, *(c for c in df.columns if c not in fields and c not in INGESTION_COLUMNS)]
    counts = [F.count(F.lit(1)).alias("__total")]
    for i, name in enumerate(names):
        if name in found:
            col = F.col(f"`{name}`")
            counts.append(F.count_if(col.isNull()).alias(f"n{i}"))
            bad = col.isNotNull() & col.try_cast(fields[name].dataType).isNull() if name in fields else F.lit(False)
            counts.append(F.count_if(bad).alias(f"b{i}"))
    rows = []
    for i, name in enumerate(names):
        expected = fields[name].dataType if name in fields else None
        if name not in found:
            finding, nulls, bad = F.lit("missing"), F.lit(None).cast("long"), F.lit(None).cast("long")
        else:
            nulls, bad = F.col(f"n{i}"), F.col(f"b{i}")
            required = name in strict or (name in fields and not fields[name].nullable)
            finding = (F.when(F.lit(expected is None), "extra").when(bad > 0, "uncastable")
                       .when(F.lit(required) & (nulls > 0), "null in required")
                       .when(F.lit(found[name] != expected), "other type").otherwise("ok"))
        rows.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(expected.simpleString() if expected is not None else None).cast("string").alias("expected_type"),
            F.lit(found[name].simpleString() if name in found else None).cast("string").alias("found_type"),
            finding.alias("finding"), F.col("__total").alias("total_rows"), nulls.alias("null_rows"),
            bad.alias("failed_casts")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- Q8 / Q9
def cast_to_contract(df: DataFrame, dataset: str) -> DataFrame:
    """One projection casting each contract column; unparsable text becomes null.

    ``try_cast`` keeps the lenient meaning under ANSI mode: a bad value is
    nulled here and then removed by ``drop_strict_nulls`` if the column is strict.
    """
    types = {f.name: f.dataType for f in SCHEMAS[dataset].fields}
    return df.select(*[
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in df.columns
    ])


def drop_strict_nulls(df: DataFrame, dataset: str) -> DataFrame:
    strict = [c for c in STRICT.get(dataset, []) if c in df.columns]
    return df.na.drop(how="any", subset=strict) if strict else df
