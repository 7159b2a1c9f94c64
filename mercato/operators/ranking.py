"""Global rank and running sum without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to one task.
Here the rows are range-partitioned on the full (total) sort order instead:

1. ``repartitionByRange(n, order)`` - Spark samples the composite key and cuts
   it into ``n`` contiguous ranges; rows that tie on the measure are still
   split by the tie-break column, so no range can hold a hot value alone.
   ``spark_partition_id()`` then *is* the range index.  The result is
   checkpointed so the range assignment is fixed for both uses below and
   survives executor loss (reliable checkpoint in ``spark.checkpoint.dir``).
2. Spark's sampler collects its sample, so ``n`` is bounded.  A range that came out with more
   than ``rows_per_range`` rows is cut again, by splitters taken at equal steps from a hashed sample of
   its own rows (no sample leaves the executors); each row finds its part by comparing itself with
   the at most ``MAX_PARTS - 1`` splitters of its range.  That repeats until every part is small, so the rows that
   a task sorts are bounded by a parameter at every table size.
3. Per part: row count and value sum.  Prefix totals are made level by level: over the parts
   of one range, then over the ranges (at most ``n``), so no window sees more than ``n`` or ``MAX_PARTS`` rows.
4. ``row_number`` / running sum inside each part plus its offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir
from mercato.sources.sinks import to_scratch

_PART, _BUCKET = "__part", "__bucket"
# Upper bound on ranges: Spark's range sampler brings its sample of each to the driver.
MAX_RANGES = 4096
# Parts that a range is cut into at a time, and rows of the sample per part.
MAX_PARTS = 64
SAMPLE_PER_PART = 200
ROWS_PER_RANGE = 2_000_000


def _buckets(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return max(1, min(n_buckets, MAX_RANGES))
    spark = df.sparkSession
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES))


def _not_after(splitter: Column, keys: list[tuple[str, bool]]) -> Column:
    """Whether the row stands at the splitter or behind it in the order of ``keys`` (name, ascending).

    Nulls come first in ascending and last in descending order, as in Spark's sort.
    """
    before, same = F.lit(False), F.lit(True)
    for name, ascending in keys:
        s, row = splitter[name], F.col(f"`{name}`")
        if ascending:
            earlier = (s.isNull() & row.isNotNull()) | F.coalesce(s < row, F.lit(False))
        else:
            earlier = (s.isNotNull() & row.isNull()) | F.coalesce(s > row, F.lit(False))
        before = before | (same & earlier)
        same = same & s.eqNullSafe(row)
    return before | same


def _order(keys: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(f"`{n}`").asc_nulls_first() if up else F.col(f"`{n}`").desc_nulls_last() for n, up in keys]


def _cut(ranged: DataFrame, counts: DataFrame, keys: list[tuple[str, bool]], rows_per_range: int) -> DataFrame:
    """Every bucket above ``rows_per_range`` cut into parts; ``_BUCKET`` stays in the order of the rows."""
    large = counts.filter(F.col("__n") > rows_per_range).select(
        F.col(_BUCKET), F.col("__n"),
        F.least(F.lit(MAX_PARTS), F.ceil(F.col("__n") / rows_per_range) + 1).cast("int").alias("__parts"))
    names = [n for n, _ in keys]
    # a share of the rows by hash: about SAMPLE_PER_PART for each part
    share = F.least(F.lit(1.0), F.col("__parts") * SAMPLE_PER_PART / F.col("__n"))
    uniform = F.pmod(F.xxhash64(F.lit(5), *[F.col(f"`{n}`") for n in names]), F.lit(1 << 30)) / float(1 << 30)
    sample = ranged.join(large, _BUCKET).filter(uniform < share).select(_BUCKET, "__parts", *names).distinct()
    inside = Window.partitionBy(_BUCKET)  # at most a few times MAX_PARTS * SAMPLE_PER_PART rows
    placed = (sample.withColumn("__size", F.count(F.lit(1)).over(inside))
              .withColumn("__at", F.row_number().over(inside.orderBy(*_order(keys)))))
    step = F.floor((F.col("__at") - 1) * F.col("__parts") / F.col("__size"))
    splitters = (placed.withColumn("__step", step).groupBy(_BUCKET, "__step")
                 .agg(F.min_by(F.struct(*names), "__at").alias("__key")).filter("__step > 0")
                 .groupBy(_BUCKET).agg(F.collect_list("__key").alias("__splitters")))
    splitters = to_scratch(splitters, "rank-splitters")
    part = F.when(F.col("__splitters").isNull(), 0).otherwise(
        F.size(F.filter("__splitters", lambda s: _not_after(s, keys))))
    return (ranged.join(splitters, _BUCKET, "left")
            .withColumn(_BUCKET, F.col(_BUCKET) * MAX_PARTS + part).drop("__splitters"))


def _plus(a: Column, b: Column) -> Column:
    """A sum that, like an aggregate, leaves out nulls (null only if both are)."""
    return F.coalesce(a + b, a, b)


def _offsets(counts: DataFrame, levels: int, total_col: str | None) -> DataFrame:
    """Rows and values before every bucket: totals upwards, then prefixes downwards, one level at a time."""
    # level 0 is the finest; a bucket's parent is its number divided by MAX_PARTS
    tables = [counts]
    for _ in range(levels):
        tables.append(tables[-1].groupBy(F.floor(F.col(_BUCKET) / MAX_PARTS).alias(_BUCKET)).agg(
            F.sum("__n").alias("__n"), F.sum("__s").alias("__s")))
    top = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES rows
    known = tables[-1].select(
        _BUCKET, F.coalesce(F.sum("__n").over(top), F.lit(0)).alias("__n_before"), F.sum("__s").over(top).alias("__s_before"),
        *([F.sum("__s").over(Window.partitionBy()).alias(total_col)] if total_col else []))
    for table in reversed(tables[:-1]):
        parent = F.floor(F.col(_BUCKET) / MAX_PARTS)
        siblings = Window.partitionBy(_PART).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        within = table.withColumn(_PART, parent).select(
            _BUCKET, _PART, F.coalesce(F.sum("__n").over(siblings), F.lit(0)).alias("__n_in"),
            F.sum("__s").over(siblings).alias("__s_in"))
        known = within.join(known.withColumnRenamed(_BUCKET, _PART), _PART).select(
            _BUCKET, (F.col("__n_before") + F.col("__n_in")).alias("__n_before"),
            _plus(F.col("__s_before"), F.col("__s_in")).alias("__s_before"), *([total_col] if total_col else []))
    return known


def global_rank_running_sum(
    df: DataFrame,
    order: list[Column],
    value_col: str,
    rank_col: str = "rank",
    running_col: str = "running_sum",
    total_col: str | None = None,
    n_buckets: int | None = None,
    keys: list[tuple[str, bool]] | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1..N in ``order``) and ``running_col`` (sum of
    ``value_col`` over rows 1..rank).  ``order`` must be a total order.
    Optionally adds ``total_col``: the sum of ``value_col`` over all rows.

    ``keys`` tells the same order as (column, ascending) pairs with Spark's default place of nulls;
    with it no task sorts more than about ``rows_per_range`` rows (``ROWS_PER_RANGE``), without it the table is
    cut into at most ``MAX_RANGES`` ranges.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = _buckets(df, n_buckets)
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    ranged = (
        df.repartitionByRange(n, *order)
        .withColumn(_BUCKET, F.spark_partition_id().cast("long"))
        .checkpoint(eager=True)
    )
    sums = (F.count(F.lit(1)).alias("__n"), F.sum(value_col).alias("__s"))
    counts, levels, largest = ranged.groupBy(_BUCKET).agg(*sums), 0, None
    while keys:
        most = counts.agg(F.max("__n")).first()[0] or 0
        if most <= rows_per_range or most == largest:  # equal rows cannot be cut apart
            break
        largest = most
        counts = to_scratch(counts, "rank-counts")
        ranged = to_scratch(_cut(ranged, counts, keys, rows_per_range).repartition(_BUCKET), "rank-parts")
        counts, levels = ranged.groupBy(_BUCKET).agg(*sums), levels + 1
    offsets = _offsets(counts, levels, total_col)
    if not levels:  # one row per range, at most MAX_RANGES
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(_BUCKET).orderBy(*order)
    running_inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(offsets, _BUCKET)
        .withColumn(rank_col, F.row_number().over(inside) + F.col("__n_before"))
        .withColumn(running_col, _plus(F.sum(value_col).over(running_inside), F.col("__s_before")))
        .drop(_BUCKET, "__n_before", "__s_before")
    )
