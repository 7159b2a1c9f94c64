"""Exact quantiles per group without sorting.

``percentile_approx`` is exact only while its sketch holds a group's values;
``percentile`` holds all distinct values of a group in one task.  Here the value
at a rank is found by range counting: every pass cuts the range that a group's
wanted value must lie in into ``buckets`` equal parts, counts the group's values per
part (a hash aggregate with map-side partial sums, so a group that holds a third of all
rows is combined before the shuffle) and keeps the part in which the rank falls.
A range of r distinct steps takes ceil(log r / log buckets) passes: three for money up to
10 million in steps of a cent.  No task ever holds more of a group than ``buckets`` counts per quantile.

The values are whole numbers or decimals; a quantile q is the value at rank
ceil(q * n), at least 1, of a group's n non-null values in ascending order
(what ``percentile_approx`` estimates).  A group without values has null quantiles; null
group keys are groups of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

from mercato.sources.sinks import to_scratch

BUCKETS = 1024
_WIDE = "decimal(20,0)"  # differences of two longs


def _steps(value_type: DataType) -> int:
    if isinstance(value_type, IntegralType):
        return 0
    if isinstance(value_type, DecimalType):
        return value_type.scale
    raise TypeError(f"exact quantiles take whole numbers and decimals, not {value_type.simpleString()}")


def _same_group(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns], F.lit(True))


def exact_group_quantiles(df: DataFrame, groups: list[str], value_col: str, quantiles: dict[str, float],
                          buckets: int = BUCKETS) -> DataFrame:
    """``groups`` and one column per entry of ``quantiles`` (name -> share between 0 and 1)."""
    if buckets < 2:
        raise ValueError("at least two buckets are needed to narrow a range")
    value_type = df.schema[value_col].dataType
    scale = _steps(value_type)
    unit = F.lit(1).cast("decimal(38,0)") if not scale else F.lit("0." + "0" * (scale - 1) + "1").cast(
        DecimalType(scale + 1, scale))
    # a value as its number of steps; one that does not fit 64 bits is an error, not a wrong rank
    df = df.select(*groups, value_col).withColumnRenamed(value_col, "__value")
    keys = df.withColumn("__unit", unit).withColumn("__key", F.expr("`__value` div `__unit`")).select(*groups, "__key")
    keys = to_scratch(keys, "quantile-keys")
    found = keys.groupBy(*groups).agg(F.count("__key").alias("__n"), F.min("__key").alias("__low"),
                                      F.max("__key").alias("__high"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q"))
                                 for name, q in quantiles.items()]))
    state = to_scratch(found.withColumn("__w", wanted).select(
        *groups, F.col("__w.name").alias("__name"), "__low", "__high",
        F.greatest(F.lit(1), F.ceil(F.col("__w.q") * F.col("__n"))).cast("long").alias("__rank")), "quantile-ranges")
    while state.filter(F.col("__high") > F.col("__low")).limit(1).count():
        state = to_scratch(_narrowed(keys, state, groups, buckets), "quantile-ranges")

    value = (F.col("__low").cast("decimal(38,0)") * unit).cast(value_type)
    per_name = [F.max(F.when(F.col("__name") == name, value)).alias(name) for name in quantiles]
    return state.groupBy(*groups).agg(*per_name)


def _narrowed(keys: DataFrame, state: DataFrame, groups: list[str], buckets: int) -> DataFrame:
    """Each range that still holds several values cut down to the part that holds the rank."""
    low, high = F.col("__low").cast(_WIDE), F.col("__high").cast(_WIDE)
    size = high - low + 1
    state = state.withColumn("__width", F.ceil(size / F.lit(buckets)).cast(_WIDE))
    wide = state.filter(F.col("__high") > F.col("__low"))
    inside = keys.join(wide, _same_group(keys, wide, groups) & keys["__key"].between(wide["__low"], wide["__high"]))
    part = F.expr(f"(cast(`__key` as {_WIDE}) - cast(`__low` as {_WIDE})) div `__width`")
    own = [wide[c] for c in groups]
    counts = (inside.select(*own, "__name", "__low", "__high", "__rank", "__width", part.alias("__part"))
              .groupBy(*groups, "__name", "__low", "__high", "__rank", "__width", "__part")
              .agg(F.count(F.lit(1)).alias("__n")))
    # at most ``buckets`` rows per group and quantile
    so_far = Window.partitionBy(*groups, "__name").orderBy("__part")
    upto = counts.withColumn("__upto", F.sum("__n").over(so_far)).filter(
        (F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__n") < F.col("__rank")))
    start = low + F.col("__part").cast(_WIDE) * F.col("__width")
    cut = upto.select(
        *groups, "__name", start.cast("long").alias("__low"),
        F.least(start + F.col("__width") - 1, high).cast("long").alias("__high"),
        (F.col("__rank") - (F.col("__upto") - F.col("__n"))).alias("__rank"))
    # ranges of one value, and groups without values, stay as they are
    done = state.filter(~F.coalesce(F.col("__high") > F.col("__low"), F.lit(False))).drop("__width")
    return done.unionByName(cut)
