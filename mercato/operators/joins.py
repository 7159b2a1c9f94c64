"""Join helpers.

Physical join choice is left to Catalyst and AQE: a side is broadcast when its
estimated or (with AQE) measured size is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is a sort-merge
join.  AQE splits a skewed partition only when both join inputs are plain
shuffle stages; a lookup side that is itself an aggregate or a dedup window
does not qualify, so ``salted_join`` splits hot keys explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.sources.sinks import to_scratch

SALT = "__salt"
_SALTS = "__salts"


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows (``limit`` stops the scan early), so
    the probe costs the same on a huge table as on a small one.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only when the side is proven small; else leave it to AQE."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


# Rows of one hot key that one salted task should receive.
ROWS_PER_SALT = 2_000_000
MAX_SALTS = 4096
HOT_SAMPLE_FRACTION = 0.01
HOT_TOP = 64


def hot_key_salts(df: DataFrame, columns: list[str], rows_per_salt: int | None = None,
                  sample_fraction: float | None = None, top: int = HOT_TOP,
                  seed: int = 7) -> dict[str, dict]:
    """Per column: hot value -> number of salts, in proportion to its estimated rows.

    One job over a seeded sample of the key columns only: (column, value)
    pairs whose estimated row count exceeds ``rows_per_salt``, the ``top``
    largest of them (a bounded top-k, so the collect is bounded).  A key
    holding a third of the rows always qualifies; keys small enough for one
    task are left alone.  The result becomes literals in the plan, so task
    retries see the same salts.
    """
    rows_per_salt = rows_per_salt or ROWS_PER_SALT
    sample_fraction = sample_fraction or HOT_SAMPLE_FRACTION
    pairs = df.select(*columns).sample(fraction=sample_fraction, seed=seed).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val"))
                            for c in columns])).alias("p")
    ).select("p.col", "p.val").where(F.col("val").isNotNull())
    rows = (pairs.groupBy("col", "val").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > rows_per_salt * sample_fraction)
            .orderBy(F.col("n").desc(), "col", "val").limit(top * len(columns)).collect())
    out: dict[str, dict] = {c: {} for c in columns}
    for r in rows:
        out[r["col"]][r["val"]] = min(MAX_SALTS, -(-int(r["n"] / sample_fraction) // rows_per_salt))
    return out


def hot_key_table(df: DataFrame, columns: list[str], rows_per_salt: int | None = None,
                  sample_fraction: float | None = None, seed: int = 7) -> DataFrame:
    """``col, val, salts``: every hot value of the given columns, as a written table.

    One job over a seeded sample of the key columns; a (column, value) whose estimated rows exceed
    ``rows_per_salt`` is hot, however many there are (at most rows / ``rows_per_salt`` per column, up to the
    sample's error).  Nothing comes to the driver and the plan holds no literal per key; the table is written once,
    so retried tasks and both sides of the join see the same salts.
    """
    rows_per_salt = rows_per_salt or ROWS_PER_SALT
    sample_fraction = sample_fraction or HOT_SAMPLE_FRACTION
    pairs = df.select(*columns).sample(fraction=sample_fraction, seed=seed).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val"))
                            for c in columns])).alias("p")).select("p.*").where(F.col("val").isNotNull())
    counted = pairs.groupBy("col", "val").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.ceil(F.col("n") / F.lit(sample_fraction * rows_per_salt))
    return to_scratch(counted.where(F.col("n") > rows_per_salt * sample_fraction)
                      .select("col", "val", F.least(F.lit(MAX_SALTS), wanted).cast("int").alias("salts")), "hot-keys")


def _salted_by_table(big: DataFrame, lookup: DataFrame, key: str, how: str, hot: DataFrame) -> DataFrame:
    """Both sides take their salts from the table; Spark broadcasts it only if it is measured to be small."""
    salts = hot.where(F.col("col") == key).select(F.col("val").cast(big.schema[key].dataType).alias(key),
                                                  F.col("salts").alias(_SALTS))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    salted_big = (big.join(salts, key, "left")
                  .withColumn(SALT, F.coalesce(F.pmod(row_hash, F.col(_SALTS)), F.lit(0))).drop(_SALTS))
    salted_lookup = (lookup.join(salts, key, "left").withColumn(SALT, F.explode(F.coalesce(
        F.sequence(F.lit(0), F.col(_SALTS) - 1), F.array(F.lit(0)))))
        .withColumn(SALT, F.col(SALT).cast("bigint")).drop(_SALTS))
    return salted_big.join(salted_lookup, [key, SALT], how).drop(SALT)


def salted_join(big: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                salts: dict | DataFrame | None = None) -> DataFrame:
    """``big.join(lookup, key, how)`` with each hot key of ``big`` spread over its own
    number of tasks.

    ``salts`` is the table of hot values of ``hot_key_table`` (made here when not given) or
    a small map of hot key values to salt counts (see ``hot_key_salts``).  Rows of ``big`` with a hot key get a salt from a
    hash of the whole row (deterministic, so a task retried after an executor
    loss reproduces it); the ``lookup`` rows of a hot key are replicated once
    per salt, all other rows keep salt 0.  Every pair of matching rows still
    meets exactly once, so the result equals the plain join for ``inner`` and
    ``left`` joins.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports inner and left joins")
    salts = hot_key_table(big, [key]) if salts is None else salts
    if isinstance(salts, DataFrame):
        if not salts.where(F.col("col") == key).limit(1).count():
            return big.join(lookup, key, how)
        return _salted_by_table(big, lookup, key, how, salts)
    if not salts:
        return big.join(lookup, key, how)
    key_type = big.schema[key].dataType
    n_of_key = F.create_map(*[x for k, n in salts.items()
                              for x in (F.lit(k).cast(key_type), F.lit(n))])[F.col(key)]
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    salted_big = big.withColumn(SALT, F.coalesce(F.pmod(row_hash, n_of_key), F.lit(0)))
    salted_lookup = lookup.withColumn(
        SALT, F.explode(F.coalesce(F.sequence(F.lit(0), n_of_key - 1), F.array(F.lit(0))))
    ).withColumn(SALT, F.col(SALT).cast("bigint"))
    return salted_big.join(salted_lookup, [key, SALT], how).drop(SALT)
