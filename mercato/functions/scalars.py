"""Scalar expressions shared by the builders.

All helpers return ``Column`` expressions so they stay inside whole-stage
codegen; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coalesce_false(predicate: Column) -> Column:
    """A comparison that is False (not null) when an operand is null."""
    return F.coalesce(predicate, F.lit(False))


def period_label(year: str | Column = "year", month: str | Column = "month") -> Column:
    """``YYYY-MM`` label with a zero-padded month (null when a part is null)."""
    return F.when(_c(year).isNotNull() & _c(month).isNotNull(),
                  F.format_string("%d-%02d", _c(year), _c(month)))


def id_abbreviation(col: str | Column, width: int = 8) -> Column:
    """First ``width`` characters of an id followed by ``...``."""
    return F.concat(F.substring(_c(col).cast("string"), 1, width), F.lit("..."))


def month_index(ts: str | Column) -> Column:
    """Months since year 0 of a timestamp: ``year * 12 + month - 1``.

    Differences of two indexes equal ``months_between`` of the two month
    starts, with integer arithmetic only.
    """
    return F.year(_c(ts)) * 12 + F.month(_c(ts)) - 1


def ratio(num: str | Column, den: str | Column) -> Column:
    """Double division that yields null (not an error) on a zero denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``round(num / den * 100, digits)`` in double arithmetic, null-safe."""
    return F.round(ratio(num, den) * 100, digits)


def as_double_money(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double.

    Money is summed as decimal (exact, order independent); consumers that want
    plain floating values (dashboards, the SQL oracle) get doubles.
    """
    cols = [
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, DecimalType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
