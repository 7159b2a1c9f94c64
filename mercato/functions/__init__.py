"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side)."""

from mercato.functions.scalars import (  # noqa: F401
    as_double_money,
    coalesce_false,
    id_abbreviation,
    month_index,
    pct,
    period_label,
    ratio,
)
