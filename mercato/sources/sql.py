"""SQL sources (S9): temp views over DataFrames, SQL text, JDBC reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames to ``spark.sql`` under their names (session scoped)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def sql_source(spark: SparkSession, sql: str) -> DataFrame:
    """A SQL string against registered views; the result stays a DataFrame."""
    return spark.sql(sql)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a relational table; with a partition column the read is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()
