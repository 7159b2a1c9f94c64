"""Sinks (S5-S8), write verification (S10), row-count probes (S11), scoped persist.

Counts are taken with ``Observation`` while the write runs, so logging a row
count costs no extra job.
"""

from __future__ import annotations

import contextlib
import os
import uuid
from typing import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from mercato.session import ensure_checkpoint_dir

PARTITION_COLUMNS = ("ingestion_year", "ingestion_month")


class WriteVerificationError(RuntimeError):
    """Rows read back differ from rows written."""


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a local temp dir
    on a cluster: ``spark.checkpoint.dir`` names storage every executor sees)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "mercato-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def to_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint directory and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite CSV with a header; quotes are escaped by doubling."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "false")
     # blanks at the ends of a value are part of it
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_parquet_partitioned(df: DataFrame, path: str,
                              partition_by: tuple[str, ...] = PARTITION_COLUMNS, rebalance: bool = True) -> None:
    """Snappy Parquet partitioned by ingestion year/month.

    Without redistribution every task writes a file into every partition folder it holds rows of.
    The ``REBALANCE`` hint shuffles by the partition columns first, and AQE then merges small partitions and
    splits hot ones to the advisory size: files are few and none holds a hot partition alone.
    Pass ``rebalance=False`` where the columns have one value (an ingestion run), as each
    task then writes one file anyway.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    (df.write.mode("overwrite").option("compression", "snappy")
     .partitionBy(*partition_by).parquet(path))


def write_parquet(df: DataFrame, path: str) -> None:
    """Snappy Parquet."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               batchsize: int = 10_000, num_partitions: int | None = None) -> dict[str, int]:
    """Replace the rows of a relational table, all or nothing.

    The rows go to a staging table first (``num_partitions`` caps the connections; a task that is run again after
    a lost executor may write rows twice there, as over any plain connection), where they are counted against
    the rows that the plan gave.  Only then one transaction empties the target, copies the staging
    table into it and commits, so readers see the old rows or the new ones, a failure leaves the old ones,
    and the target keeps its own column types, keys and grants.  A target that is missing is made first, empty.
    """
    properties = properties or {}
    staging = f"{table}_STAGING_{uuid.uuid4().hex[:8]}".upper()

    def save(frame: DataFrame, name: str, mode: str) -> None:
        writer = (frame.write.format("jdbc").option("url", url).option("dbtable", name)
                  .option("batchsize", str(batchsize)).mode(mode))
        for key, value in properties.items():
            writer = writer.option(key, value)
        writer.save()

    spark = df.sparkSession
    counted, obs = observed(df.coalesce(num_partitions) if num_partitions else df, "jdbc")
    try:
        save(counted, staging, "errorifexists")
        expected = int(obs.get["rows"])
        with _jdbc_connection(spark, url, properties) as connection:
            written = _jdbc_count(connection, staging)
            if written != expected:
                raise WriteVerificationError(f"expected {expected} rows, {written} in the staging table")
            exists = _jdbc_exists(connection, table)
        if not exists:
            save(df.limit(0), table, "append")
        with _jdbc_connection(spark, url, properties) as connection:
            into, given = _jdbc_columns(connection, table), _jdbc_columns(connection, staging)
            unknown = sorted(set(given) - set(into))
            if unknown:
                raise WriteVerificationError(f"{table} has no columns {unknown}")
            _jdbc_run(connection, f"DELETE FROM {table}",
                      f"INSERT INTO {table} ({', '.join(into[c] for c in given)}) "
                      f"SELECT {', '.join(given.values())} FROM {staging}")
            written = _jdbc_count(connection, table)
            if written != expected:
                connection.rollback()
                raise WriteVerificationError(f"expected {expected} rows, {written} in {table}")
            connection.commit()
    finally:
        with _jdbc_connection(spark, url, properties) as connection:
            if _jdbc_exists(connection, staging):
                _jdbc_run(connection, f"DROP TABLE {staging}")
                connection.commit()
    return {"expected_rows": expected, "written_rows": written}


@contextlib.contextmanager
def _jdbc_connection(spark: SparkSession, url: str, properties: dict[str, str]):
    """A connection of the driver's JVM in a transaction of its own, rolled back unless committed."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for key, value in properties.items():
        info.setProperty(key, value)
    if "driver" in properties:  # as Spark does it: through the class loader that knows the session's jars
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        connection = loader.loadClass(properties["driver"]).newInstance().connect(url, info)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.setAutoCommit(False)
        yield connection
    finally:
        connection.rollback()
        connection.close()


def _jdbc_run(connection, *statements: str) -> None:
    statement = connection.createStatement()
    try:
        for sql in statements:
            statement.executeUpdate(sql)
    finally:
        statement.close()


def _jdbc_count(connection, table: str) -> int:
    statement = connection.createStatement()
    try:
        rows = statement.executeQuery(f"SELECT COUNT(*) FROM {table}")
        rows.next()
        return int(rows.getLong(1))
    finally:
        statement.close()


def _jdbc_columns(connection, table: str) -> dict[str, str]:
    """Lower-case name -> name as the database knows it, quoted."""
    statement = connection.createStatement()
    try:
        found = statement.executeQuery(f"SELECT * FROM {table} WHERE 1 = 0").getMetaData()
        quote = connection.getMetaData().getIdentifierQuoteString().strip()
        names = [found.getColumnName(i + 1) for i in range(found.getColumnCount())]
        return {n.lower(): f"{quote}{n}{quote}" for n in names}
    finally:
        statement.close()


def _jdbc_exists(connection, table: str) -> bool:
    schema, _, name = table.rpartition(".")
    for wanted in {name, name.upper(), name.lower()}:
        found = connection.getMetaData().getTables(None, schema or None, wanted, None)
        try:
            if found.next():
                return True
        finally:
            found.close()
    return False


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter; it is filled by the next action on the result."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# Two seeds: 128 bits per row, so that no two rows stand for each other by chance.
_DIGESTS = {"digest_a": 41, "digest_b": 43}


def row_digests(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates that depend on the multiset of rows only, not on order or partitions.

    A sum of row hashes (exact, as decimal): an altered, swapped, lost or repeated row changes it.  Every value goes in
    as text with its place, so a null differs from an empty text and a value from the same value in another column.
    """
    def text(c: str) -> Column:
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (ArrayType, MapType, StructType)):
            return F.to_json(F.struct(value))
        return value.cast("string")

    cells = [F.coalesce(F.concat(F.lit("="), text(c)), F.lit("null")) for c in columns]
    return [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(name)
            for name, seed in _DIGESTS.items()]


def _as_written(back: DataFrame, column: str, written: DataType) -> Column:
    value, found = F.col(f"`{column}`"), back.schema[column].dataType
    nested = isinstance(written, (ArrayType, MapType, StructType))  # only formats that know types hold these
    return value if found == written or nested else value.try_cast(written).alias(column)


def write_verified(df: DataFrame, write: Callable[[DataFrame], None], read_back: Callable[[], DataFrame],
                   digest: bool = True, unchecked: tuple[str, ...] = ("ingestion_date",)) -> dict[str, int | str]:
    """Write while counting and digesting, read back, compare; raise on a mismatch.

    Counts and digests of the written rows come from an ``Observation`` of the write itself; only the read-back is
    a further pass.  Text formats give back text: those values are cast to the written types before they are compared.
    ``unchecked`` columns are left out of the digest (a CSV keeps milliseconds of a timestamp only).
    """
    columns = [c for c in df.columns if c not in unchecked] if digest else []
    obs = Observation("write")
    sums = row_digests(df, columns) if columns else []
    write(df.observe(obs, F.count(F.lit(1)).alias("rows"), *sums))
    expected = obs.get
    back = read_back()
    if columns:
        missing = [c for c in columns if c not in back.columns]
        if missing:
            raise WriteVerificationError(f"columns {missing} are not there when read back")
        back = back.select(*[_as_written(back, c, df.schema[c].dataType) for c in columns])
        written = back.agg(F.count(F.lit(1)).alias("rows"), *row_digests(back, columns)).first().asDict()
    else:
        written = {"rows": back.count()}
    if written["rows"] != expected["rows"]:
        raise WriteVerificationError(f"expected {expected['rows']} rows, read back {written['rows']}")
    for name in _DIGESTS if columns else ():
        if written[name] != expected[name]:
            raise WriteVerificationError(f"{written['rows']} rows read back, but not those written ({name} differs)")
    result: dict[str, int | str] = {"expected_rows": int(expected["rows"]), "written_rows": int(written["rows"])}
    return result


@contextlib.contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist a DataFrame for a block and unpersist the *same* object after."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
