"""File sources: CSV (raw, bronze) and Parquet (silver, gold) scans.

A CSV file may hold line breaks inside quoted fields.  Reading it with ``multiLine`` is always
right, but makes the whole file one task, whatever its size.  So the scans first look
at every line (one splittable text scan, ``line_profile``): a file in which every
quoted field ends on its own line holds no such line break and is read splittable, line by
line; only the others are read as multi-line files.  Both readers give the same rows for the files that take the
splittable way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class UnsupportedFormatError(ValueError):
    """The raw layer only accepts CSV input."""


def _csv_reader(spark: SparkSession, multi_line: bool):
    # multiLine keeps quoted line breaks inside one record; escape='"' reads
    # doubled quotes ("") as a literal quote instead of ending the field.
    return (
        spark.read.format("csv")
        .option("header", "true")
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )


def self_contained(line: Column) -> Column:
    """Whether no quoted field can run on past the end of this line.

    Doubled quotes are taken out, then every field that is quoted as a whole;
    a quote that is left over may open a field that goes on, so such a line
    (also a sloppy one that would do no harm) does not count.
    """
    no_doubled = F.replace(line, F.lit('""'), F.lit(""))
    no_quoted = F.regexp_replace(no_doubled, '(^|,)"[^"]*"(?=,|$)', "$1")
    return ~F.contains(no_quoted, F.lit('"'))


def line_profile(spark: SparkSession, path: str) -> DataFrame:
    """``file, lines, open_lines, returns, inner_returns, blank_lines``: one row per file.

    One splittable scan of the text with partial sums per task.  ``open_lines`` may hold a field that goes on,
    ``returns`` end in a carriage return, ``inner_returns`` hold one elsewhere, ``blank_lines`` hold
    only blanks (the two CSV readers disagree on these two).
    """
    lines = spark.read.format("text").option("lineSep", "\n").load(path)
    line = F.regexp_replace("value", r"\r$", "")
    return lines.select(F.col("_metadata.file_path").alias("file"), line.alias("line"), F.col("value")).groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~self_contained(F.col("line"))).alias("open_lines"),
        F.count_if(F.endswith("value", F.lit("\r"))).alias("returns"),
        F.count_if(F.contains("line", F.lit("\r"))).alias("inner_returns"),
        F.count_if((F.length("line") > 0) & (F.trim(F.regexp_replace("line", r"\s", " ")) == "")).alias("blank_lines"))


def splittable_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Paths of the files of ``path`` that line-wise reading gets right, and of the others.

    Collects one row per file (what Spark's own file listing holds as well).
    """
    profile = line_profile(spark, path)
    one_ending = (F.col("returns") == 0) | (F.col("returns") == F.col("lines"))
    plain = (F.col("open_lines") == 0) & (F.col("inner_returns") == 0) & (F.col("blank_lines") == 0) & one_ending
    rows = profile.select("file", plain.alias("plain")).orderBy("file").collect()
    return ([_as_path(spark, r["file"]) for r in rows if r["plain"]],
            [_as_path(spark, r["file"]) for r in rows if not r["plain"]])


def _as_path(spark: SparkSession, uri: str) -> str:
    """A file's URI as a path that the reader takes literally."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _read_csv(spark: SparkSession, path: str, schema: StructType | None, infer_schema: bool) -> DataFrame:
    plain, others = splittable_files(spark, path)
    if not plain or not others:
        reader = _csv_reader(spark, multi_line=bool(others) or not plain)
        if schema is not None:
            reader = reader.schema(schema)
        elif infer_schema:
            reader = reader.option("inferSchema", "true")
        return reader.load(path)
    if schema is None:  # both parts need the same columns, those of the whole path
        reader = _csv_reader(spark, multi_line=True)
        schema = (reader.option("inferSchema", "true") if infer_schema else reader).load(path).schema
    parts = [_csv_reader(spark, multi_line).schema(schema).option("basePath", path).load(some)
             for some, multi_line in ((plain, False), (others, True))]
    return parts[0].unionByName(parts[1])


def read_csv_raw(spark: SparkSession, path: str, schema: StructType | None = None,
                 infer_schema: bool = False) -> DataFrame:
    """Header CSV with a given schema, inferred types, or all strings.

    A path whose extension is not ``.csv`` is rejected before any read.
    Inference costs a full extra pass over the input; at scale pass a schema
    or read strings and ``try_cast`` against the contract.
    """
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if ext != "csv":
        raise UnsupportedFormatError(f"raw input must be CSV, got '{ext or path}'")
    return _read_csv(spark, path, schema, infer_schema)


def read_csv_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The bronze CSV directory, all strings unless a schema is given."""
    return _read_csv(spark, path, schema, infer_schema=False)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; filters and projections are pushed into the scan."""
    return spark.read.parquet(path)
