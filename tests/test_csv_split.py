"""CSV files without quoted line breaks are read by many tasks, with the same rows as a multi-line read."""

from __future__ import annotations

import os
import random

import pytest

from mercato.sources import files, sinks


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def multi_line(spark, path, schema=None):
    reader = files._csv_reader(spark, multi_line=True)
    return (reader.schema(schema) if schema else reader).load(path)


def names(paths):
    return sorted(os.path.basename(p) for p in paths)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_large_plain_file_gets_many_tasks(spark, tmp_path, small_splits):
    folder = str(tmp_path / "plain.csv")
    body = "".join(f'{i},"city, {i}","say ""hi""",\n' for i in range(10_000))
    write(folder, "part-0.csv", "a,b,c,d\n" + body)
    df = files.read_csv_raw(spark, folder)
    assert df.rdd.getNumPartitions() >= 10
    assert rows(df) == rows(multi_line(spark, folder))
    assert df.where("b = 'city, 77' and c = 'say \"hi\"' and d is null").count() == 1


def test_quoted_line_breaks_stay_whole(spark, tmp_path, small_splits):
    folder = str(tmp_path / "broken.csv")
    body = "".join(f'{i},"first line\nsecond, line {i}",x\n' for i in range(2000))
    write(folder, "part-0.csv", "a,b,c\n" + body)
    df = files.read_csv_raw(spark, folder)
    assert df.count() == 2000 and df.rdd.getNumPartitions() == 1
    assert df.where("b like 'first line\nsecond, line 1999'").count() == 1


def test_a_folder_with_both_kinds(spark, tmp_path, small_splits):
    folder = str(tmp_path / "both a b+c%20d")
    write(folder, "plain x.csv", "a,b\n" + "".join(f"{i},p{i}\n" for i in range(5000)))
    write(folder, "broken.csv", 'a,b\n1,"x\ny"\n2,z\n')
    path = folder
    plain, others = files.splittable_files(spark, path)
    assert names(others) == ["broken.csv"] and len(plain) == 1
    df = files.read_csv_bronze(spark, path)
    assert df.rdd.getNumPartitions() >= 3
    assert rows(df) == rows(multi_line(spark, path))
    typed = files.read_csv_bronze(spark, path, schema="a int, b string")
    assert dict(typed.dtypes) == {"a": "int", "b": "string"} and typed.count() == 5002


def test_partition_folders_keep_their_column(spark, tmp_path):
    folder = str(tmp_path / "parted")
    write(os.path.join(folder, "day=1"), "a.csv", "a,b\n1,2\n")
    write(os.path.join(folder, "day=2"), "b.csv", 'a,b\n3,"x\ny"\n')
    df = files.read_csv_bronze(spark, folder)
    assert sorted(map(tuple, df.select("a", "b", "day").collect())) == [("1", "2", 1), ("3", "x\ny", 2)]


@pytest.mark.parametrize("line,plain", [
    ("a,b,c", True), ('"a","b,c",""', True), ('"he said ""no""",x', True), ('"""",z', True), ('"""a"""', True),
    ('a"",b', True), ('"a', False), ('x,"', False), ('"",",b', False), ('x"y,"z', False), ('a"b', False),
    ('"a""', False), ('x"",",""', False), (' "a"', False), ('"a" ,b', False), ("", True)])
def test_self_contained_lines(spark, line, plain):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(files.self_contained(df["value"])).first()[0] is plain


def test_files_that_take_the_splittable_way_read_alike(spark, tmp_path):
    """Random lines with quotes, commas, returns and blanks: whatever counts as plain gives the same rows."""
    rng = random.Random(11)
    pieces = ['"', '""', ",", "a", "b c", " ", "\t", "x,y", '"q"', '"q,r"', ',"', '",', "\r"]
    folder = str(tmp_path / "random")
    endings = {}
    for k in range(400):
        ending = rng.choice(["\n", "\n", "\r\n"])
        lines = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 3))]
        endings[k] = ending
        write(os.path.join(folder, f"f={k}"), "x.csv", "h1,h2,h3" + ending + "".join(x + ending for x in lines))
    plain, others = files.splittable_files(spark, folder)
    assert len(plain) > 30 and len(others) > 30
    schema = "h1 string, h2 string, h3 string"
    kept = {int(p.split("f=")[1].split("/")[0]) for p in plain}
    for which in sorted(kept):
        path = os.path.join(folder, f"f={which}")
        one = files._csv_reader(spark, False).schema(schema).load(path)
        assert rows(one) == rows(multi_line(spark, path, schema)), open(os.path.join(path, "x.csv"), newline="").read()


def test_empty_and_header_only(spark, tmp_path, scratch):
    folder = str(tmp_path / "empty.csv")
    write(folder, "a.csv", "a,b\n")
    assert files.read_csv_raw(spark, folder).columns == ["a", "b"]
    assert files.read_csv_raw(spark, folder).count() == 0
    df = spark.range(0).selectExpr("id", "cast(id as string) as s")
    out = scratch("none")
    sinks.write_csv(df, out)
    assert files.read_csv_bronze(spark, out, schema=df.schema).count() == 0
