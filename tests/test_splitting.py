"""Readers that find types, split quoted files, and deal out archive members."""

import csv
import gc
import io
import os
import random
import tracemalloc
import zipfile

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.sources import inference, quoted, readers


@pytest.fixture()
def small_splits(spark):
    """Files in ranges of a few hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rng, long=False):
    parts = ["a", "b,c", "\n", '"', "é", "x y", "\r\n", ";", "'", "\t"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(400 if long else 6)))


def write_csv(path, rows, sep=",", end="\n", encoding="utf-8", header=("k", "v")):
    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter=sep, lineterminator=end)
    if header:
        w.writerow(header)
    w.writerows(rows)
    with open(path, "wb") as fh:
        fh.write(out.getvalue().encode(encoding))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_quoted_newlines_in_split_files(spark, tmp_dir, small_splits, seed, end):
    rng = random.Random(seed)
    wanted = []
    for f in range(3):
        rows = [(f"{f}-{i}", "q" + cell(rng, i % 7 == 0)) for i in range(60)]
        if f == 1:
            rows.append(("huge", '"\n,' * 900))  # spans many ranges
        write_csv(f"{tmp_dir}/{f}.csv", rows, end=end)
        wanted += rows
    df = readers.read_csv_header(spark, tmp_dir, multi_line=True)
    assert df.columns == ["k", "v"]
    assert sorted(map(tuple, df.collect())) == sorted(wanted)
    # One file keeps many tasks busy, and ranges begin inside cells.
    lines = quoted._lines(spark, f"{tmp_dir}/1.csv", None)
    assert lines.rdd.getNumPartitions() > 10
    assert quoted.ranges(spark, f"{tmp_dir}/1.csv").where("inside").count() > 5


def test_quoted_newlines_in_latin1_extracts(spark, tmp_dir, small_splits):
    rows = [(f"{i:03}", 'São "Paulo";\n' * (i % 5) + "é", "") for i in range(80)]
    write_csv(f"{tmp_dir}/x.ESTABELE", rows, ";", encoding="latin-1", header=None)
    got = readers.read_delimited_text(spark, tmp_dir, ["a", "b", "c"], multi_line=True).collect()
    assert sorted(map(tuple, got)) == rows


def test_files_split_in_another_way_are_refused(spark, tmp_dir, small_splits):
    write_csv(f"{tmp_dir}/a.csv", [(str(i), "x\ny") for i in range(200)])
    df = readers.read_csv_header(spark, tmp_dir, multi_line=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    with pytest.raises(PySparkException, match="split in another way"):
        df.select("k").collect()


def test_quoted_edges(spark, tmp_dir, small_splits):
    for name, text in {"empty.csv": "", "head.csv": "k,v\n", "blank.csv": 'k,v\n\n1,"a\n\nb"\n\n2,"""\n"', "one.csv": "k,v\n3,x"}.items():
        with open(f"{tmp_dir}/{name}", "w", newline="") as fh:
            fh.write(text)
    paths = [f"{tmp_dir}/{n}.csv" for n in ("head", "blank", "one")]
    got = readers.read_csv_header(spark, paths, multi_line=True).collect()
    assert sorted(map(tuple, got)) == [("1", "a\n\nb"), ("2", '"\n'), ("3", "x")]
    assert quoted.read_records(spark, f"{tmp_dir}/empty.csv").collect() == []
    with open(f"{tmp_dir}/one.csv", "w") as fh:
        fh.write("v,k\n3,x\n")
    with pytest.raises(PySparkException, match="another header"):
        readers.read_csv_header(spark, paths, multi_line=True).collect()
    with open(f"{tmp_dir}/open.csv", "w") as fh:
        fh.write('k,v\n1,"never\n')
    with pytest.raises(PySparkException, match="never ends"):
        readers.read_csv_header(spark, f"{tmp_dir}/open.csv", multi_line=True)


CELLS = {
    "bigint": ["0", "-5", "9223372036854775807", "", None],
    "boolean": ["true", "FALSE", None],
    "double": ["1.5", "-2", ".5", "1e-7", "NaN", "-Infinity", "999999999999999"],
    "date": ["2020-02-29", "1999-12-31", ""],
    "timestamp": ["2020-02-29 10:11:12", "2020-01-01", "2021-05-06T01:02:03.456"],
}
TEXT = [["007", "12"], ["+5"], ["-0"], ["9223372036854775808"], ["1", "x"], ["true", "1"], ["2020-02-30"], ["1.5", "1234567890123456"],
        ["1e999"], ["e5"], ["-"], ["."], [" 1"], ["1,5"], ["", None], ["00.5"], ["2020-01-01", "5"], ["2020-01-01 25:00:00"], ["1" * 400]]


@pytest.mark.parametrize("kind,cells", [*CELLS.items(), *(("string", c) for c in TEXT)])
def test_inferred_type_of_a_column(spark, kind, cells):
    df = spark.createDataFrame([(c,) for c in cells], "x string").repartition(3)
    found = inference.infer_types(df)
    assert found["x"].dataType.simpleString() == kind
    typed = inference.with_types(df, found)
    assert dict(typed.dtypes)["x"] == kind
    missing = sum(c is None or c == "" for c in cells)
    if kind != "string":
        assert typed.where(F.col("x").isNull()).count() == missing
    else:
        assert sorted(map(repr, (r.x for r in typed.collect()))) == sorted(map(repr, cells))


def test_inference_takes_all_rows_in_one_pass(spark):
    # The only cell that is no number is in the last of many rows.
    n = 50_000
    df = spark.range(n).select(F.when(F.col("id") == n - 1, "007").otherwise(F.col("id").cast("string")).alias("code"),
                               F.col("id").cast("string").alias("odd.name"), "id", F.lit(None).cast("string").alias("none"))
    schema = inference.infer_types(df)
    assert [f.dataType.simpleString() for f in schema.fields] == ["string", "bigint", "bigint", "string"]
    assert inference.infer_types(df, ["code"])["odd.name"].dataType == T.StringType()
    assert inference.infer_types(df.limit(0))["odd.name"].dataType == T.StringType()
    assert inference.infer_types(spark.createDataFrame([("2020-01-01",)], "d string"), dates=False)["d"].dataType == T.StringType()


def test_read_csv_inferred(spark, tmp_dir):
    write_csv(f"{tmp_dir}/a.csv", [("007", "1", 'x\n"y'), ("12", "", "z")], header=("code", "n", "t"))
    df = readers.read_csv_inferred(spark, tmp_dir, multi_line=True)
    assert df.dtypes == [("code", "string"), ("n", "bigint"), ("t", "string")]
    assert sorted(map(tuple, df.collect())) == [("007", 1, 'x\n"y'), ("12", None, "z")]


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_members_of_one_archive_are_dealt_to_tasks(spark, tmp_dir):
    members = {f"m{i}.ESTABELE": "".join(f"{i};{j}\r\n" for j in range(50)) for i in range(8)}
    archive(f"{tmp_dir}/all.zip", {**members, "notes.txt": "no", "folder/": ""})
    df = readers.read_zip_lines(spark, tmp_dir, ".ESTABELE", task_bytes=1)
    assert df.rdd.getNumPartitions() == 8
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("member").alias("n")).collect()
    assert [r.n for r in per_task] == [1] * 8
    got = sorted((r.member, r.line) for r in df.collect())
    assert got == sorted((f"m{i}.ESTABELE", f"{i};{j}") for i in range(8) for j in range(50))
    # Small members share a task.
    assert readers.read_zip_lines(spark, tmp_dir, ".ESTABELE").rdd.getNumPartitions() == 1
    listed = readers.zip_members(spark, tmp_dir).collect()
    assert {r.member for r in listed} == {*members, "notes.txt"} and all(r.size > 0 for r in listed)


def test_a_task_holds_chunks_of_a_member_only(tmp_dir):
    path, chunk = f"{tmp_dir}/a.zip", 1 << 16
    long = [f"{i:07};{'x' * 60}" for i in range(60_000)]
    archive(path, {"long": "\r\n".join(long), "short": "x\n\r" * 100_000})
    read = readers._unzip_members("latin-1", chunk)

    def members(name):
        return read([pd.DataFrame({"members": [[{"archive": path, "member": name}]]})])

    n, off = 0, 0
    gc.collect()
    gc.disable()  # nothing may wait for a collection, which rows alone do not bring about
    tracemalloc.start()
    try:
        for rows in members("long"):
            off += rows["line"].tolist() != long[n:n + len(rows)]
            n += len(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert n == 60_000 and off == 0
    assert peak < sum(map(len, long)) / 4
    # Names repeated beside short lines count as well.
    sizes = [(len(rows), rows["line"].str.len().sum()) for rows in members("short")]
    assert sum(n for n, _ in sizes) == 200_000 and sum(s for _, s in sizes) == 100_000
    assert max(n for n, _ in sizes) * len(path + "short") <= chunk


def test_members_are_dealt_by_size():
    members = [("a", "big", 100), ("a", "x", 30), ("b", "y", 30), ("b", "z", 30), ("b", "none", 0)]
    groups = readers._deal_members(members, 60)
    assert sorted(m for g in groups for m in g) == sorted((a, m) for a, m, _ in members)
    assert groups[0] == [("a", "big")] and len(groups) == 3


def test_archives_without_members(spark, tmp_dir):
    archive(f"{tmp_dir}/a.zip", {"x.txt": "1"})
    assert readers.read_zip_lines(spark, tmp_dir, ".ESTABELE").collect() == []


def test_registry_tables_by_suffix(spark, tmp_dir):
    archive(f"{tmp_dir}/a.zip", {"F.K0.SIMPLES.CSV.D20910": "1;S;20180101;0;N;0;0\n", "F.SOCIOCSV": ";".join("abcdefghijk") + "\n",
                                 "F.PAISCSV": '013;"AFEGANISTÃO"\n'.encode("latin-1")})
    assert readers.read_registry(spark, tmp_dir, "simples").first().opcao_simples == "S"
    assert len(readers.read_registry(spark, tmp_dir, "socios").columns) == 11
    assert tuple(readers.read_registry(spark, tmp_dir, "pais").first()) == ("013", "AFEGANISTÃO")
    assert os.path.exists(f"{tmp_dir}/a.zip")
    with pytest.raises(ValueError):
        readers.read_registry(spark, tmp_dir, "other")
