"""Readers, writers and the streaming load, on files written by the tests."""

import io
import os
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabwise.schemas import ESTABLISHMENT_COLUMNS
from tabwise.sources import readers, writers
from tabwise.streaming import stream_append_load

COLS = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome", "complemento", "bairro", "cidade"]
RAW = ('12345678;0001;95;"ACME ""SUL"" LTDA";;"";São José\n'
       '00000191;0002;10;BETA;x;y;Manaus\n')


def test_delimited_latin1_quotes_blanks(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "K3241.ESTABELE"), "wb") as fh:
        fh.write(RAW.encode("latin-1"))
    with open(os.path.join(tmp_dir, "other.txt"), "wb") as fh:
        fh.write(b"ignored;row\n")
    df = readers.read_delimited_text(spark, tmp_dir, COLS, glob="*.ESTABELE")
    rows = sorted(tuple(r) for r in df.collect())
    assert rows[0] == ("00000191", "0002", "10", "BETA", "x", "y", "Manaus")
    assert rows[1] == ("12345678", "0001", "95", 'ACME "SUL" LTDA', "", "", "São José")
    key = df.select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("k"))
    assert sorted(r.k for r in key.collect()) == ["00000191000210", "12345678000195"]


def test_zip_lines_then_parse(spark, tmp_dir):
    with zipfile.ZipFile(os.path.join(tmp_dir, "a.zip"), "w") as zf:
        zf.writestr("K1.ESTABELE", RAW.encode("latin-1"))
        zf.writestr("README.txt", b"not data\n")
    with zipfile.ZipFile(os.path.join(tmp_dir, "b.zip"), "w") as zf:
        zf.writestr("K2.ESTABELE", "99999999;0001;01;G;;;Rio\n".encode("latin-1"))
    lines = readers.read_zip_lines(spark, tmp_dir, member_suffix=".ESTABELE")
    assert lines.count() == 3
    parsed = readers.parse_delimited_lines(lines, "line", COLS)
    got = {r.cnpj_basico: r for r in parsed.collect()}
    assert got["12345678"].nome == 'ACME "SUL" LTDA' and got["12345678"].complemento == ""
    assert got["12345678"].cidade == "São José"
    assert got["99999999"].cidade == "Rio"


def test_code_table_and_layout_constants(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "F.K03200$Z.D21111.CNAECSV"), "wb") as fh:
        fh.write('"0111301";"Cultivo de arroz"\n"6190601";"Provedores de acesso"\n'.encode("latin-1"))
    codes = readers.read_code_table(spark, tmp_dir, glob="*.CNAECSV")
    assert sorted(tuple(r) for r in codes.collect())[1] == ("6190601", "Provedores de acesso")
    assert len(ESTABLISHMENT_COLUMNS) == 30


def test_csv_header_keeps_key_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empresas.csv")
    with open(path, "w") as fh:
        fh.write("cnpj,razao_social,uf\n00191000000100,\"BANCO \"\"X\"\"\",DF\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["cnpj", "razao_social", "uf"]])
    row = readers.read_csv_header(spark, path, schema).first()
    assert row.cnpj == "00191000000100" and row.razao_social == 'BANCO "X"'


def test_json_sources(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ind.json")
    with open(path, "w") as fh:
        fh.write('[{"NC": "1", "V": "10.5"},\n {"NC": "2", "V": "11.0"}]')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("NC", T.StringType()), T.StructField("V", T.StringType())])
    assert readers.read_json_array(spark, path, schema).count() == 2
    rates = spark.createDataFrame([('{"USDBRL": {"bid": "5.1"}, "EURBRL": {"bid": "5.5"}}',)], "j string")
    rows = readers.json_map_rows(rates, "j", "struct<bid:string>", key_name="pair").collect()
    assert sorted((r.pair, r.value.bid) for r in rows) == [("EURBRL", "5.5"), ("USDBRL", "5.1")]
    arr = spark.createDataFrame([(1, '[{"a": 1}, {"a": 2}]')], "id int, j string")
    assert [r.a for r in readers.json_array_rows(arr, "j", "a int", keep=["id"]).collect()] == [1, 2]


def test_labelled_files(spark, tmp_dir):
    for label, names in {"EOSINOPHIL": ["1", "2"], "NEUTROPHIL": ["3"]}.items():
        os.makedirs(os.path.join(tmp_dir, "TRAIN", label))
        for n in names:
            with open(os.path.join(tmp_dir, "TRAIN", label, n + ".jpeg"), "wb") as fh:
                fh.write(b"\xff\xd8" + n.encode())
    df = readers.read_labelled_files(spark, os.path.join(tmp_dir, "TRAIN"), glob="*.jpeg")
    got = sorted((r.file_name, r.label, len(r.content)) for r in df.collect())
    assert got == [("1.jpeg", "EOSINOPHIL", 3), ("2.jpeg", "EOSINOPHIL", 3), ("3.jpeg", "NEUTROPHIL", 3)]


def test_writers(spark, tmp_dir):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    g = os.path.join(tmp_dir, "guard")
    writers.guarded_write(df, g)
    with pytest.raises(AnalysisException):
        writers.guarded_write(df, g)
    a = os.path.join(tmp_dir, "append")
    writers.append_load(df, a)
    writers.append_load(df, a)
    assert spark.read.parquet(a).count() == 6
    z = os.path.join(tmp_dir, "zstd")
    writers.compressed_write(df, z, "zstd")
    assert any("zstd" in f for f in os.listdir(z))
    s = os.path.join(tmp_dir, "sheet")
    writers.export_sheet(df, s, ["k"], single_file=True)
    text = "".join(open(os.path.join(s, f)).read() for f in sorted(os.listdir(s)) if f.endswith(".csv"))
    assert text.splitlines() == ["index,k,v", "0,1,a", "1,2,b", "2,3,c"]
    meta = writers.dataset_metadata(df, "21/11/2022").collect()
    assert sorted(tuple(r) for r in meta) == [("CNPJ", "21/11/2022"), ("cnpj_qtde", "3")]


def test_clustered_write_prunes(spark, tmp_dir):
    df = spark.range(0, 2000).select(F.col("id").alias("key"),
                                     (F.col("id") % 4).cast("int").alias("uf"))
    path = os.path.join(tmp_dir, "clustered")
    writers.clustered_write(df, path, "key", partition_by=["uf"], num_partitions=4)
    assert sorted(f for f in os.listdir(path) if f.startswith("uf=")) == [
        "uf=0", "uf=1", "uf=2", "uf=3"]
    q = spark.read.parquet(path).where((F.col("uf") == 1) & (F.col("key") == 101))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf" in plan and "EqualTo(key,101)" in plan
    assert q.count() == 1


def test_stream_append_load_is_incremental(spark, tmp_dir):
    src, target, ckpt = (os.path.join(tmp_dir, p) for p in ("landing", "table", "ckpt"))
    os.makedirs(src)
    cols = ["a", "b"]
    with open(os.path.join(src, "f1.csv"), "w") as fh:
        fh.write("1;x\n2;\n")
    stream_append_load(spark, src, cols, target, ckpt, glob="*.csv")
    assert spark.read.parquet(target).count() == 2
    with open(os.path.join(src, "f2.csv"), "w") as fh:
        fh.write("3;z\n")
    stream_append_load(spark, src, cols, target, ckpt, glob="*.csv")
    rows = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert rows == [("1", "x"), ("2", ""), ("3", "z")]  # f1 not loaded twice, blank kept


def test_preview_is_bounded(spark):
    pdf = writers.preview(spark.range(1000), 5)
    assert len(pdf) == 5


RAGGED = "a;b;c\n\na;b\na;b;c;d\n\"x;y\";;z\n"


def test_ragged_rows_follow_one_rule_in_files_archives_and_streams(spark, tmp_dir):
    files, archives = os.path.join(tmp_dir, "files"), os.path.join(tmp_dir, "archives")
    os.makedirs(files)
    os.makedirs(archives)
    with open(os.path.join(files, "f.csv"), "w") as fh:
        fh.write(RAGGED)
    with zipfile.ZipFile(os.path.join(archives, "a.zip"), "w") as zf:
        zf.writestr("f.csv", RAGGED)
    cols = ["p", "q", "r"]
    lines = readers.read_zip_lines(spark, archives)
    for keep, fail in (
            (readers.read_delimited_text(spark, files, cols, ragged="keep"), readers.read_delimited_text(spark, files, cols)),
            (readers.parse_delimited_lines(lines, "line", cols, ragged="keep"), readers.parse_delimited_lines(lines, "line", cols))):
        rows = keep.collect()
        assert sorted(r.rejected for r in rows if r.rejected) == ["a;b", "a;b;c;d"]
        assert sorted((r.p, r.q, r.r) for r in rows if not r.rejected) == [("a", "b", "c"), ("x;y", "", "z")]
        assert keep.where(F.col("rejected").isNotNull()).select("rejected").count() == 2
        for action in (fail.count, fail.collect):
            with pytest.raises(Exception, match="too few or too many cells"):
                action()
    target = os.path.join(tmp_dir, "target")
    stream_append_load(spark, files, cols, target, os.path.join(tmp_dir, "ckpt"), ragged="keep")
    assert spark.read.parquet(target).where("rejected is not null").count() == 2


def test_quoted_newlines_in_a_file(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "f.csv"), "w") as fh:
        fh.write('a;"two\nlines"\nb;c\n')
    got = readers.read_delimited_text(spark, tmp_dir, ["k", "v"], multi_line=True).collect()
    assert sorted(map(tuple, got)) == [("a", "two\nlines"), ("b", "c")]


def test_header_csv_is_bound_by_name(spark, tmp_dir):
    from pyspark.sql import types as T
    path = os.path.join(tmp_dir, "e.csv")
    with open(path, "w") as fh:
        fh.write("uf,extra,cnpj\nAM,7,00000000000001\n")
    schema = T.StructType([T.StructField("cnpj", T.StringType()), T.StructField("uf", T.StringType())])
    assert [tuple(r) for r in readers.read_csv_header(spark, path, schema).collect()] == [("00000000000001", "AM")]
    with pytest.raises(ValueError, match="nome"):
        readers.read_csv_header(spark, path, schema.add("nome", T.StringType()))


def test_export_brings_cells_back(spark, tmp_dir):
    from pyspark.sql import types as T
    cells = ["  pad ", "", None, "two\nlines", 'quo"te', "a,b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "k int, v string")
    path = writers.export_sheet(df, os.path.join(tmp_dir, "sheet"), ["k"])
    schema = T.StructType([T.StructField("index", T.LongType()), *df.schema.fields])
    got = sorted(map(tuple, readers.read_csv_header(spark, path, schema, multi_line=True).collect()))
    assert got == [(i, i, c) for i, c in enumerate(cells)]


def test_clustered_write_splits_a_hot_key(spark, tmp_dir):
    df = spark.range(0, 20_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    path = writers.clustered_write(df, os.path.join(tmp_dir, "t"), "k", num_partitions=8)
    table = spark.read.parquet(path)
    per_file = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 20_000 and max(per_file) < 5_000
    plan = table.where("k = '77'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,77)" in plan


def test_json_map_keeps_documents_without_entries(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, None), (3, "{bad"), (4, "{}")], "id int, j string")
    rows = readers.json_map_rows(df, "j", "int", keep=["id"]).collect()
    assert sorted((r.id, r.key, r.value) for r in rows) == [(1, "a", 1), (2, None, None), (3, None, None), (4, None, None)]


def test_archives_are_opened_by_path(spark, tmp_dir):
    with zipfile.ZipFile(os.path.join(tmp_dir, "a b.zip"), "w") as zf:
        zf.writestr("m", "x\n")
    lines = readers.read_zip_lines(spark, tmp_dir)
    assert "content" not in lines._jdf.queryExecution().executedPlan().toString()
    assert [r.line for r in lines.collect()] == ["x"]


def test_scratch_is_a_fresh_place_and_can_be_dropped(spark):
    from tabwise.session import drop_scratch, scratch_path
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b
    spark.range(3).write.parquet(a)
    assert spark.read.parquet(a).count() == 3
    drop_scratch(spark, a)
    with pytest.raises(AnalysisException):
        spark.read.parquet(a)
