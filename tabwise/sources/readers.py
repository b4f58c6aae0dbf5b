"""Scans: header CSV, headerless delimited extracts, zipped extracts, JSON, file sets.

Scans take an explicit schema, so no inference pass runs over the data and keys keep
their leading zeros (they are text); ``read_csv_inferred`` finds the types instead.
"""

from __future__ import annotations

import io
import sys
import zipfile
from fnmatch import fnmatchcase
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.schemas import CODE_TABLE_COLUMNS, CODE_TABLE_SUFFIXES, LARGE_TABLE_COLUMNS, LARGE_TABLE_SUFFIXES, all_text_schema
from tabwise.sources.inference import infer_types, with_types
from tabwise.sources.quoted import read_records

LATIN1 = "ISO-8859-1"


#: Stands for null while a file is parsed: no cell holds it.
_NO_TEXT = "\x00null\x00"


def read_csv_header(spark: SparkSession, path, schema: T.StructType | None = None,
                    sep: str = ",", null_value: str | None = None, empty_value: str = "",
                    multi_line: bool = False) -> DataFrame:
    """Header CSV with standard quoting (a doubled quote is a literal quote).

    Columns are bound by the names in the header, in whatever order the file has
    them; a missing name or a file with another header is an error. Without a schema
    every column of the header is text. A quoted empty cell is ``empty_value``, an
    unquoted one null. ``multi_line`` allows newlines in quoted cells; such files
    are split over tasks as well, after a pass that counts their quotes.
    """
    def options():
        # By default Spark takes the empty text for null, quoted or not.
        return {"sep": sep, "quote": '"', "escape": '"', "emptyValue": empty_value, "mode": "FAILFAST",
                "nullValue": _NO_TEXT if null_value is None else null_value,
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

    # Reads the first row only.
    header = spark.read.options(**options()).option("header", True).option("multiLine", multi_line).csv(path).columns
    schema = schema or all_text_schema(header)
    fields = {f.name: f for f in schema.fields}
    missing = [n for n in fields if n not in header]
    if missing:
        raise ValueError(f"columns not in the header: {missing}")
    in_file = T.StructType([fields.get(n, T.StructField(n, T.StringType())) for n in header])
    if not multi_line:
        rows = spark.read.options(**options()).option("header", True).schema(in_file).option("enforceSchema", False).csv(path)
    else:
        rows = _header_records(spark, path, header, in_file, options())
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def _header_records(spark: SparkSession, path, header: list[str], in_file: T.StructType, options: dict) -> DataFrame:
    """The rows behind the headers of files with newlines in cells; every file has to have this header."""
    def parsed(schema: T.StructType):
        return F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
                          {**options, "columnPruning": "false"})

    records = read_records(spark, path)
    names = parsed(all_text_schema(header))
    own = F.array(*[names[n] for n in header]) == F.array(*[F.lit(n) for n in header])
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("file"), F.lit(": "), F.col("record"))).cast("boolean")
    # A header is checked where it is left out.
    body = records.where(F.when(~F.col("first"), True).when(F.coalesce(own, F.lit(False)), False).otherwise(other))
    return body.select(parsed(in_file).alias("_tw_r")).select("_tw_r.*")


def read_csv_inferred(spark: SparkSession, path, sep: str = ",", null_value: str | None = None,
                      multi_line: bool = False, dates: bool = True) -> DataFrame:
    """Header CSV whose column types come from all its cells, see ``infer_types``.

    One pass over the files finds the types; the rows are read with them afterwards.
    """
    text = read_csv_header(spark, path, None, sep, null_value, multi_line=multi_line)
    return with_types(text, infer_types(text, dates=dates))


#: Where the parser puts the raw line of a row with too few or too many cells.
_RAW = "_tw_raw"
REJECTED = "rejected"


def delimited_options(sep: str) -> dict:
    """One set of parser options for files, archives and streams."""
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _RAW,
            # Cells are counted only where all of them are parsed.
            "columnPruning": "false"}


def delimited_schema(columns: list[str]) -> T.StructType:
    return T.StructType([*all_text_schema(columns).fields, T.StructField(_RAW, T.StringType(), True)])


def delimited_rows(parsed: DataFrame, columns: list[str], keep_blanks: bool, ragged: str) -> DataFrame:
    """The rule for rows with too few or too many cells, the same for every reader.

    ``ragged="fail"`` stops the job at the first one; ``"keep"`` adds a column
    ``rejected`` with the raw line of such rows (null for good ones).
    """
    # Spark refuses to read the raw line alone, so this also reads (nothing of) a cell.
    raw = F.concat(F.col(_RAW), F.coalesce(F.substring(F.col(f"`{columns[0]}`"), 1, 0), F.lit("")))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) if keep_blanks else F.col(f"`{c}`") for c in columns]
    cells = [c.alias(n) for c, n in zip(cells, columns)]
    if ragged == "keep":
        return parsed.select(*cells, raw.alias(REJECTED))
    if ragged != "fail":
        raise ValueError(f"ragged must be 'fail' or 'keep', not {ragged!r}")
    good = F.when(raw.isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row with too few or too many cells: "), raw)).cast("boolean"))
    return parsed.where(good).select(*cells)


def read_delimited_text(spark: SparkSession, path, columns: list[str], sep: str = ";",
                        encoding: str = LATIN1, glob: str | None = None,
                        keep_blanks: bool = True, ragged: str = "fail",
                        multi_line: bool = False) -> DataFrame:
    """Headerless delimited extract, every column text, blanks kept as ''.

    Files are split into blocks and read in parallel; many files (a folder, a
    wildcard, or ``glob`` on the file name) union into one table. Blank lines are
    no rows. ``multi_line`` allows newlines in quoted cells; a pass that counts the
    quotes lets the files be split even so. For ``ragged`` see ``delimited_rows``.
    """
    if multi_line:
        records = read_records(spark, path, encoding, glob=glob)
        return parse_delimited_lines(records, "record", columns, sep, keep_blanks, ragged)
    reader = (spark.read.schema(delimited_schema(columns)).option("header", False)
              .option("encoding", encoding).options(**delimited_options(sep)))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return delimited_rows(reader.csv(path), columns, keep_blanks, ragged)


def read_code_table(spark: SparkSession, path, glob: str | None = None,
                    sep: str = ";", encoding: str = LATIN1) -> DataFrame:
    """Two-column code table (codigo, descricao)."""
    return read_delimited_text(spark, path, CODE_TABLE_COLUMNS, sep, encoding, glob)


_ZIP_LINES_SCHEMA = "archive string, member string, line string"


def task_filesystem(uri: str):
    """(filesystem, path) inside a task, for a Spark-style URI or a plain local path."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


_MEMBERS_SCHEMA = "archive string, member string, size long"


def _list_members(member_suffix: str | None, member_glob: str | None):
    def wanted(name: str) -> bool:
        return name.endswith(member_suffix or "") and (member_glob is None or fnmatchcase(name, member_glob))

    def members(batches):
        for pdf in batches:
            for path in pdf["path"]:
                fs, name = task_filesystem(path)
                with fs.open_input_file(name) as archive, zipfile.ZipFile(archive) as zf:
                    found = [(path, m.filename, m.compress_size) for m in zf.infolist()
                             if not m.is_dir() and wanted(m.filename)]
                yield pd.DataFrame(found, columns=["archive", "member", "size"])
    return members


def zip_members(spark: SparkSession, path, member_suffix: str | None = None,
                archive_glob: str = "*.zip", member_glob: str | None = None) -> DataFrame:
    """archive, member, size (compressed bytes) of the archives' directories; no content is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", archive_glob)
             .load(path).select("path"))
    return files.mapInPandas(_list_members(member_suffix, member_glob), _MEMBERS_SCHEMA)


def _deal_members(members: list[tuple[str, str, int]], task_bytes: int) -> list[list[tuple[str, str]]]:
    """Members in groups of about ``task_bytes``, largest first; a larger one is a group of its own."""
    groups, room = [], 0
    for archive, member, size in sorted(members, key=lambda m: (-m[2], m[0], m[1])):
        if not groups or size > room:
            groups.append([])
            room = task_bytes
        groups[-1].append((archive, member))
        room -= size
    return groups


def _line_chunks(text, beside: int, chunk_bytes: int):
    """Lines without their ends, in lists of about ``chunk_bytes`` with ``beside`` bytes more a line."""
    lines, room = [], chunk_bytes
    for line in text:
        lines.append(line.rstrip("\r\n"))
        room -= len(line) + beside
        if room <= 0:
            yield lines
            lines, room = [], chunk_bytes
    if lines:
        yield lines


def _unzip_members(encoding: str, chunk_bytes: int):
    def unzip(batches):
        for pdf in batches:
            for group in pdf["members"]:
                for m in group:
                    fs, name = task_filesystem(m["archive"])
                    with fs.open_input_file(name) as archive, zipfile.ZipFile(archive) as zf, zf.open(m["member"]) as fh:
                        text = io.TextIOWrapper(fh, encoding=encoding, newline="")
                        # Beside a line: the names, repeated in its row, and what a Python text takes.
                        beside = len(m["archive"]) + len(m["member"]) + sys.getsizeof("")
                        for lines in _line_chunks(text, beside, chunk_bytes):
                            # No .str of a series: the two refer to each other, so every chunk would stay until a collection.
                            yield pd.DataFrame({
                                "archive": m["archive"], "member": m["member"], "line": pd.Series(lines, dtype=object)})
    return unzip


def read_zip_lines(spark: SparkSession, path, member_suffix: str | None = None,
                   encoding: str = LATIN1, archive_glob: str = "*.zip",
                   chunk_bytes: int = 16 << 20, task_bytes: int = 64 << 20,
                   member_glob: str | None = None) -> DataFrame:
    """Lines of the members of zip archives: (archive, member, line).

    ``member_suffix`` and ``member_glob`` choose members by name.

    The unit of work is a member: a first small job reads the archives' directories
    (one row a member, as Spark lists files on the driver), members are dealt to
    tasks of about ``task_bytes`` compressed bytes, and a task opens the archive by
    its path, seeks to its members and reads them as streams in chunks of rows of
    about ``chunk_bytes``, of which it holds two at most. So neither an archive nor a
    member has to fit in memory, nor do their bytes pass through a row, and one
    archive of many members keeps many tasks busy. A member cannot be split. Members
    are listed when the table is defined.
    """
    listed = [tuple(r) for r in zip_members(spark, path, member_suffix, archive_glob, member_glob).collect()]
    groups = _deal_members(listed, task_bytes)
    # One group a partition.
    dealt = spark.createDataFrame(
        spark.sparkContext.parallelize([(g,) for g in groups], max(1, len(groups))),
        "members array<struct<archive: string, member: string>>")
    return dealt.mapInPandas(_unzip_members(encoding, chunk_bytes), _ZIP_LINES_SCHEMA)


def read_registry(spark: SparkSession, path, table: str, sep: str = ";", encoding: str = LATIN1,
                  ragged: str = "fail") -> DataFrame:
    """One table of the registry extract, from the archives that hold its members.

    ``table`` is a large table ("empresas", "estabelecimento", "socios", "simples") or
    a code table (a key of ``CODE_TABLE_SUFFIXES``). Members are picked by the
    published suffix, which a part's date may follow (``.SIMPLES.CSV.D20910``), and
    get the published layout; all columns are text.
    """
    if table in CODE_TABLE_SUFFIXES:
        suffix, columns = CODE_TABLE_SUFFIXES[table], CODE_TABLE_COLUMNS
    elif table in LARGE_TABLE_SUFFIXES:
        suffix, columns = LARGE_TABLE_SUFFIXES[table], LARGE_TABLE_COLUMNS[table]
    else:
        raise ValueError(f"no such registry table: {table!r}")
    lines = read_zip_lines(spark, path, encoding=encoding, member_glob=f"*{suffix}*")
    return parse_delimited_lines(lines, "line", columns, sep, ragged=ragged)


def parse_delimited_lines(df: DataFrame, line_col: str, columns: list[str],
                          sep: str = ";", keep_blanks: bool = True, ragged: str = "fail") -> DataFrame:
    """Parse text lines into named all-text columns (built-in ``from_csv``).

    Blank lines are no rows, as for files. For ``ragged`` see ``delimited_rows``.
    """
    ddl = ", ".join(f"`{c}` STRING" for c in [*columns, _RAW])
    lines = df.where(F.trim(F.col(line_col)) != "")
    parsed = lines.select(F.from_csv(F.col(line_col), ddl, delimited_options(sep)).alias("_tw_r")).select("_tw_r.*")
    return delimited_rows(parsed, columns, keep_blanks, ragged)


def read_json_array(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Files each holding one JSON array of flat objects: one row per element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_array_rows(df: DataFrame, column: str, element_ddl: str,
                    keep: list[str] | None = None) -> DataFrame:
    """Text column holding a JSON array of objects -> one row per object."""
    arr = F.from_json(F.col(column), f"array<struct<{element_ddl}>>")
    return df.select(*(keep or []), F.inline_outer(arr))


def json_map_rows(df: DataFrame, column: str, value_ddl: str,
                  keep: list[str] | None = None, key_name: str = "key",
                  value_name: str = "value") -> DataFrame:
    """Text column holding a JSON object keyed by name -> one (key, value) row per entry.

    A null, malformed or empty document keeps one row, with a null key.
    """
    m = F.from_json(F.col(column), f"map<string,{value_ddl}>")
    return df.select(*(keep or []), F.explode_outer(m).alias(key_name, value_name))


def read_labelled_files(spark: SparkSession, root, glob: str | None = None,
                        with_content: bool = True) -> DataFrame:
    """Files under class folders: (path, label, content); label = parent folder name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    parts = F.split(F.col("path"), "/")
    cols = [F.col("path"), F.try_element_at(parts, F.lit(-2)).alias("label"),
            F.try_element_at(parts, F.lit(-1)).alias("file_name")]
    if with_content:
        cols.append(F.col("content"))
    return df.select(*cols)
