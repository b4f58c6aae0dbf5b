"""Delimited records with newlines in quoted cells, read by many tasks a file.

Spark's ``multiLine`` gives a whole file to one task, as only a parser that has
seen everything before knows whether a newline ends a row or stands in a cell.
The only thing it has to know is whether the number of quotes so far is odd. So one
native pass counts the quotes of every byte range, a prefix sum over the ranges
of a file says which of them begin inside a cell, and then every range finds its
records alone. A record that crosses a boundary leaves a fragment in each range;
if there are any, the lines of their ranges are read once more and the fragments
joined in the order of the ranges. Cells are parsed by ``from_csv`` afterwards.

All readings have to split the files alike. Spark derives the ranges from its
settings, the files and the cores it has, so a task checks that its range is one of
those counted and fails otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a row of the second pass is: a record, or a fragment that lacks its beginning,
#: its end, or both.
_WHOLE, _END, _BEGIN, _INSIDE = range(4)
_SCHEMA = "file string, range long, kind int, first boolean, record binary"
_PART_ROWS = 1 << 16


def _lines(spark: SparkSession, path, glob: str | None) -> DataFrame:
    """Physical lines with the file and the byte range they come from, in the file's order within a range."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_block_length").alias("length"), F.col("value").cast("binary").alias("line"))


def ranges(spark: SparkSession, path, quote: str = '"', glob: str | None = None) -> DataFrame:
    """file, range, length, inside, before: the byte ranges, whether they begin inside a quoted cell, the range before.

    A file whose quotes don't pair up is an error.
    """
    text = F.col("line").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(quote), F.lit("")))
    odd = _lines(spark, path, glob).groupBy("file", "range", "length").agg((F.sum(quotes) % 2).alias("odd"))
    # One row a range: as many as the scan has splits.
    so_far = Window.partitionBy("file").orderBy("range")
    states = odd.select(
        "file", "range", "length",
        F.coalesce(F.sum("odd").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begins"),
        F.sum("odd").over(so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"),
        F.lag("range").over(so_far).alias("before"))
    checked = F.when(F.col("all") % 2 == 0, F.col("begins") % 2).otherwise(
        F.raise_error(F.concat(F.lit("a quoted cell never ends in "), F.col("file"))).cast("bigint"))
    return states.select("file", "range", "length", (checked == 1).alias("inside"), "before")


def _records(split: dict[str, tuple[int, int]], opened: set[tuple[str, int]], quote: bytes, fragments: bool):
    """Records and fragments of the lines of each range, or the fragments only.

    ``split``: per file the length of its ranges but the last, and where that ends;
    ``opened``: the ranges that begin inside a cell.
    """
    def out(file: str, start: int, rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
        kinds, first, records = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * len(rows), pa.string()), pa.array([start] * len(rows), pa.int64()), pa.array(kinds, pa.int32()),
             pa.array(first, pa.bool_()), pa.array(records, pa.binary())], ["file", "range", "kind", "first", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, lacks_begin, held, first = None, False, False, [], False

        def kept(rows):
            return [r for r in rows if r[0] != _WHOLE] if fragments else rows

        def ended():
            """What the last line of a range leaves behind."""
            return [(_INSIDE if lacks_begin else _BEGIN, first, b"\n".join(held))] if held else []

        for batch in batches:
            files, starts = batch["file"].to_pylist(), batch["range"].to_numpy()
            changes = np.flatnonzero(starts[1:] != starts[:-1]) + 1 if len(starts) else []
            edges = sorted({0, len(files), *changes, *(i for i in range(1, len(files)) if files[i] != files[i - 1])})
            for low, high in zip(edges, edges[1:]):
                here = (files[low], int(starts[low]))
                if here != at:
                    if at and (rest := kept(ended())):
                        yield out(*at, rest)
                    size, end = split.get(here[0], (1, -1))
                    length = batch["length"][low].as_py()
                    if here[1] % size or length != min(size, end - here[1]):
                        raise RuntimeError(f"{here} is not a range that was counted: the files are split in another way "
                                           "now; set spark.sql.files.minPartitionNum")
                    inside = here in opened
                    at, held, first, lacks_begin = here, [], here[1] == 0, inside
                lines = batch["line"].slice(low, high - low)
                odd = np.cumsum(pc.count_substring(lines, quote).to_numpy()) % 2
                after = odd.astype(bool) ^ inside
                before = np.concatenate([[inside], after[:-1]])
                rows = []
                for line, begins_in, ends_in in zip(lines.to_pylist(), before.tolist(), after.tolist()):
                    if not begins_in and not ends_in:
                        rows.append((_WHOLE, first, line))
                        first = False
                    else:
                        held.append(line)
                        if not ends_in:
                            rows.append((_END if lacks_begin else _WHOLE, first and not lacks_begin, b"\n".join(held)))
                            held, lacks_begin, first = [], False, False
                    if len(rows) >= _PART_ROWS:
                        if rows := kept(rows):
                            yield out(*at, rows)
                        rows = []
                inside = bool(after[-1])
                if rows := kept(rows):
                    yield out(*at, rows)
        if at and (rest := kept(ended())):
            yield out(*at, rest)

    return run


def read_records(spark: SparkSession, path, encoding: str = "UTF-8", quote: str = '"',
                 glob: str | None = None) -> DataFrame:
    """file, first, record: the rows of delimited files as text, newlines in quoted cells included.

    ``first`` marks the first record of its file (a header, say). The quote is one
    ASCII character, a literal one is doubled, and quotes occur in quoted cells
    only. ``encoding`` must write quotes and newlines as in ASCII (not UTF-16).
    Line ends may be LF or CRLF; blank lines are no records. Counting the quotes of
    the ranges runs a job over the files.
    """
    found = ranges(spark, path, quote, glob).collect()
    split: dict[str, tuple[int, int]] = {}
    for r in found:
        size, end = split.get(r.file, (0, 0))
        split[r.file] = max(size, r.length), max(end, r.range + r.length)
    opened = {(r.file, r.range) for r in found if r.inside}
    crossing = {(r.file, x) for r in found if r.inside for x in (r.range, r.before)}
    lines, sign = _lines(spark, path, glob), quote.encode("ascii")
    records = lines.mapInArrow(_records(split, opened, sign, False), _SCHEMA).where(F.col("kind") == _WHOLE).select(
        "file", "first", "record")
    if crossing:
        # Asked for by range and file together: by file alone Spark would leave out files, and split the others anew.
        here = F.concat_ws(":", "range", "file").isin([f"{start}:{file}" for file, start in sorted(crossing)])
        pieces = lines.where(here).mapInArrow(_records(split, opened, sign, True), _SCHEMA)
        # Within a range the end of an old record stands before the beginning of a new one.
        order = [F.col("range"), F.col("kind") == _BEGIN]
        number = F.sum((F.col("kind") == _BEGIN).cast("int")).over(Window.partitionBy("file").orderBy(*order))
        joined = pieces.withColumn("number", number).groupBy("file", "number").agg(
            F.sort_array(F.collect_list(F.struct("range", F.col("kind").alias("kind"), "record", "first"))).alias("parts"))
        # Joined as hexadecimal digits: bytes of any encoding stay what they are.
        whole = F.unhex(F.array_join(F.transform("parts.record", lambda b: F.hex(b)), "0A"))
        records = records.unionByName(joined.select("file", F.array_max("parts.first").alias("first"), whole.alias("record")))
    text = F.regexp_replace(F.decode("record", encoding), "\r$", "")
    return records.select("file", "first", text.alias("record")).where(F.trim("record") != "")
