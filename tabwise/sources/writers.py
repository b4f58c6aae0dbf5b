"""Sinks: sheet export, append load, guarded write, compression, clustered layout,
and the dataset metadata table."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwise.functions.text import pad_key
from tabwise.operators.ordinal import with_ordinal
from tabwise.schemas import METADATA_COLUMNS

INDEX = "index"


def with_sheet_index(df: DataFrame, order_cols: list, index_name: str = INDEX) -> DataFrame:
    """Ordinal index (0-based, following ``order_cols``) as the first column."""
    indexed = with_ordinal(df, order_cols, index_name)
    return indexed.select(index_name, *df.columns)


def export_sheet(df: DataFrame, path: str, order_cols: list,
                 index_name: str = INDEX, single_file: bool = False) -> str:
    """Write a header CSV whose first column is the row ordinal.

    Cells come back as they are: padding is kept, an empty text is written in
    quotes and differs from null, and newlines are quoted. ``single_file``
    coalesces to one writer: only for outputs known to be small.
    """
    out = with_sheet_index(df, order_cols, index_name)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("quote", '"')
        .option("escape", '"').option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def append_load(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> str:
    """Append to a dataset, creating it on first use; run twice it appends twice (see ``append_once``)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


#: Folder of loads that are not complete; its name hides it from readers.
_STAGING = "_staging"
LOAD = "load"


def source_fingerprint(spark: SparkSession, path, glob: str | None = None) -> str:
    """One text for a set of source files: their number, bytes, and a hash of names, lengths and times.

    Only the listing is read. The same files give the same text in any order; a file
    that is added, replaced or touched changes it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    row = reader.load(path).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0)).alias("hash")).first()
    return f"{row.files}-{row.bytes}-{row['hash'] & (1 << 64) - 1:016x}"


def append_once(df: DataFrame, path: str, load_id: str, partition_by: list[str] | None = None) -> bool:
    """Append ``df`` as the load ``load_id``, unless that load is there already; whether it was written.

    The rows are written to a hidden staging folder first, and one rename to
    ``<path>/load=<load_id>`` publishes all of them. So the table's folders are the
    manifest of what was loaded: a load that broke down leaves nothing to be read and
    can be run again, one that is repeated writes nothing, and of two drivers with the
    same load one publishes. ``spark.read.parquet(path)`` sees whole loads, with the
    id in the column ``load``. On stores without an atomic folder rename a reader may
    see a load while it is moved. ``source_fingerprint`` makes an id from source files.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
        raise ValueError(f"a load id is letters, digits, '.', '_' and '-': {load_id!r}")
    if LOAD in df.columns:
        raise ValueError(f"the column {LOAD!r} names the load")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    target = place(f"{path}/{LOAD}={load_id}")
    files = target.getFileSystem(conf)
    if files.exists(target):
        return False
    staged = f"{path}/{_STAGING}/{load_id}-{uuid.uuid4().hex[:12]}"
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(target).toUri(), conf)
    # Unlike FileSystem.rename, this one refuses a target that exists.
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(place(staged)), files.makeQualified(target), plain)
    except Py4JJavaError:
        files.delete(place(staged), True)
        if files.exists(target):
            return False
        raise
    return True


def loads(spark: SparkSession, path: str) -> list[str]:
    """The ids of the published loads of a table."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(n[len(LOAD) + 1:] for n in names if n.startswith(f"{LOAD}="))


def guarded_write(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write, refusing if the target exists (raises ``AnalysisException``)."""
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def compressed_write(df: DataFrame, path: str, codec: str = "zstd",
                     fmt: str = "parquet") -> str:
    """Write with a compression codec (zstd/gzip/snappy for Parquet, gzip for CSV)."""
    w = df.write.mode("overwrite").format(fmt).option("compression", codec)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def clustered_write(df: DataFrame, path: str, key: str, partition_by: list[str] | None = None,
                    num_partitions: int | None = None) -> str:
    """Lay data out for key lookups instead of building an index.

    Rows are range-partitioned on (partition columns, key) and sorted within each
    task, so each output file covers a narrow key range: Parquet min/max
    statistics then skip row groups for key predicates, and ``partition_by``
    folders are pruned for predicates on those columns. A hash of the row breaks
    ties, so the rows of one hot key spread over several files.
    """
    cols = [*(partition_by or []), key]
    # Maps cannot be hashed; the other columns are enough to part equal keys.
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    order = [*[F.col(f"`{c}`") for c in cols], F.xxhash64(*hashed)]
    laid = (df.repartitionByRange(num_partitions, *order) if num_partitions
            else df.repartitionByRange(*order)).sortWithinPartitions(*cols)
    w = laid.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


#: Rows that the rank boundaries of a key are taken from, at most (they only shape the layout).
LAYOUT_SAMPLE = 20_000
_RANK_BITS = 8


def _rank(key: Column, bounds: list, low: int = 0) -> Column:
    """How many of the sorted bounds are not above the key: a comparison tree as deep as the rank has bits."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(key < F.lit(bounds[middle]), _rank(key, bounds[:middle], low)).otherwise(
        _rank(key, bounds[middle + 1:], low + middle + 1))


def interleaved_ranks(df: DataFrame, keys: list[str], bits: int = _RANK_BITS) -> Column:
    """A place on a space-filling curve: the bits of the keys' ranks in turn.

    Rows near each other on the curve are near in every key. Ranks are parts of equal
    size of a bounded sample (LAYOUT_SAMPLE rows), so skewed keys use all bits. A null
    key comes first.
    """
    bits = min(bits, 62 // len(keys))
    share = min(1.0, LAYOUT_SAMPLE / max(1, df.count()))
    named = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    sample = named.sample(share, seed=7).limit(2 * LAYOUT_SAMPLE).collect()
    place, parts = F.lit(0).cast("long"), 1 << bits
    for i, k in enumerate(keys):
        values = sorted(row[i] for row in sample if row[i] is not None)
        bounds = sorted({values[len(values) * j // parts] for j in range(1, parts)}) if values else []
        rank = F.coalesce(_rank(F.col(f"`{k}`"), bounds), F.lit(0)).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(keys) + i))
    return place


def clustered_write_multi(df: DataFrame, path: str, keys: list[str], num_partitions: int | None = None) -> str:
    """One layout for lookups by any of several keys, instead of an index on each.

    Rows are range-partitioned by their place on a space-filling curve over the keys'
    ranks, so every file and row group covers a narrow range of each key and Parquet's
    min/max statistics skip most of them whichever key is asked for. A hash of the row
    breaks ties, so equal keys spread over tasks.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    placed = df.withColumn("_tw_place", interleaved_ranks(df, keys))
    order = [F.col("_tw_place"), F.xxhash64(*hashed)]
    laid = (placed.repartitionByRange(num_partitions, *order) if num_partitions
            else placed.repartitionByRange(*order)).sortWithinPartitions("_tw_place", *[F.col(f"`{k}`") for k in keys])
    laid.drop("_tw_place").write.mode("overwrite").parquet(path)
    return path


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, pad_width: int | None = None) -> DataFrame:
    """A registry laid out once for all lookups: a catalogue table bucketed and sorted by its key.

    A join on the key with any list of keys then shuffles that list only. ``pad_width``
    stores the key padded with zeros. Rows without a key are left out, as no lookup
    finds them.
    """
    table = df.withColumn(key, pad_key(key, pad_width)) if pad_width else df
    (table.where(F.col(f"`{key}`").isNotNull()).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def save_table(df: DataFrame, name: str, path: str, statistics: bool = True) -> DataFrame:
    """A catalogue table with row count and column statistics, which the optimizer plans joins by."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    if statistics:
        df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return df.sparkSession.table(name)


def write_with_metadata(df: DataFrame, path: str, reference_date: str, date_key: str = "CNPJ",
                        count_key: str = "cnpj_qtde") -> DataFrame:
    """Write ``df`` and return its metadata table; the rows are counted by the write itself.

    One job over the data: the count is an observed metric, not a second scan.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    ref, val = METADATA_COLUMNS
    return df.sparkSession.createDataFrame(
        [(date_key, reference_date), (count_key, str(seen.get["rows"]))], f"{ref} string, {val} string")


def dataset_metadata(df: DataFrame, reference_date: str,
                     date_key: str = "CNPJ", count_key: str = "cnpj_qtde") -> DataFrame:
    """Key/value table (referencia, valor): the reference date and the row count."""
    spark = df.sparkSession
    ref, val = METADATA_COLUMNS
    date_row = spark.createDataFrame([(date_key, reference_date)], f"{ref} string, {val} string")
    count_row = df.agg(F.count(F.lit(1)).cast("string").alias(val)).select(
        F.lit(count_key).alias(ref), val)
    return date_row.unionByName(count_row)


def preview(df: DataFrame, n: int = 50):
    """First ``n`` rows as a pandas frame, for display at the edge of a job.

    Bounded by ``n``; never use it to move data between steps of a pipeline.
    """
    return df.limit(n).toPandas()
