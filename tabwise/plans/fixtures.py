"""Land driver tables as the raw files the loaders expect.

These build inputs for the file-based queries and tests: delimited extracts,
zip archives, and class folders of per-item files. Archives and item files are
written by the tasks themselves through ``pyarrow.fs``, which resolves the
target URI (``file:``, ``hdfs:``, ``s3:``...) the same way on every executor;
each task writes to a temporary name and renames when done, so a retried task
never leaves a half-written file under the final name.
"""

from __future__ import annotations

import io
import time
import zipfile
from contextlib import contextmanager

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwise.sources.readers import LATIN1, task_filesystem


#: Seconds spent on landing inputs since the last reset; read by the benchmark.
LANDING = {"seconds": 0.0}


@contextmanager
def landing():
    """Count the block as landing of an input, not as work of the query."""
    began = time.perf_counter()
    try:
        yield
    finally:
        LANDING["seconds"] += time.perf_counter() - began


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def land_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = LATIN1,
                   mode: str = "overwrite") -> str:
    """Headerless delimited text, standard quoting, in the given encoding."""
    with landing():
        (as_text(df).write.mode(mode).option("header", False).option("sep", sep)
            .option("encoding", encoding).option("quote", '"').option("escape", '"')
            .csv(path))
    return path


def land_zip_archives(lines: DataFrame, path: str, member_suffix: str,
                      encoding: str = LATIN1, archives: int | None = None) -> str:
    """``archives`` zip archives (default: the default parallelism), one per task,
    from ``lines`` (a single text column)."""
    col = lines.columns[0]
    lines = lines.repartition(archives or lines.sparkSession.sparkContext.defaultParallelism)

    def write(batches):
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        fs, root = task_filesystem(path)
        fs.create_dir(root, recursive=True)
        tmp = f"{root}/.part-{pid:05d}-{attempt}.zip.tmp"
        n = 0
        with fs.open_output_stream(tmp) as sink:
            with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
                with zf.open(f"part-{pid:05d}{member_suffix}", "w") as raw:
                    out = io.TextIOWrapper(raw, encoding=encoding, newline="\n")
                    for pdf in batches:
                        if len(pdf):
                            out.write("\n".join(pdf[col].tolist()))
                            out.write("\n")
                            n += len(pdf)
                    out.flush()
                    out.detach()
        fs.move(tmp, f"{root}/part-{pid:05d}.zip")
        yield pd.DataFrame({"rows": [n]})

    with landing():
        lines.select(col).mapInPandas(write, "rows long").agg(F.sum("rows")).collect()
    return path


def land_labelled_files(df: DataFrame, path: str, label: str, name: str, body: str,
                        suffix: str = ".txt") -> str:
    """One file per row at ``<path>/<label>/<name><suffix>`` holding ``body`` text."""

    def write(batches):
        ctx = TaskContext.get()
        tag = f"{ctx.partitionId()}-{ctx.attemptNumber()}" if ctx else "0-0"
        fs, root = task_filesystem(path)
        made = set()
        n = 0
        for pdf in batches:
            for lab, nm, text in zip(pdf[label], pdf[name], pdf[body]):
                folder = f"{root}/{lab}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                final = f"{folder}/{nm}{suffix}"
                tmp = f"{folder}/.{nm}{suffix}.{tag}.tmp"  # unique per task attempt
                with fs.open_output_stream(tmp) as fh:
                    fh.write(text.encode("utf-8"))
                fs.move(tmp, final)
                n += 1
        yield pd.DataFrame({"rows": [n]})

    with landing():
        df.select(label, name, body).mapInPandas(write, "rows long").agg(F.sum("rows")).collect()
    return path
