"""Incremental append load of landed delimited extracts.

The batch loader appends every extract file it finds; as a file-source stream the
same load picks up only files not seen before (the checkpoint records them), so
re-running after new files land appends exactly those, and a failed run resumes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tabwise.sources.readers import LATIN1, delimited_options, delimited_rows, delimited_schema


def stream_append_load(spark: SparkSession, source_dir: str, columns: list[str],
                       target: str, checkpoint: str, sep: str = ";",
                       encoding: str = LATIN1, glob: str | None = None,
                       max_files_per_trigger: int | None = None, ragged: str = "fail"):
    """Append all not-yet-loaded files of ``source_dir`` to the Parquet ``target``.

    Runs with ``availableNow``: processes what is there (in bounded micro-batches
    when ``max_files_per_trigger`` is set) and stops. Returns the finished query.
    Rows with too few or too many cells follow the batch reader's ``ragged`` rule.
    """
    reader = (spark.readStream.schema(delimited_schema(columns)).option("header", False)
              .option("encoding", encoding).options(**delimited_options(sep)))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = delimited_rows(reader.csv(source_dir), columns, True, ragged)
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(target))
    query.awaitTermination()
    return query
