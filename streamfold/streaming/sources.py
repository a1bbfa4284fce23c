"""File-stream sources over parquet tables (the local stand-in for topics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table_path


FILES_PER_TRIGGER = 64      # bounds a micro-batch; set per stream or by FILES_CONF
FILES_CONF = "streamfold.maxFilesPerTrigger"


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of one table in ``sf_dir``: the part files of the
    folder ``<name>.parquet``, or that one file.

    The schema is taken from the file footer once; a stream never infers.
    A micro-batch reads at most ``max_files_per_trigger`` files.
    """
    path = table_path(sf_dir, name)
    table = spark.read.parquet(path)                # fails if nothing is there
    files = max_files_per_trigger or spark.conf.get(FILES_CONF, str(FILES_PER_TRIGGER))
    r = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", str(files))
    if [f.rsplit("/", 1)[-1] for f in table.inputFiles()] != [f"{name}.parquet"]:
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def dir_stream(spark: SparkSession, path: str, schema,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream every parquet file of a directory, a few files per batch."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)
