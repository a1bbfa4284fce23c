"""Parquet table scans.  Callers name the columns they need so the scan's
``ReadSchema`` holds only those (column pruning reaches the file reader)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str,
               parallel: bool = False) -> DataFrame:
    """Scan ``name`` with only ``cols``.  With ``parallel`` (scans that feed
    CPU-heavy work on text or JSON) a table of one single split, at most
    ``maxPartitionBytes``, is dealt over the cores; any larger table is
    read as it is, without a shuffle."""
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*cols) if cols else df
    if parallel and df.rdd.getNumPartitions() == 1:
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df
