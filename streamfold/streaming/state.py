"""Tables kept in Spark's own keyed state (SNK-06, SNK-07, SRC-09).

A compacted table is a streaming aggregation: one row per key, replaced
when a later one comes.  The state store holds it, the checkpoint commits
it with every micro-batch, and ``read_state`` reads it by Spark's
``statestore`` source, while the query runs or after it.  No table of our
own is written beside it.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_stream(stream: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, as a streaming table
    (run it with ``outputMode("update")``; read it with ``read_latest``).
    Late and reordered rows change nothing: the fold is commutative."""
    return stream.groupBy(*keys).agg(F.max(F.struct(order, *values)).alias("row"))


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """(key, value) of a query with one stateful operator, as of its last
    committed micro-batch; None when it has not committed any."""
    try:
        return spark.read.format("statestore").load(checkpoint).select("key", "value")
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise       # an unreadable state must not read as an empty table
        return None


def read_variable(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame | None:
    """Key and value of a processor's state variable (of a map state one row
    per entry, with ``user_map_key`` and ``user_map_value``), as of the last
    committed micro-batch; None when it has not committed any."""
    try:
        return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return None


def read_latest(spark: SparkSession, checkpoint: str, schema: str) -> DataFrame:
    """The table of a ``latest_stream`` query; ``schema`` names its columns,
    keys first, and is the schema of an empty table."""
    empty = spark.createDataFrame([], schema)
    state = read_state(spark, checkpoint)
    return empty if state is None else state.select("key.*", "value.max.*").select(*empty.columns)


CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def keep_changelog(spark: SparkSession) -> None:
    """Have the state stores of queries started from now on log changes, so
    that ``read_changes`` can read them."""
    spark.conf.set(CHANGELOG, "true")


def read_changes(spark: SparkSession, checkpoint: str, schema: str, first_batch: int = 0,
                 last_batch: int | None = None) -> DataFrame:
    """A ``latest_stream`` table as a feed: batch, change (``update`` or
    ``delete``) and the row as it was written, from the state's change log.
    It goes as far back as the state keeps batches."""
    r = spark.read.format("statestore").option("readChangeFeed", True).option("changeStartBatchId", first_batch)
    if last_batch is not None:
        r = r.option("changeEndBatchId", last_batch)
    cols = spark.createDataFrame([], schema).columns
    return r.load(checkpoint).select(F.col("batch_id").alias("batch"), F.col("change_type").alias("change"), "key.*", "value.max.*").select(
        "batch", "change", *cols)


def replayed_changes(feed: DataFrame, keys: list[str], upto: int | None = None) -> DataFrame:
    """The table that a feed leads to, as of batch ``upto``."""
    own = feed if upto is None else feed.filter(F.col("batch") <= upto)
    values = [c for c in feed.columns if c not in (*keys, "batch")]
    last = own.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("row"))
    return last.filter("row.change <> 'delete'").select(*keys, *[F.col(f"row.{c}").alias(c) for c in values if c != "change"])
