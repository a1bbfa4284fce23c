"""Generators (SRC-13..SRC-15).  Bounded ones are ``spark.range`` based, so
rows are produced inside executors; rate ones use the ``rate`` source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import now_nanos

# --- fixed values -----------------------------------------------------------
DEFAULT_PAYLOAD = "Hello from producer"
RANDOM_INT_BOUND = 1_000_000           # SRC-14: [0, 1,000,000)
ORDER_USERS = 10                       # SRC-15: user in [0, 10)
ORDER_AMOUNT_MIN, ORDER_AMOUNT_SPAN = 1000, 90_000   # amount in [1000, 91000)
# ---------------------------------------------------------------------------


def payload_messages(spark: SparkSession, n: int, payload: str = DEFAULT_PAYLOAD,
                     num_partitions: int | None = None) -> DataFrame:
    """SRC-13: ``n`` messages ``(id, payload, ts)`` with ts the current time in ns."""
    r = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    return r.select(F.col("id"), F.lit(payload).alias("payload"), now_nanos().alias("ts"))


def random_ints(spark: SparkSession, rows_per_second: int = 1, seed: int = 7) -> DataFrame:
    """SRC-14: one random integer per second (streaming)."""
    s = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return s.select(F.col("value").alias("seq"),
                    F.floor(F.rand(seed) * RANDOM_INT_BOUND).cast("bigint").alias("n"))


def random_orders(spark: SparkSession, rows_per_second: int = 1, seed: int = 11) -> DataFrame:
    """SRC-15: one random order per second (streaming), keyed by user."""
    s = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return s.select(
        F.floor(F.rand(seed) * ORDER_USERS).cast("bigint").alias("user_id"),
        F.xxhash64("value", F.lit(seed)).alias("order_id"),
        (F.lit(ORDER_AMOUNT_MIN) + F.floor(F.rand(seed + 1) * ORDER_AMOUNT_SPAN)).cast("bigint")
        .alias("order_amount"),
        F.col("value").alias("offset"))
