"""Relational tables (SRC-12, SNK-12): JDBC options and insert defaults.

No JDBC driver jar ships with a plain PySpark install, so reads and writes
are option builders; ``with_insert_defaults`` is the batch twin of a
table's column defaults (serial id, current timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import running_sums


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.  With a partition column
    and bounds the table is read by ``num_partitions`` parallel range
    queries instead of one connection."""
    o = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user:
        o["user"] = user
    if password:
        o["password"] = password
    if partition_column:
        o.update(partitionColumn=partition_column, lowerBound=str(lower),
                 upperBound=str(upper), numPartitions=str(num_partitions))
    return o


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    """SRC-12: ``SELECT * FROM table`` (projection and filters on the result
    are pushed into the generated SQL by the JDBC source)."""
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()


def with_insert_defaults(rows: DataFrame, order_col: str, id_col: str = "id",
                         ts_col: str | None = None, start: int = 1) -> DataFrame:
    """SNK-12 batch twin: ``id`` as a dense serial number in ``order_col``
    order starting at ``start`` (a global running count computed in
    bounded chunks, not in one task), and ``ts_col`` as the current time."""
    numbered = running_sums(rows, [], order_col, {"_sf_n": F.lit(1).cast("bigint")})
    out = numbered.withColumn(id_col, F.col("_sf_n") + F.lit(start - 1)).drop("_sf_n")
    if ts_col:
        out = out.withColumn(ts_col, F.current_timestamp().cast("timestamp_ntz"))
    return out


def write_jdbc(df: DataFrame, mode: str = "append", **kw) -> None:
    """SNK-12: append rows to a relational table."""
    df.write.format("jdbc").options(**jdbc_options(**kw)).mode(mode).save()
