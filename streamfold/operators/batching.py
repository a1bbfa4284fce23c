"""Consumer batching (AGG-07, AGG-08, SRC-03, Q20).

Records of one topic partition, in offset order, are cut into groups of
``n``; the last group may be short.  Row numbers come from the chunked
prefix count, so a partition holding a third of the topic is numbered by
many tasks, not one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import DEFAULT_SPAN, running_sums


def number_records(records: DataFrame, partition_col: str = "partition",
                   offset_col: str = "offset", span: int = DEFAULT_SPAN) -> DataFrame:
    """Add ``rn``: 1-based position of the record within its partition."""
    return running_sums(records, [partition_col], offset_col,
                        {"rn": F.lit(1).cast("bigint")}, span=span)


def batch_groups(records: DataFrame, n: int, partition_col: str = "partition",
                 offset_col: str = "offset", span: int = DEFAULT_SPAN) -> DataFrame:
    """One row per batch: ``partition, batch_no, n_records, first_offset,
    last_offset``.  ``n_records`` is the AGG-08 count of delivered records."""
    numbered = number_records(records.select(partition_col, offset_col),
                              partition_col, offset_col, span)
    return (numbered.withColumn("batch_no", F.floor((F.col("rn") - 1) / n).cast("bigint"))
            .groupBy(partition_col, "batch_no")
            .agg(F.count("*").alias("n_records"),
                 F.min(offset_col).alias("first_offset"),
                 F.max(offset_col).alias("last_offset")))
