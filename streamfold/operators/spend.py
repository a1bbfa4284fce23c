"""Spend per user: running total (AGG-01), total (AGG-02), band (FN-10),
change-only category output (AGG-05) and latest category (AGG-06).

The per-record running total is a prefix sum in offset order.  It is
computed with the chunked scan, so one user holding a third of all orders
is still spread over many tasks.  The previous category needs no second
window: the total before a record is ``running_total - amount``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import DEFAULT_SPAN, latest_per_key, running_sums

# --- fixed values -----------------------------------------------------------
GOLD_FROM = 1_000_000      # inclusive (Q15)
SILVER_FROM = 500_000      # inclusive
GOLD, SILVER, BRONZE = "gold", "silver", "bronze"
# ---------------------------------------------------------------------------


def band(total) -> Column:
    """FN-10: gold from 1,000,000, silver from 500,000, else bronze."""
    t = F.col(total) if isinstance(total, str) else total
    return (F.when(t >= GOLD_FROM, F.lit(GOLD))
            .when(t >= SILVER_FROM, F.lit(SILVER))
            .otherwise(F.lit(BRONZE)))


def running_totals(orders: DataFrame, span: int = DEFAULT_SPAN) -> DataFrame:
    """AGG-01: one output per order: ``user_id, order_id, order_amount,
    offset, total, seq`` where ``total`` is the user's sum so far and
    ``seq`` the order's position in the user's history (1-based)."""
    return running_sums(orders, ["user_id"], "offset",
                        {"total": "order_amount", "seq": F.lit(1).cast("bigint")}, span=span)


def spend_totals(orders: DataFrame) -> DataFrame:
    """AGG-02: total per user (content of the group table)."""
    return orders.groupBy("user_id").agg(F.sum("order_amount").alias("total"))


def category_changes(orders: DataFrame, span: int = DEFAULT_SPAN) -> DataFrame:
    """AGG-05: emit ``(user_id, offset, total, category)`` only for records
    whose band differs from the band before them; a user's first record
    always emits (Q14)."""
    rt = running_totals(orders, span)
    cat = band("total")
    prev = F.when(F.col("seq") > 1, band(F.col("total") - F.col("order_amount")))
    return (rt.withColumn("category", cat)
            .filter(prev.isNull() | (prev != cat))
            .select("user_id", "order_id", "offset", "total", "category"))


def latest_category(changes: DataFrame) -> DataFrame:
    """AGG-06: the category table: last emitted category per user
    (the band of the total it was emitted with)."""
    last = latest_per_key(changes, ["user_id"], "offset", ["total"])
    return last.select("user_id", band("total").alias("category"), "total")
