"""The foreign-key join (JOIN-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """JOIN-07: inner join on the foreign key.  Both sides grow with the
    data, so no hint: the planner picks broadcast only when statistics
    prove one side small, otherwise a sort-merge join (AQE re-plans)."""
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "inner")


def orphan_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """JOIN-07 integrity check: orders whose customer does not exist."""
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left_anti")
