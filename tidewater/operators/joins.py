"""Relational joins of the monitored schema (JN1, JN2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_per_customer(customer: DataFrame, orders: DataFrame, limit: int | None = None) -> DataFrame:
    """JN1: ``customer ⟕ orders`` with an order count per customer name.

    Orders are counted per customer key before the join, so the shuffle moves
    one partial count per key and task instead of every order row; customers
    without orders keep a count of 0 (left outer join).
    """
    per_key = orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = customer.select("c_custkey", "c_name").join(
        per_key, customer["c_custkey"] == per_key["o_custkey"], "left")
    out = joined.groupBy("c_name").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("order_count"))
    return out.limit(limit) if limit else out


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JN2: full outer equi-join of two sources (sort-merge; no side is broadcastable)."""
    return left.join(right, left[left_key] == right[right_key], "full_outer")
