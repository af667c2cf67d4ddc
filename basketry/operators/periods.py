"""Periods: when, how often and at what least discount a customer bought a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import purchase_interval

PAIR = ["customer_id", "group_id"]


def periods(history: DataFrame) -> DataFrame:
    """One row per customer and group of a history with discount measures."""
    bounds = history.groupBy(*PAIR).agg(
        F.min("transaction_datetime").alias("first_group_purchase_date"),
        F.max("transaction_datetime").alias("last_group_purchase_date"),
        F.count("transaction_id").alias("group_purchase"),
        F.coalesce(F.min("line_discount_min"), F.lit(0.0)).alias("group_min_discount"),
    )
    return bounds.select(
        *PAIR,
        "first_group_purchase_date",
        "last_group_purchase_date",
        "group_purchase",
        purchase_interval(
            F.col("first_group_purchase_date"),
            F.col("last_group_purchase_date"),
            F.col("group_purchase"),
        ).alias("group_frequency"),
        "group_min_discount",
    )


def group_min_discount(history: DataFrame) -> DataFrame:
    return periods(history).select(*PAIR, "group_min_discount")
