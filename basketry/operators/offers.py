"""Personal offers for larger checks and for more visits."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.columns import check_mode, days_between, ratio, real, round_to_step
from basketry.operators.history import (
    analysis_moment,
    card_transactions,
    first_moment,
    in_period,
    latest_visits,
)
from basketry.operators.periods import PAIR
from basketry.schema import Tables

Moment = date | datetime | str
Affinity = Callable[[DataFrame], DataFrame]


def _moment(value: Moment | None) -> Column:
    return F.lit(None if value is None else str(value)).cast("timestamp_ntz")


def _end_of(value: Moment | None) -> Column:
    """The last moment of a day given as a date; a date with a time is that moment."""
    text = "" if value is None else str(value).strip()
    if len(text) == len("2022-01-31"):
        return _moment(text) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 0.000001 SECOND")
    return _moment(value)


def _check_per_customer(tables: Tables, visits: DataFrame, mode: str) -> DataFrame:
    """Turnover of the check lines over the number of transactions that have lines.

    Lines are summed per transaction before anything is joined, so a long receipt
    is combined on the map side. mode="as_written" divides by the number of lines.
    """
    receipts = tables.checks.groupBy("transaction_id").agg(
        F.sum("sku_summ").alias("summ"), F.count(F.lit(1)).alias("lines")
    )
    divisor = F.count(F.lit(1)) if check_mode(mode) == "spec" else F.sum("lines")
    return (
        visits.select("customer_id", "transaction_id")
        .join(receipts, "transaction_id")
        .groupBy("customer_id")
        .agg(ratio(F.sum("summ"), divisor).alias("average_check"))
    )


def avg_check_by_period(
    tables: Tables, first: Moment | None = None, last: Moment | None = None, mode: str = "spec"
) -> DataFrame:
    """Average check of the transactions in a period, both ends included.

    An end given as a date includes its day. A start that is missing or before the
    first transaction moves to it; an end that is missing, not after the start, or
    after the analysis date becomes the analysis date. Both substitutes are moments;
    mode="as_written" takes dates, substitutes too, for the midnight they begin with.
    """
    opening = first_moment(tables)
    closing = analysis_moment(tables)
    if check_mode(mode) == "as_written":
        opening_limit, closing_limit = opening.cast("date"), closing.cast("date")
    else:
        opening_limit, closing_limit = opening, closing
    opening_limit = opening_limit.cast("timestamp_ntz")
    closing_limit = closing_limit.cast("timestamp_ntz")
    given = first is not None
    first, last = _moment(first), _end_of(last) if mode == "spec" else _moment(last)
    start = F.when(first >= opening, first).otherwise(opening_limit)
    end = F.when((last > start) & (last <= closing), last).otherwise(closing_limit)
    tables = in_period(tables, start, end)
    visits = card_transactions(tables)
    if given:
        # The start is never before it, and a plain value reaches the scan.
        visits = visits.filter(F.col("transaction_datetime") >= first)
    return _check_per_customer(tables, visits, mode)


def avg_check_by_count(tables: Tables, count: int, mode: str = "spec") -> DataFrame:
    """Average check of each customer's `count` most recent transactions."""
    return _check_per_customer(tables, latest_visits(tables, count), mode)


def group_price_margin(tables: Tables) -> DataFrame:
    """Margin share of each group in the price lists: sum(retail - purchase) / sum(retail)."""
    per_sku = tables.stores.groupBy("sku_id").agg(
        F.sum(F.col("sku_retail_price") - F.col("sku_purchase_price")).alias("margin"),
        F.sum("sku_retail_price").alias("retail"),
    )
    return (
        tables.product_grid.select("sku_id", "group_id")
        .join(per_sku, "sku_id")
        .groupBy("group_id")
        .agg(ratio(F.sum("margin"), F.sum("retail")).alias("average_margin"))
    )


def reward_group(
    details: DataFrame,
    max_churn: float,
    max_discount_share: float,
    margin_share: float,
    *,
    per: str = "customer",
    rounding: str = "up",
    margin_basis: str = "customer_total",
    price_margin: DataFrame | None = None,
    affinity: Affinity | None = None,
) -> DataFrame:
    """The group each customer is rewarded in, with the discount.

    A group qualifies if churn and discount share do not exceed the limits and
    the rounded minimum discount is below the allowed margin; the qualifying
    group of highest affinity is taken. Shares are given in percent.

    margin_basis: customer_total (the pair's margin in money), customer_ratio
    (margin over paid sum) or price_list (`price_margin` of the group).
    per="group" picks the best customer of each group instead. `affinity` adds
    group_affinity_index to the qualifying pairs where `details` lacks it, from their
    group_purchase, first and last.
    """
    if margin_basis == "price_list":
        pairs = details.join(price_margin, "group_id")
        basis = F.col("average_margin")
    elif margin_basis == "customer_ratio":
        pairs, basis = details, ratio("group_margin", "group_summ_paid")
    elif margin_basis == "customer_total":
        pairs, basis = details, real("group_margin")
    else:
        raise ValueError(f"unknown margin_basis {margin_basis!r}")

    # A margin ratio times a percentage is a percentage; money takes the plain fraction.
    share = margin_share / 100 if margin_basis == "customer_total" else margin_share
    depth = round_to_step(F.col("group_minimum_discount"), rounding)
    qualified = pairs.withColumn("offer_discount_depth", depth).filter(
        (F.col("group_churn_rate") <= F.lit(float(max_churn)))
        & (F.col("group_discount_share") <= F.lit(max_discount_share / 100))
        & (F.col("offer_discount_depth") < basis * F.lit(float(share)))
    )
    if affinity is not None:
        qualified = affinity(
            qualified.select(*PAIR, "group_purchase", "first", "last", "offer_discount_depth")
        )
    owner, other = ("customer_id", "group_id") if per == "customer" else ("group_id", "customer_id")
    best = W.partitionBy(owner).orderBy(
        F.col("group_affinity_index").desc_nulls_last(), F.col(other).asc()
    )
    return (
        qualified.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") == 1)
        .select(*PAIR, "group_affinity_index", "offer_discount_depth")
    )


def offers_average_check(
    tables: Tables,
    details: DataFrame,
    method: int,
    first: Moment | None = None,
    last: Moment | None = None,
    count: int = 0,
    coefficient: float = 0,
    max_churn: float = 0,
    max_discount_share: float = 0,
    margin_share: float = 0,
    *,
    margin_basis: str = "customer_total",
    price_margin: DataFrame | None = None,
    affinity: Affinity | None = None,
    mode: str = "spec",
) -> DataFrame:
    """Offers for a larger average check.

    method 1 takes the average check of a period, method 2 of the last `count`
    transactions. mode="as_written" rounds the discount down and rewards the
    best customer of each group.
    """
    if method == 1:
        checks = avg_check_by_period(tables, first, last, mode)
    elif method == 2:
        checks = avg_check_by_count(tables, count, mode)
    else:
        raise ValueError(f"method must be 1 or 2, not {method!r}")
    written = check_mode(mode) == "as_written"
    reward = reward_group(
        details,
        max_churn,
        max_discount_share,
        margin_share,
        per="group" if written else "customer",
        rounding="down" if written else "up",
        margin_basis=margin_basis,
        price_margin=price_margin,
        affinity=affinity,
    )
    return (
        checks.join(reward, "customer_id")
        .join(tables.groups_sku, "group_id")
        .select(
            "customer_id",
            (F.col("average_check") * F.lit(float(coefficient))).alias("required_check_measure"),
            "group_name",
            "offer_discount_depth",
        )
    )


def required_transactions(
    frequencies: DataFrame, start: Moment, end: Moment, added: int, mode: str = "spec"
) -> DataFrame:
    """Visits a customer has to make: those usual in the period, rounded, plus `added`.

    mode="as_written" subtracts the end from the start.
    """
    opening, closing = _moment(start), _moment(end)
    if check_mode(mode) == "as_written":
        opening, closing = closing, opening
    usual = F.round(ratio(days_between(opening, closing), "customer_frequency"))
    return frequencies.select(
        "customer_id",
        (usual.cast("long") + F.lit(int(added)).cast("long")).alias("required_transactions_count"),
    )


def offers_visit_frequency(
    tables: Tables,
    details: DataFrame,
    frequencies: DataFrame,
    start: Moment,
    end: Moment,
    added: int,
    max_churn: float,
    max_discount_share: float,
    margin_share: float,
    *,
    margin_basis: str = "price_list",
    affinity: Affinity | None = None,
    mode: str = "spec",
) -> DataFrame:
    """Offers for more visits in a period. `frequencies` holds customer_frequency."""
    reward = reward_group(
        details,
        max_churn,
        max_discount_share,
        margin_share,
        margin_basis=margin_basis,
        price_margin=group_price_margin(tables),
        affinity=affinity,
    )
    return (
        reward.join(required_transactions(frequencies, start, end, added, mode), "customer_id")
        .join(tables.groups_sku, "group_id")
        .select(
            "customer_id",
            _moment(start).alias("start_date"),
            _moment(end).alias("end_date"),
            "required_transactions_count",
            "group_name",
            "offer_discount_depth",
        )
    )
