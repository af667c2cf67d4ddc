"""Customer segments by average check, visit frequency and churn, and the main store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.columns import (
    SECONDS_PER_DAY,
    check_mode,
    days_between,
    ratio,
    seconds_between,
)
from basketry.functions.ranking import Cut, latest_per_key, rank_cuts
from basketry.operators.history import analysis_moment, card_transactions, latest_visits
from basketry.schema import Tables
from basketry.session import written

# Ranks up to 10 % and 35 % bound the first two segments.
SEGMENT_PERCENTS = [10, 35]
CHECK_SEGMENTS = ["High", "Medium", "Low"]
FREQUENCY_SEGMENTS = ["Often", "Occasionally", "Rarely"]
CHURN_LOW_UP_TO = 2
CHURN_MEDIUM_UP_TO = 5
LAST_VISITS = 3

# Segment numbers count up from Low/Rarely/Low; churn varies fastest, check slowest.
CHECK_CODE = {"Low": 0, "Medium": 1, "High": 2}
FREQUENCY_CODE = {"Rarely": 0, "Occasionally": 1, "Often": 2}
CHURN_CODE = {"Low": 0, "Medium": 1, "High": 2}


def _visit_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("visits"),
        F.sum("transaction_summ").alias("turnover"),
        F.min("transaction_datetime").alias("first_visit"),
        F.max("transaction_datetime").alias("last_visit"),
    ]


def _merged_sums() -> list[Column]:
    return [
        F.sum("visits").alias("visits"),
        F.sum("turnover").alias("turnover"),
        F.min("first_visit").alias("first_visit"),
        F.max("last_visit").alias("last_visit"),
    ]


def _customer_sums(tables: Tables, *by: str) -> DataFrame:
    """Visit sums per customer (and store), summed per card before the cards are joined.

    The transactions are so reduced on the map side, and neither the join nor
    the second sum sees more than a row per card and store.
    """
    per_card = tables.transactions.groupBy("customer_card_id", *by).agg(*_visit_sums())
    # A card without an owner makes no customer.
    owned = tables.cards.filter(F.col("customer_id").isNotNull())
    return (
        per_card.join(owned, "customer_card_id")
        .groupBy("customer_id", *by)
        .agg(*_merged_sums())
    )


def _average_check() -> Column:
    return ratio("turnover", "visits").alias("customer_average_check")


def _frequency() -> Column:
    span = seconds_between(F.col("first_visit"), F.col("last_visit"))
    return ratio(span, F.col("visits") * F.lit(SECONDS_PER_DAY)).alias("customer_frequency")


def _inactive(tables: Tables) -> Column:
    return days_between(F.col("last_visit"), analysis_moment(tables)).alias(
        "customer_inactive_period"
    )


def _with_churn(measures: DataFrame) -> DataFrame:
    """Churn rate and segment; a single visit means frequency 0, so rate NULL and High."""
    rate = F.col("customer_churn_rate")
    segment = (
        F.when(rate.between(0, CHURN_LOW_UP_TO), "Low")
        .when((rate > CHURN_LOW_UP_TO) & (rate <= CHURN_MEDIUM_UP_TO), "Medium")
        .otherwise("High")
    )
    return measures.withColumn(
        "customer_churn_rate", ratio("customer_inactive_period", "customer_frequency")
    ).withColumn("customer_churn_segment", segment)


BY_CHECK = Cut("customer_average_check", SEGMENT_PERCENTS, CHECK_SEGMENTS, descending=True)
BY_FREQUENCY = Cut("customer_frequency", SEGMENT_PERCENTS, FREQUENCY_SEGMENTS)


def average_check(tables: Tables) -> DataFrame:
    totals = written(_customer_sums(tables).select("customer_id", _average_check()))
    (label,), _ = rank_cuts(totals, "customer_id", [BY_CHECK])
    return totals.withColumn("customer_average_check_segment", label)


def visit_frequency(tables: Tables) -> DataFrame:
    totals = written(_customer_sums(tables).select("customer_id", _frequency()))
    (label,), _ = rank_cuts(totals, "customer_id", [BY_FREQUENCY])
    return totals.withColumn("customer_frequency_segment", label)


def inactive_period(tables: Tables) -> DataFrame:
    return _customer_sums(tables).select(
        "customer_id", _inactive(tables)
    )


def customer_churn(tables: Tables) -> DataFrame:
    measures = _customer_sums(tables).select(
        "customer_id", _inactive(tables), _frequency()
    )
    return _with_churn(measures).select(
        "customer_id", "customer_churn_rate", "customer_churn_segment"
    )


def _code(segment: str, codes: dict[str, int]) -> Column:
    column = F.lit(None).cast("long")
    for text, code in codes.items():
        column = F.when(F.col(segment) == text, F.lit(code).cast("long")).otherwise(column)
    return column


def _number_segments(customers: DataFrame, population: int, mode: str) -> DataFrame:
    """Add customer_segment from the three segment columns.

    mode="as_written" numbers only combinations of segments that occur, takes the
    churn values from the check segments, and so loses customers whose churn
    segment no check segment shares. Which segments occur follows from the rank
    cuts alone: `population` is the number of ranked customers.
    """
    check, frequency, churn = CHECK_CODE, FREQUENCY_CODE, CHURN_CODE
    if check_mode(mode) == "as_written":
        top, middle = (population * percent // 100 for percent in SEGMENT_PERCENTS)
        sizes = [population - middle, middle - top, top]

        def occurring(codes: dict[str, int]) -> dict[str, int]:
            texts = [text for text, code in codes.items() if sizes[code] > 0]
            return {text: place for place, text in enumerate(texts)}

        check, frequency, churn = occurring(check), occurring(frequency), occurring(churn)

    number = (
        (
            _code("customer_average_check_segment", check) * len(frequency)
            + _code("customer_frequency_segment", frequency)
        )
        * len(churn)
        + _code("customer_churn_segment", churn)
        + 1
    )
    numbered = customers.withColumn("customer_segment", number)
    return numbered if mode == "spec" else numbered.filter(F.col("customer_segment").isNotNull())


def segment_number(tables: Tables, mode: str = "spec") -> DataFrame:
    return customers(tables, mode).select(
        "customer_id",
        "customer_average_check_segment",
        "customer_frequency_segment",
        "customer_churn_segment",
        "customer_segment",
    )


def store_share(tables: Tables) -> DataFrame:
    """Share of each store in a customer's transactions."""
    total = F.sum("visits").over(W.partitionBy("customer_id"))
    return _customer_sums(tables, "transaction_store_id").select(
        "customer_id", "transaction_store_id", ratio(F.col("visits"), total).alias("store_share")
    )


def last_three_stores(tables: Tables, mode: str = "spec") -> DataFrame:
    """Stores and moments of the three latest visits of each customer.

    mode="as_written" takes the latest moments of anybody in the customer's
    stores; three moments per store are enough for that.
    """
    if check_mode(mode) == "spec":
        return latest_visits(tables, LAST_VISITS).select(
            "customer_id", "transaction_store_id", "transaction_datetime"
        )
    busy = latest_per_key(
        tables.transactions.select("transaction_store_id", "transaction_datetime").distinct(),
        ["transaction_store_id"],
        "transaction_datetime",
        "transaction_store_id",
        LAST_VISITS,
    )
    own = card_transactions(tables).select("customer_id", "transaction_store_id").distinct()
    return latest_per_key(
        own.join(busy, "transaction_store_id"),
        ["customer_id"],
        "transaction_datetime",
        "transaction_store_id",
        LAST_VISITS,
    ).select("customer_id", "transaction_store_id", "transaction_datetime")


def _with_primary_store(tables: Tables, by_store: DataFrame, mode: str) -> DataFrame:
    """Customer sums with the main store, from the sums by store.

    One store in the three latest visits wins; else the store with the largest
    share; among equal shares the one visited last (mode="as_written": visited
    last by anybody).
    """
    if check_mode(mode) == "as_written":
        anybody = tables.transactions.groupBy("transaction_store_id").agg(
            F.max("transaction_datetime").alias("seen")
        )
        by_store = by_store.join(anybody, "transaction_store_id")
    else:
        by_store = by_store.withColumn("seen", F.col("last_visit"))

    sums = by_store.groupBy("customer_id").agg(
        *_merged_sums(),
        F.max(F.struct("visits", "seen", "transaction_store_id")).alias("favourite"),
    )
    recent = last_three_stores(tables, mode).groupBy("customer_id").agg(
        F.min("transaction_store_id").alias("low"), F.max("transaction_store_id").alias("high")
    )
    store = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("favourite.transaction_store_id")
    )
    return sums.join(recent, "customer_id").withColumn("customer_primary_store", store)


def primary_store(tables: Tables, mode: str = "spec") -> DataFrame:
    by_store = _customer_sums(tables, "transaction_store_id")
    return _with_primary_store(tables, by_store, mode).select(
        "customer_id", "customer_primary_store"
    )


def customers(tables: Tables, mode: str = "spec") -> DataFrame:
    """All customer measures, one row per customer with at least one transaction.

    Calling this runs jobs: the sums per customer and store are written, a row per pair in
    place of the transactions, and where the 10 % and 35 % of the customers end is found
    in them at once. The table itself is as lazy as any other.
    """
    by_store = written(_customer_sums(tables, "transaction_store_id"))
    profile = _with_primary_store(tables, by_store, mode).select(
        "customer_id",
        _average_check(),
        _frequency(),
        _inactive(tables),
        "customer_primary_store",
    )
    totals = (
        by_store.groupBy("customer_id")
        .agg(*_merged_sums())
        .select("customer_id", _average_check(), _frequency())
    )
    (check, frequency), population = rank_cuts(totals, "customer_id", [BY_CHECK, BY_FREQUENCY])
    segmented = _with_churn(profile).withColumns(
        {"customer_average_check_segment": check, "customer_frequency_segment": frequency}
    )
    return _number_segments(segmented, population, mode).select(
        "customer_id",
        "customer_average_check",
        "customer_average_check_segment",
        "customer_frequency",
        "customer_frequency_segment",
        "customer_inactive_period",
        "customer_churn_rate",
        "customer_churn_segment",
        "customer_segment",
        "customer_primary_store",
    )


def customer_frequency(tables: Tables) -> DataFrame:
    """Days between visits without the segments, which alone need a ranking."""
    return _customer_sums(tables).select("customer_id", _frequency())
