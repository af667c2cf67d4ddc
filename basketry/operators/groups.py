"""Measures of a customer's relation to a product group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.columns import (
    MICROS_PER_DAY,
    check_mode,
    hour_bucket,
    micros_between,
    purchase_interval,
    ratio,
    whole_days_between,
)
from basketry.functions.ranking import latest_per_key
from basketry.operators.history import (
    analysis_moment,
    card_transactions,
    in_period,
    purchase_history,
)
from basketry.operators.periods import PAIR
from basketry.schema import Tables

GROUP_COLUMNS = [
    *PAIR,
    "group_affinity_index",
    "group_churn_rate",
    "group_stability_index",
    "group_margin",
    "group_discount_share",
    "group_minimum_discount",
    "group_average_discount",
]

_SUMS = ["purchases", "group_margin", "group_summ", "group_summ_paid", "discount_count"]


def demanded_groups(tables: Tables) -> DataFrame:
    """Customer-group pairs found in the check lines, priced or not."""
    products = tables.product_grid.select("sku_id", "group_id")
    bought = tables.checks.select("transaction_id", "sku_id").join(products, "sku_id")
    buyers = card_transactions(tables).select("customer_id", "transaction_id")
    return bought.join(buyers, "transaction_id").select(*PAIR).distinct()


def _measured(history: DataFrame, margin_from: Column | None = None) -> DataFrame:
    """History rows as one-purchase summaries, ready to be combined to any coarser grain."""
    margin = F.col("group_summ_paid") - F.col("group_cost")
    if margin_from is not None:
        margin = F.when(margin_from, margin)
    return history.select(
        *PAIR,
        "transaction_id",
        "transaction_datetime",
        F.lit(1).cast("long").alias("purchases"),
        F.col("transaction_datetime").alias("first"),
        F.col("transaction_datetime").alias("last"),
        margin.alias("group_margin"),
        "group_summ",
        "group_summ_paid",
        "discount_count",
        "line_discount_min",
    )


def _combined() -> list[Column]:
    """Aggregates that merge summaries into a coarser summary with the same columns."""
    return [
        *(F.sum(name).alias(name) for name in _SUMS),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("line_discount_min").alias("line_discount_min"),
    ]


def _pair_totals(history: DataFrame, margin_from: Column | None = None) -> DataFrame:
    """What needs no order along the time line: one aggregation with map-side combine."""
    measured = _measured(history, margin_from).filter(F.col("group_id").isNotNull())
    return measured.groupBy(*PAIR).agg(*_combined())


def _hourly(measured: DataFrame, mode: str) -> DataFrame:
    """Summaries per customer, clock hour and group, with places among the customer's visits.

    Whatever follows a customer's or a pair's time line is done in two steps,
    inside one hour and then over the hours. A customer who makes a large part
    of all purchases is so spread over as many tasks as there are hours.

    upto, before: the customer's transactions in this hour up to the group's
    last purchase in it, and before its first one. visits: all transactions of
    the hour, given once per customer and hour and 0 elsewhere.
    """
    hour = W.partitionBy("customer_id", "hour")
    instant = W.partitionBy("customer_id", "hour", "transaction_datetime")
    in_order = hour.orderBy("transaction_datetime", "transaction_id")
    # Dense ranks count a transaction once, row numbers once per group in it.
    place = F.dense_rank() if check_mode(mode) == "spec" else F.row_number()
    carrier = F.min("group_id").over(hour).eqNullSafe(F.col("group_id"))
    return (
        measured.withColumn("hour", hour_bucket("transaction_datetime"))
        .withColumn("place", place.over(in_order).cast("long"))
        .withColumns(
            {
                "upto": F.max("place").over(instant),
                "before": F.min("place").over(instant) - 1,
                "visits": F.when(carrier, F.max("place").over(hour)).otherwise(0),
            }
        )
        .groupBy("customer_id", "hour", "group_id")
        .agg(
            *_combined(),
            F.max("upto").alias("upto"),
            F.min("before").alias("before"),
            F.max("visits").alias("visits"),
        )
    )


def _pairs_and_visits(hourly: DataFrame) -> DataFrame:
    """One row per pair, and one per customer and clock hour with the visits up to it.

    Both come from one reading of the hours: each row goes to its pair, and the
    row that carries the visits of the hour also goes to the customer's line of
    hours, which has no group. So the rows are dealt by customer and group, and a customer
    who makes a large part of all purchases is spread over his groups.

    Stability is the mean of |gap - f| / f over the gaps in whole days, f being
    the average interval T / n. In integers that is
    sum |gap * n - T| / (T * (n - 1)), with one division at the end. A gap inside
    a clock hour is zero whole days and contributes T.
    """
    line = F.col("on_line")
    copies = F.array_compact(
        F.array(
            # Products without a group count as visits but make no pair.
            F.when(F.col("group_id").isNotNull(), F.lit(False)),
            F.when(F.col("visits") > 0, F.lit(True)),
        )
    )
    rows = hourly.withColumn("on_line", F.explode(copies)).withColumn(
        "group_id", F.when(~line, F.col("group_id"))
    )
    part = W.partitionBy(*PAIR)
    in_order = part.orderBy("hour")
    wide = "decimal(38,0)"
    gap_days = whole_days_between(F.col("previous"), F.col("first")).cast("decimal(18,0)")
    gap = (gap_days * F.lit(MICROS_PER_DAY).cast("decimal(12,0)") * F.col("total")).cast(wide)
    outer_gap = F.coalesce(F.abs(gap - F.col("span")), F.lit(0).cast(wide))
    inner_gaps = (F.col("purchases") - 1).cast("decimal(18,0)") * F.col("span")
    span = micros_between(F.min("first").over(part), F.max("last").over(part))
    rows = rows.withColumns(
        {
            "previous": F.lag("last").over(in_order),
            "past": F.coalesce(
                F.sum("visits").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
            "total": F.sum("purchases").over(part).cast("decimal(18,0)"),
            "span": (span + F.lit(MICROS_PER_DAY)).cast("decimal(18,0)"),
        }
    )
    return rows.groupBy(*PAIR, "on_line", F.when(line, F.col("hour")).alias("line_hour")).agg(
        *_combined(),
        F.min("hour").alias("first_hour"),
        F.max("hour").alias("last_hour"),
        F.min_by("before", "hour").alias("before"),
        F.max_by("upto", "hour").alias("upto"),
        F.sum(outer_gap + inner_gaps).alias("deviation"),
        F.max("span").alias("span"),
        F.max(F.when(line, F.col("past"))).alias("past"),
    )


def _with_places(rows: DataFrame) -> DataFrame:
    """The pairs, with the customer's visits before their first hour and before their last one.

    Each pair asks twice on the customer's line of hours. A task so sees of a customer
    one row per hour and two per group.
    """
    own = [n for n in rows.columns if n not in (*PAIR, "on_line", "line_hour", "past")]
    is_line, which = F.col("on_line"), F.col("which")
    asked = F.when(is_line, F.array("line_hour")).otherwise(F.array("first_hour", "last_hour"))
    known = F.max("past").over(W.partitionBy("customer_id", "at"))
    # The measures of a pair travel with its first question only.
    return (
        rows.select(*PAIR, "on_line", "past", *own, F.posexplode(asked).alias("which", "at"))
        .select(
            *PAIR, "on_line", "which", "at", "past",
            *(F.when(which == 0, F.col(name)).alias(name) for name in own),
        )
        .withColumn("past", known)
        .filter(~is_line)
        .groupBy(*PAIR)
        .agg(
            *(F.max(name).alias(name) for name in own),
            F.max(F.when(which == 0, F.col("past"))).alias("past_first"),
            F.max(F.when(which == 1, F.col("past"))).alias("past_last"),
        )
    )


def group_profile(
    history: DataFrame,
    analysis: Column,
    mode: str = "spec",
    margin_from: Column | None = None,
) -> DataFrame:
    """All measures of every customer-group pair, also of pairs with one purchase."""
    hourly = _hourly(_measured(history, margin_from), mode)
    pairs = _with_places(_pairs_and_visits(hourly))
    visits = F.col("past_last") + F.col("upto") - F.col("past_first") - F.col("before")
    return pairs.select(
        *PAIR,
        F.col("purchases").alias("group_purchase"),
        ratio(F.col("purchases"), visits).alias("group_affinity_index"),
        _churn_rate(analysis).alias("group_churn_rate"),
        ratio("deviation", F.col("span") * (F.col("purchases") - 1)).alias("group_stability_index"),
        "group_margin",
        _discount_share().alias("group_discount_share"),
        F.col("line_discount_min").alias("group_minimum_discount"),
        ratio("group_summ_paid", "group_summ").alias("group_average_discount"),
        "group_summ_paid",
    )


def pair_candidates(history: DataFrame, analysis: Column, min_purchases: int = 2) -> DataFrame:
    """What an offer asks of a pair before its affinity, from one aggregation without a time line.

    `first` and `last` are the bounds that `with_affinity` counts the customer's visits between.
    """
    return (
        _pair_totals(history)
        .filter(F.col("purchases") >= min_purchases)
        .select(
            *PAIR,
            F.col("purchases").alias("group_purchase"),
            _churn_rate(analysis).alias("group_churn_rate"),
            "group_margin",
            _discount_share().alias("group_discount_share"),
            F.col("line_discount_min").alias("group_minimum_discount"),
            "group_summ_paid",
            "first",
            "last",
        )
    )


def with_affinity(pairs: DataFrame, history: DataFrame, mode: str = "spec") -> DataFrame:
    """Adds group_affinity_index to pairs that have group_purchase, first and last.

    `pairs` is read twice. Only visits of customers who still have a pair are laid on a time
    line: the history is cut to them before any of it is moved for that. A pair asks for the
    visits before its first purchase and up to its last one; its questions and the visits are
    ranked together inside (customer, clock hour). Behind that a customer has one row per hour
    and two per pair, which add up along the hours; nothing else is dealt by customer alone.
    """
    moment = F.col("transaction_datetime")
    visits = history.select(
        "customer_id", "transaction_id", moment.alias("at"), hour_bucket(moment).alias("hour")
    ).join(pairs.select("customer_id").distinct(), "customer_id", "left_semi")
    # At one moment: first purchases ask before the visits, last ones behind them.
    begin, visit, end = 0, 1, 2
    question = F.explode(
        F.array(
            F.struct(F.lit(begin).alias("kind"), F.col("first").alias("at")),
            F.struct(F.lit(end).alias("kind"), F.col("last").alias("at")),
        )
    )
    others = [name for name in pairs.columns if name not in (*PAIR, "first", "last")]
    asked = pairs.select(*PAIR, *others, question.alias("asked")).select(
        *PAIR, *others, "asked.kind", "asked.at", hour_bucket("asked.at").alias("hour")
    )
    events = asked.unionByName(visits.withColumn("kind", F.lit(visit)), allowMissingColumns=True)
    kind = F.col("kind")
    hour = W.partitionBy("customer_id", "hour")
    in_order = hour.orderBy("at", "kind", "transaction_id")
    counted = kind == visit
    if check_mode(mode) == "spec":
        # A transaction has a row per group and counts once.
        again = (F.lag("kind").over(in_order) == visit) & (
            F.lag(F.struct("at", "transaction_id")).over(in_order) == F.struct("at", "transaction_id")
        )
        counted = counted & ~F.coalesce(again, F.lit(False))
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    line = W.partitionBy("customer_id").orderBy("hour").rangeBetween(W.unboundedPreceding, -1)
    sign = F.when(kind == end, 1).otherwise(-1)
    return (
        events.withColumn("counted", counted.cast("long"))
        .withColumn("seen", F.sum("counted").over(so_far))
        .withColumn("place", F.row_number().over(in_order))
        .withColumn("visits", F.when(F.col("place") == 1, F.sum("counted").over(hour)))
        .filter((kind != visit) | F.col("visits").isNotNull())
        .withColumn("past", F.coalesce(F.sum("visits").over(line), F.lit(0)))
        .filter(kind != visit)
        .groupBy(*PAIR)
        .agg(
            *(F.first(name).alias(name) for name in others),
            F.sum(sign * (F.col("past") + F.col("seen"))).alias("visits"),
        )
        .withColumn("group_affinity_index", ratio(F.col("group_purchase"), F.col("visits")))
        .drop("visits")
    )


def _churn_rate(analysis: Column) -> Column:
    """Whole days since the last purchase over the average interval of purchases."""
    interval = purchase_interval(F.col("first"), F.col("last"), F.col("purchases"))
    return ratio(whole_days_between(F.col("last"), analysis), interval)


def _discount_share() -> Column:
    """NULL, not 0, where nothing was discounted."""
    return ratio(F.nullif(F.col("discount_count"), F.lit(0)), "purchases")


def affinity_index(history: DataFrame, analysis: Column, mode: str = "spec") -> DataFrame:
    return group_profile(history, analysis, mode).select(*PAIR, "group_affinity_index")


def stability_index(history: DataFrame, analysis: Column) -> DataFrame:
    """Only pairs bought at least twice have an interval and so a stability."""
    return (
        group_profile(history, analysis)
        .filter(F.col("group_purchase") > 1)
        .select(*PAIR, "group_stability_index")
    )


def group_churn_rate(history: DataFrame, analysis: Column) -> DataFrame:
    return _pair_totals(history).select(*PAIR, _churn_rate(analysis).alias("group_churn_rate"))


def discount_share(history: DataFrame) -> DataFrame:
    return _pair_totals(history).select(*PAIR, _discount_share().alias("group_discount_share"))


def minimum_discount(history: DataFrame) -> DataFrame:
    return _pair_totals(history).select(
        *PAIR, F.col("line_discount_min").alias("group_minimum_discount")
    )


def average_discount(history: DataFrame) -> DataFrame:
    """Paid over retail sum: 1 means no discount at all."""
    return _pair_totals(history).select(
        *PAIR, ratio("group_summ_paid", "group_summ").alias("group_average_discount")
    )


def _since(analysis: Column, days: int) -> Column:
    """Purchases in the given number of days up to the analysis date, both ends included."""
    start = analysis - F.make_dt_interval(F.lit(days))
    return F.col("transaction_datetime").between(start, analysis)


def _among_first(history: DataFrame, number: int) -> Column:
    """Whether a pair is one of the first `number` by customer and group.

    The last key that still counts is a scalar subquery: an ordered limit over the keys, of
    which every task sends `number` at most. No row of the history is moved for it twice.
    """
    pair = F.struct(*PAIR)
    named = history.select(*PAIR).filter(F.col("group_id").isNotNull())
    keys = named.distinct().orderBy(*PAIR).limit(number)
    return pair <= keys.agg(F.max(pair)).scalar()


def _check_margin_method(method: int) -> None:
    if method not in (0, 1, 2):
        raise ValueError(f"the margin method must be 0, 1 or 2, not {method!r}")


def group_margin(
    history: DataFrame, analysis: Column, method: int = 0, number: int = 1, mode: str = "spec"
) -> DataFrame:
    """Paid minus cost per pair.

    method 0: all history; 1: the last `number` days before the analysis date;
    2: the last `number` transactions of the pair. Pairs without such a
    purchase have NULL.
    mode="as_written", method 2: all history, but only for the first `number` pairs by
    customer and group; all others have NULL.
    """
    _check_margin_method(method)
    if method == 2 and check_mode(mode) == "as_written":
        kept = F.when(_among_first(history, number), F.col("group_margin"))
        return _pair_totals(history).select(*PAIR, kept.alias("group_margin"))
    if method == 0:
        return _pair_totals(history).select(*PAIR, "group_margin")
    if method == 1:
        return _pair_totals(history, _since(analysis, number)).select(*PAIR, "group_margin")
    latest = latest_per_key(history, PAIR, "transaction_datetime", "transaction_id", number)
    return _pair_totals(latest).select(*PAIR, "group_margin")


def recent_margin(tables: Tables, days: int) -> DataFrame:
    """Paid minus cost of the last `days` days before the analysis date, for pairs bought in them.

    The rows of group_margin, method 1, that have a margin. Needs no older purchase, so
    facts laid out by month are read for the months of the window only.
    """
    analysis = analysis_moment(tables)
    start = analysis - F.make_dt_interval(F.lit(days))
    history = purchase_history(in_period(tables, start, analysis))
    margin = F.sum(F.col("group_summ_paid") - F.col("group_cost")).alias("group_margin")
    return history.filter(F.col("group_id").isNotNull()).groupBy(*PAIR).agg(margin)


def groups(
    history: DataFrame,
    analysis: Column,
    margin_method: int = 0,
    margin_number: int = 1,
    mode: str = "spec",
    min_purchases: int = 2,
) -> DataFrame:
    """The group table. Pairs bought once drop out unless min_purchases=1 keeps them."""
    return group_details(
        history, analysis, margin_method, margin_number, mode, min_purchases
    ).select(*GROUP_COLUMNS)


def group_details(
    history: DataFrame,
    analysis: Column,
    margin_method: int = 0,
    margin_number: int = 1,
    mode: str = "spec",
    min_purchases: int = 2,
    whole: DataFrame | None = None,
) -> DataFrame:
    """The group table with the number of purchases and the paid sum of each pair.

    `history` may hold some of the customers only; `whole` is then the history of all.
    """
    _check_margin_method(margin_method)
    window = _since(analysis, margin_number) if margin_method == 1 else None
    pairs = group_profile(history, analysis, mode, window).filter(
        F.col("group_purchase") >= min_purchases
    )
    if margin_method == 2 and check_mode(mode) == "as_written":
        # Pairs that drop out above count among the first ones.
        first = _among_first(history if whole is None else whole, margin_number)
        pairs = pairs.withColumn("group_margin", F.when(first, F.col("group_margin")))
    elif margin_method == 2:
        margins = group_margin(history, analysis, 2, margin_number)
        pairs = pairs.drop("group_margin").join(margins, PAIR, "left")
    return pairs.select(*GROUP_COLUMNS, "group_purchase", "group_summ_paid")
