"""Purchase history: what a customer paid for each product group in each transaction."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import check_mode, month_number, ratio
from basketry.functions.ranking import latest_per_key
from basketry.schema import MONTH, Tables
from basketry.session import part_of, passes

HISTORY_KEY = ["customer_id", "transaction_id", "transaction_datetime", "group_id"]


def analysis_moment(tables: Tables) -> Column:
    """The analysis date as a scalar subquery; it fails unless the table holds exactly one."""
    dates = tables.date_of_analysis_formation.select("analysis_formation")
    single = F.count(F.lit(1)) == 1
    return dates.agg(
        F.when(single, F.min("analysis_formation")).otherwise(
            F.raise_error(
                F.concat(F.lit("analysis dates must be one, not "), F.count(F.lit(1)).cast("string"))
            ).cast("timestamp_ntz")
        )
    ).scalar()


def first_moment(tables: Tables) -> Column:
    """Moment of the earliest transaction, a scalar subquery; by month, of the first month that has one."""
    transactions = tables.transactions
    if tables.by_month:
        earliest = transactions.agg(F.min(MONTH)).scalar()
        transactions = transactions.filter(F.col(MONTH) == earliest)
    return transactions.agg(F.min("transaction_datetime")).scalar()


def in_period(tables: Tables, start: Column, end: Column) -> Tables:
    """Only receipts between two moments, both included; lines at least of these.

    Where the facts are laid out by month, other months are not read, neither receipts nor lines:
    start and end may be values or scalar subqueries, which prune folders at run time. Lines of other
    receipts, or of none, may stay; they meet no receipt.
    """
    transactions, checks = tables.transactions, tables.checks
    if tables.by_month:
        months = F.col(MONTH).between(month_number(start), month_number(end))
        transactions = transactions.filter(months)
        checks = checks.filter(months | F.col(MONTH).isNull())
    transactions = transactions.filter(F.col("transaction_datetime").between(start, end))
    return replace(tables, transactions=transactions, checks=checks)


def receipt_parts(tables: Tables) -> list[Tables]:
    """The same tables with the receipts, and their lines, dealt to as many parts as the lines are worth.

    No receipt is in two parts, so the histories of the parts make up the history.
    """
    receipt = "transaction_id"
    one_type = tables.checks.schema[receipt].dataType == tables.transactions.schema[receipt].dataType
    parts = passes(tables.checks) if one_type else 1
    if parts == 1:
        return [tables]
    return [
        replace(
            tables,
            transactions=part_of(tables.transactions, receipt, number, parts),
            checks=part_of(tables.checks, receipt, number, parts),
        )
        for number in range(parts)
    ]


def card_transactions(tables: Tables) -> DataFrame:
    """Transactions with their customer. A customer may hold several cards."""
    return tables.transactions.join(tables.cards, "customer_card_id").select(
        "customer_id",
        "transaction_id",
        "transaction_datetime",
        "transaction_store_id",
        "transaction_summ",
    )


def latest_visits(tables: Tables, count: int) -> DataFrame:
    """Each customer's `count` most recent transactions. Cards without an owner are nobody's."""
    visits = tables.transactions.join(tables.cards, "customer_card_id")
    return latest_per_key(
        visits, ["customer_id"], "transaction_datetime", "transaction_id", count
    )


def _receipt_lines(tables: Tables) -> DataFrame:
    """Check lines of known customers with store and moment."""
    people = tables.personal_data.select("customer_id")
    known = tables.cards.join(people, "customer_id", "left_semi")
    visits = tables.transactions.join(known, "customer_card_id").select(
        "customer_id", "transaction_id", "transaction_datetime", "transaction_store_id"
    )
    return tables.checks.join(visits, "transaction_id")


def purchase_history(tables: Tables) -> DataFrame:
    """Cost, retail sum and paid sum per customer, transaction and group.

    The cost uses the price list of the store of the transaction; lines without
    a price there drop out. Prices and groups are put together first, so that the
    lines meet both in one join.
    """
    prices = tables.stores.select("transaction_store_id", "sku_id", "sku_purchase_price").join(
        tables.product_grid.select("sku_id", "group_id"), "sku_id"
    )
    return (
        _receipt_lines(tables)
        .join(prices, ["sku_id", "transaction_store_id"])
        .groupBy(*HISTORY_KEY)
        .agg(
            F.sum(F.col("sku_purchase_price") * F.col("sku_amount")).alias("group_cost"),
            F.sum("sku_summ").alias("group_summ"),
            F.sum("sku_summ_paid").alias("group_summ_paid"),
        )
    )


def discounted_history(tables: Tables, mode: str = "spec") -> DataFrame:
    """Purchase history plus two discount measures of each row.

    line_discount_min: smallest non-zero discount rate, NULL if none.
    discount_count: 1 if the group was bought at a discount in the transaction, else 0.

    The measures look at every check line of the group, priced or not, so prices are joined
    on the left, by product and store, and rows without any priced line are dropped after
    the aggregation; the facts are read once for both. A product listed in very many stores
    meets as many rows as it has stores, and one with very many lines is split by store.
    mode="as_written" looks at all lines of the transaction, whatever their
    group, and counts lines instead of transactions.
    """
    rate = F.when(F.col("sku_discount") != 0, ratio("sku_discount", "sku_summ"))
    discounted = F.col("sku_discount") > 0

    if check_mode(mode) == "as_written":
        whole_receipts = tables.checks.groupBy("transaction_id").agg(
            F.min(rate).alias("line_discount_min"),
            F.count(F.when(discounted, 1)).alias("discount_count"),
        )
        return purchase_history(tables).join(whole_receipts, "transaction_id")

    # One row per product and store: how many prices there are, and their sum.
    kind = tables.stores.schema["sku_purchase_price"].dataType
    listed = (
        tables.stores.filter(F.col("transaction_store_id").isNotNull())
        .select("sku_id", "transaction_store_id", "sku_purchase_price")
        # Hardly a price is listed twice: moved as they are, they fill no map task's hash table.
        .repartition("sku_id", "transaction_store_id")
        .groupBy("sku_id", "transaction_store_id")
        .agg(
            # Short, so that money keeps its places in the product.
            F.count(F.lit(1)).cast("decimal(10,0)").alias("times"),
            F.sum("sku_purchase_price").cast(kind).alias("price"),
        )
    )
    times = F.col("times")
    return (
        _receipt_lines(tables)
        .join(tables.product_grid.select("sku_id", "group_id"), "sku_id")
        .join(listed, ["sku_id", "transaction_store_id"], "left")
        .groupBy(*HISTORY_KEY)
        .agg(
            F.sum(F.col("price") * F.col("sku_amount")).alias("group_cost"),
            F.sum(F.col("sku_summ") * times).alias("group_summ"),
            F.sum(F.col("sku_summ_paid") * times).alias("group_summ_paid"),
            F.min(rate).alias("line_discount_min"),
            F.max(F.when(discounted, 1).otherwise(0)).cast("long").alias("discount_count"),
            F.max(times).alias("priced"),
        )
        .filter(F.col("priced").isNotNull())
        .drop("priced")
    )


def plain_history(history: DataFrame) -> DataFrame:
    """The purchase-history columns of a history that carries discount measures."""
    return history.select(*HISTORY_KEY, "group_cost", "group_summ", "group_summ_paid")
