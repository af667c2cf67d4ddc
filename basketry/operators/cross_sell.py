"""Personal offers for cross-selling: the most profitable SKU of a demanded group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.columns import check_mode, ratio, round_to_step
from basketry.operators.periods import PAIR
from basketry.schema import Tables


def _gain() -> Column:
    return F.col("sku_retail_price") - F.col("sku_purchase_price")


def cross_sell_groups(
    details: DataFrame,
    count: int,
    max_churn: float,
    max_stability: float,
    mode: str = "spec",
) -> DataFrame:
    """Up to `count` groups of highest affinity per customer, churn and stability permitting.

    mode="as_written" ranks inside each pair, where every rank is 1: all
    permitted groups stay if `count` is at least 1.
    """
    permitted = details.filter(
        (F.col("group_churn_rate") <= F.lit(float(max_churn)))
        & (F.col("group_stability_index") < F.lit(float(max_stability)))
    )
    if check_mode(mode) == "as_written":
        return permitted.filter(F.lit(count >= 1))
    best = W.partitionBy("customer_id").orderBy(
        F.col("group_affinity_index").desc_nulls_last(), F.col("group_id").asc()
    )
    return (
        permitted.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= count)
        .drop("place")
    )


def best_skus(tables: Tables) -> DataFrame:
    """The SKU of largest retail - purchase price of each store and group."""
    return (
        tables.stores.filter(_gain().isNotNull())
        .join(tables.product_grid.select("sku_id", "group_id"), "sku_id")
        .groupBy(F.col("transaction_store_id").alias("customer_primary_store"), "group_id")
        .agg(
            F.max_by(
                F.struct("sku_id", "sku_purchase_price", "sku_retail_price"),
                F.struct(_gain().alias("gain"), (-F.col("sku_id")).alias("tie")),
            ).alias("best")
        )
        .select("customer_primary_store", "group_id", "best.*")
    )


def max_margin_sku(tables: Tables, selected: DataFrame, stores: DataFrame) -> DataFrame:
    """The SKU of largest retail - purchase price of each selected group in the main store.

    The best SKU is found once per store and group, so customers meet one row
    each instead of every SKU of their groups. `stores` holds customer_primary_store.
    """
    return (
        selected.join(stores.select("customer_id", "customer_primary_store"), "customer_id")
        .join(best_skus(tables), ["customer_primary_store", "group_id"])
        .withColumn("max_margin", _gain())
    )


def sku_share(
    tables: Tables, history: DataFrame, skus: DataFrame, among: DataFrame | None = None
) -> DataFrame:
    """Add to each (customer, group, SKU) the share of the group's transactions with the SKU.

    `skus` has one row per pair and its group_purchase. The purchases of those
    pairs are looked up in the check lines by (transaction, SKU). `among`, if given,
    holds every sku_id of `skus`: the lines of all others are left out before they
    are moved.
    """
    purchases = history.select(*PAIR, "transaction_id").join(skus, PAIR)
    sold = tables.checks.select("transaction_id", "sku_id")
    if among is not None:
        sold = sold.join(among.select("sku_id").distinct(), "sku_id", "left_semi")
    own = [*PAIR, "sku_id"]
    # One row per pair comes in, so its other columns need not be part of the key.
    carried = [F.first(name).alias(name) for name in skus.columns if name not in own]
    return (
        purchases.join(
            sold.distinct().withColumn("sold", F.lit(1)), ["transaction_id", "sku_id"], "left"
        )
        .groupBy(*own)
        .agg(F.count("sold").alias("with_sku"), *carried)
        .withColumn("sku_share", ratio("with_sku", "group_purchase"))
        .drop("with_sku")
    )


def cross_sell_discount(margin_share: float) -> Column:
    """The rounded minimum discount in percent where the SKU's margin share covers it, else NULL."""
    depth = round_to_step(F.col("group_minimum_discount"))
    covered = F.lit(margin_share / 100) * ratio("max_margin", "sku_retail_price")
    return F.when(covered >= depth / F.lit(100.0), depth)


def offers_cross_sell(
    tables: Tables,
    history: DataFrame,
    details: DataFrame,
    stores: DataFrame,
    count: int,
    max_churn: float,
    max_stability: float,
    max_sku_share: float,
    margin_share: float,
) -> DataFrame:
    """Offers that move a customer to the SKU of largest margin in a demanded group."""
    selected = cross_sell_groups(details, count, max_churn, max_stability)
    skus = max_margin_sku(tables, selected, stores).withColumn(
        "offer_discount_depth", cross_sell_discount(margin_share)
    )
    # The discount test needs no facts, so it goes before the share.
    covered = skus.filter(F.col("offer_discount_depth").isNotNull())
    shares = sku_share(tables, history, covered, best_skus(tables))
    return (
        shares.filter(F.col("sku_share") <= F.lit(max_sku_share / 100))
        .join(tables.product_grid.select("sku_id", "sku_name"), "sku_id")
        .select("customer_id", "sku_name", "offer_discount_depth")
    )


def max_margin_as_written(tables: Tables, selected: DataFrame, stores: DataFrame) -> DataFrame:
    """Selected pairs with the largest margin that any product of the main store has in any store.

    The largest margin is found once per product and once per store; it is the same for all
    groups of a customer. Customers whose main store lists no known product drop out.
    """
    listed = tables.stores.join(tables.product_grid.select("sku_id"), "sku_id", "left_semi")
    anywhere = listed.groupBy("sku_id").agg(F.max(_gain()).alias("gain"))
    largest = (
        listed.join(anywhere, "sku_id")
        .groupBy(F.col("transaction_store_id").alias("customer_primary_store"))
        .agg(F.max("gain").alias("max_margin"))
    )
    return selected.join(stores.select("customer_id", "customer_primary_store"), "customer_id").join(
        largest, "customer_primary_store"
    )


def share_repeats_as_written(
    tables: Tables, history: DataFrame, selected: DataFrame, max_sku_share: float
) -> DataFrame:
    """How often the SQL repeats each offer of a customer; customers without offers have no row.

    A product counts the lines it has in receipts of selected groups, once per such group. Of a
    customer, every different count meets the number of purchases of every selected group, and
    each meeting whose quotient is within the limit repeats all offers. Meetings are counted on one
    ordered line of the different values per customer, never formed: values that differ
    add up to the customer's lines, so a customer with n lines has about sqrt(2 n) of them.
    """
    receipts = (
        history.select(*PAIR, "transaction_id")
        .join(selected.select(*PAIR), PAIR, "left_semi")
        .groupBy("customer_id", "transaction_id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    counts = (
        tables.checks.select("transaction_id", "sku_id")
        .join(receipts, "transaction_id")
        .groupBy("customer_id", "sku_id")
        .agg(F.sum("times").alias("count_sku"))
        .select("customer_id", "count_sku")
        .distinct()
    )
    groups = selected.groupBy("customer_id", "group_purchase").agg(F.count(F.lit(1)).alias("groups"))
    values = counts.select(
        "customer_id", (F.col("count_sku") * F.lit(100.0)).alias("at"), F.lit(0).cast("long").alias("groups")
    ).unionByName(
        groups.select("customer_id", (F.col("group_purchase") * F.lit(float(max_sku_share))).alias("at"), "groups")
    )
    # From above, groups before products of the same value.
    line = W.partitionBy("customer_id").orderBy(F.col("at").desc(), F.col("groups").desc())
    above = F.sum("groups").over(line.rowsBetween(W.unboundedPreceding, 0))
    return (
        values.withColumn("above", above)
        .filter((F.col("groups") == 0) & (F.col("above") > 0))
        .groupBy("customer_id")
        .agg(F.sum("above").alias("repeats"))
    )


def offers_cross_sell_counted(
    tables: Tables,
    history: DataFrame,
    selected: DataFrame,
    stores: DataFrame,
    max_sku_share: float,
    margin_share: float,
) -> DataFrame:
    """Offers as the SQL forms them, each with the number of its rows in `repeats`.

    Every product of a selected group that the main store lists is offered; its depth is NULL
    where the margin does not cover it. `selected` is read twice.
    """
    reached = max_margin_as_written(tables, selected, stores)
    repeats = share_repeats_as_written(tables, history, reached, max_sku_share)
    listed = tables.product_grid.join(
        tables.stores.select(
            "sku_id", F.col("transaction_store_id").alias("customer_primary_store"), "sku_retail_price"
        ),
        "sku_id",
    )
    return (
        reached.join(repeats, "customer_id")
        .join(listed, ["customer_primary_store", "group_id"])
        .select(
            "customer_id",
            "sku_name",
            cross_sell_discount(margin_share).alias("offer_discount_depth"),
            "repeats",
        )
    )


def spread(offers: DataFrame) -> DataFrame:
    """Each offer as many times as `repeats` says, in steps that keep the lists short."""
    step = 1024
    rest = F.least(F.lit(step), F.col("repeats") - F.col("from"))
    return (
        offers.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1, F.lit(step).cast("long"))))
        .withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), rest)))
        .drop("from", "again", "repeats")
    )
