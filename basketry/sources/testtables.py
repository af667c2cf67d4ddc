"""Maps the star-schema test tables to the eight input tables.

Derived columns only: every order is a transaction and every line item a check
line, none is left out. Discounts are shifted and stretched to 0, 4, ... 20 %
because the raw ones are non-zero nearly everywhere, and order dates get a time
of day. Every store lists every part.
"""

from __future__ import annotations

import posixpath
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.schema import Tables
from basketry.sources.files import as_text

STORES = 5


def load(spark: SparkSession, folder: str) -> Tables:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(posixpath.join(folder, f"{name}.parquet"))

    customer, orders, lineitem, part = map(table, ("customer", "orders", "lineitem", "part"))
    card = F.col("o_custkey") * 2 + F.col("o_orderkey") % 2
    moment = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.col("o_orderkey") * 7919 % 86400).cast("decimal(18,6)")
    )
    transactions = orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        card.alias("customer_card_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("transaction_summ"),
        moment.alias("transaction_datetime"),
        (F.col("o_orderkey") % STORES + 1).alias("transaction_store_id"),
    )

    summ = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.greatest(
        F.col("l_discount").cast("decimal(4,2)") - F.lit("0.05").cast("decimal(4,2)"),
        F.lit("0").cast("decimal(4,2)"),
    ) * F.lit(4).cast("decimal(1,0)")
    checks = lineitem.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("sku_amount"),
        summ.alias("sku_summ"),
        (summ * (F.lit(1).cast("decimal(1,0)") - rate)).alias("sku_summ_paid"),
        (summ * rate).alias("sku_discount"),
    )

    brand = F.regexp_extract("p_brand", r"\d+", 0).cast("long")
    retail = F.col("p_retailprice").cast("decimal(12,2)")
    store = F.col("transaction_store_id")
    markup = F.lit("0.55").cast("decimal(3,2)") + F.lit("0.05").cast("decimal(3,2)") * store.cast(
        "decimal(1,0)"
    )
    all_stores = F.array(*(F.lit(number).cast("long") for number in range(1, STORES + 1)))
    price_list = part.withColumn("transaction_store_id", F.explode(all_stores))

    key = F.col("c_custkey").cast("string")
    return Tables(
        personal_data=customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_name").alias("customer_surname"),
            F.concat(F.lit("customer"), key, F.lit("@example.com")).alias("customer_primary_email"),
            F.concat(F.lit("+7"), F.lpad(key, 10, "0")).alias("customer_primary_phone"),
        ),
        cards=orders.select(
            card.alias("customer_card_id"), F.col("o_custkey").alias("customer_id")
        ).distinct(),
        groups_sku=part.select(
            brand.alias("group_id"), F.col("p_brand").alias("group_name")
        ).distinct(),
        product_grid=part.select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            brand.alias("group_id"),
        ),
        stores=price_list.select(
            store,
            F.col("p_partkey").alias("sku_id"),
            (retail * markup).alias("sku_purchase_price"),
            retail.alias("sku_retail_price"),
        ),
        transactions=transactions,
        checks=checks,
        date_of_analysis_formation=transactions.agg(
            (
                F.max("transaction_datetime") + F.make_dt_interval(F.lit(1), F.lit(13))
            ).alias("analysis_formation")
        ),
    )


def misspelt(tables: Tables) -> Tables:
    """The same tables as text, with fields that cannot be read put in by key.

    Transactions: a moment in another format, a moment that does not exist, a sum that is no number.
    Check lines: an amount that is no number.
    """
    receipt = F.col("transaction_id")
    transactions = as_text(tables.transactions).withColumns(
        {
            "transaction_datetime": F.when(receipt % 97 == 0, "1998-01-31 10:00:00")
            .when(receipt % 97 == 1, "31.02.1998 10:00:00")
            .otherwise(F.col("transaction_datetime")),
            "transaction_summ": F.when(receipt % 101 == 0, "much").otherwise(F.col("transaction_summ")),
        }
    )
    checks = as_text(tables.checks).withColumn(
        "sku_amount", F.when(receipt % 103 == 0, "1.2.3").otherwise(F.col("sku_amount"))
    )
    return replace(tables, transactions=transactions, checks=checks)


def flawed(tables: Tables) -> Tables:
    """The same tables with faults of every kind put in by key: all rows stay, some occur twice.

    For the input checks: duplicate keys, dangling references, missing values, and names,
    addresses and numbers that break the written rules, the looser ones, or both.
    """

    def every(column: str, number: int, rest: int = 0) -> Column:
        return F.coalesce(F.col(column) % number == rest, F.lit(False))

    def doubled(df: DataFrame, which: Column) -> DataFrame:
        return df.unionByName(df.filter(which))

    person, card, sku = "customer_id", "customer_card_id", "sku_id"
    receipt, store = "transaction_id", "transaction_store_id"
    number = F.concat(F.lit("+7"), F.lpad(F.col(person).cast("string"), 10, "0"))
    people = tables.personal_data.withColumns(
        {
            "customer_name": F.when(every(person, 7), "anna")
            .when(every(person, 7, 1), "Anna-Maria")
            .when(~every(person, 7, 2), F.col("customer_name")),
            "customer_surname": F.when(every(person, 5), "Ёлкина").otherwise("Smith"),
            "customer_primary_email": F.when(every(person, 11), "nobody")
            .when(every(person, 11, 1), F.lit("a b@example.com"))
            .otherwise(F.col("customer_primary_email")),
            "customer_primary_phone": F.when(every(person, 13), F.lit("+7123456789"))
            .when(every(person, 13, 1), F.concat(number, F.lit("00")))
            .when(every(person, 13, 2), F.concat(number, F.lit("\n")))
            .otherwise(number),
        }
    )
    return Tables(
        personal_data=doubled(people, every(person, 50)),
        cards=doubled(
            tables.cards.withColumn(
                person, F.col(person) + F.when(every(card, 17), 10_000_000).otherwise(0)
            ),
            every(card, 19),
        ),
        groups_sku=doubled(
            tables.groups_sku.withColumn(
                "group_id", F.when(~every("group_id", 5), F.col("group_id"))
            ),
            every("group_id", 3),
        ),
        product_grid=doubled(
            tables.product_grid.withColumns(
                {
                    "group_id": F.col("group_id") + F.when(every(sku, 23), 1000).otherwise(0),
                    "sku_name": F.when(~every(sku, 29), F.col("sku_name")),
                }
            ),
            every(sku, 31),
        ),
        stores=doubled(
            tables.stores.withColumns(
                {
                    store: F.when(~(every(sku, 41) & (F.col(store) < 3)), F.col(store)),
                    sku: F.col(sku) + F.when(every(sku, 43), 1_000_000).otherwise(0),
                }
            ),
            every(sku, 37) & (F.col(store) == 1),
        ),
        transactions=doubled(
            tables.transactions.withColumns(
                {
                    card: F.col(card) + F.when(every(receipt, 103), 10_000_000).otherwise(0),
                    "transaction_datetime": F.when(
                        ~every(receipt, 107), F.col("transaction_datetime")
                    ),
                }
            ),
            every(receipt, 101),
        ),
        checks=tables.checks.withColumns(
            {
                receipt: F.col(receipt) + F.when(every(receipt, 109), 100_000_000).otherwise(0),
                sku: F.col(sku) + F.when(every(sku, 113), 1_000_000).otherwise(0),
            }
        ),
        date_of_analysis_formation=tables.date_of_analysis_formation,
    )
