"""Offers and the group table as SQL table functions with defaults and named arguments.

Each function is one SELECT over views of the derived tables, so what is called with plain values is
planned as if it had been written out: a method that is not asked for leaves no trace in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import STEP_TOLERANCE
from basketry.operators import cross_sell, customers
from basketry.operators.history import card_transactions
from basketry.operators.periods import PAIR
from basketry.workspace import Workspace

_DEPTH = f"ceil(group_minimum_discount * 20 - {STEP_TOLERANCE}) * 5D"

# The group each customer is rewarded in: {basis} is the margin, {share} the part of it to give away.
_REWARD = f"""
  qualified AS (
    SELECT customer_id, group_id, group_affinity_index, {_DEPTH} AS depth FROM {{pairs}}
    WHERE group_churn_rate <= max_churn AND group_discount_share <= max_discount_share / 100
      AND {_DEPTH} < {{basis}} * ({{share}})
  ), ranked AS (
    SELECT *, row_number() OVER (
      PARTITION BY customer_id ORDER BY group_affinity_index DESC NULLS LAST, group_id) AS place FROM qualified
  ), reward AS (
    SELECT customer_id, group_name, depth FROM ranked JOIN {{groups}} USING (group_id) WHERE place = 1
  )"""

FUNCTIONS = {
    "offers_average_check": """(
  method INT, first_day DATE DEFAULT NULL, last_day DATE DEFAULT NULL, last_visits INT DEFAULT 0,
  coefficient DOUBLE DEFAULT 0, max_churn DOUBLE DEFAULT 0, max_discount_share DOUBLE DEFAULT 0,
  margin_share DOUBLE DEFAULT 0
) RETURNS TABLE (customer_id BIGINT, required_check_measure DOUBLE, group_name STRING, offer_discount_depth DOUBLE)
RETURN WITH begun AS (
    SELECT CASE WHEN first_day >= opening THEN CAST(first_day AS TIMESTAMP_NTZ) ELSE opening END AS start,
      CAST(last_day AS TIMESTAMP_NTZ) + INTERVAL 1 DAY - INTERVAL 0.000001 SECOND AS wanted, closing FROM {bounds}
  ), period AS (
    SELECT start, CASE WHEN wanted > start AND wanted <= closing THEN wanted ELSE closing END AS finish FROM begun
  ), placed AS (
    SELECT *, row_number() OVER (PARTITION BY customer_id
      ORDER BY transaction_datetime DESC NULLS LAST, transaction_id DESC NULLS LAST) AS recent FROM {visits}
  ), checks AS (
    SELECT customer_id, try_divide(CAST(sum(summ) AS DOUBLE), CAST(count(summ) AS DOUBLE)) AS average_check
    FROM placed WHERE (method = 2 AND recent <= last_visits) OR (method = 1
      AND transaction_datetime BETWEEN (SELECT start FROM period) AND (SELECT finish FROM period))
    GROUP BY customer_id HAVING count(summ) > 0
  ),"""
    + _REWARD.replace("{basis}", "CAST(group_margin AS DOUBLE)").replace("{share}", "margin_share / 100")
    + """
SELECT customer_id, average_check * coefficient, group_name, depth FROM checks JOIN reward USING (customer_id)""",
    "offers_visit_frequency": """(
  first_day DATE, last_day DATE, added INT DEFAULT 0, max_churn DOUBLE DEFAULT 0,
  max_discount_share DOUBLE DEFAULT 0, margin_share DOUBLE DEFAULT 0
) RETURNS TABLE (customer_id BIGINT, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ,
  required_transactions_count BIGINT, group_name STRING, offer_discount_depth DOUBLE)
RETURN WITH required AS (
    SELECT customer_id, CAST(round(try_divide(CAST(datediff(last_day, first_day) AS DOUBLE), customer_frequency))
      AS BIGINT) + added AS visits FROM {frequencies}
  ),"""
    + _REWARD.replace("{basis}", "average_margin").replace("{share}", "margin_share")
    + """
SELECT customer_id, CAST(first_day AS TIMESTAMP_NTZ), CAST(last_day AS TIMESTAMP_NTZ), visits, group_name, depth
FROM reward JOIN required USING (customer_id)""",
    "offers_cross_sell": f"""(
  groups_each INT, max_churn DOUBLE DEFAULT 0, max_stability DOUBLE DEFAULT 0, max_sku_share DOUBLE DEFAULT 0,
  margin_share DOUBLE DEFAULT 0
) RETURNS TABLE (customer_id BIGINT, sku_name STRING, offer_discount_depth DOUBLE)
RETURN WITH ranked AS (
    SELECT *, row_number() OVER (
      PARTITION BY customer_id ORDER BY group_affinity_index DESC NULLS LAST, group_id) AS place
    FROM {{skus}} WHERE group_churn_rate <= max_churn AND group_stability_index < max_stability
  )
SELECT customer_id, sku_name, {_DEPTH} FROM ranked
WHERE place <= groups_each AND sku_share <= max_sku_share / 100
  AND margin_share / 100 * try_divide(CAST(max_margin AS DOUBLE), CAST(sku_retail_price AS DOUBLE)) >= {_DEPTH} / 100""",
    "groups_by_margin": """(method INT DEFAULT 0, number INT DEFAULT 1)
RETURNS TABLE (customer_id BIGINT, group_id BIGINT, group_affinity_index DOUBLE, group_churn_rate DOUBLE,
  group_stability_index DOUBLE, group_margin DOUBLE, group_discount_share DOUBLE, group_minimum_discount DOUBLE,
  group_average_discount DOUBLE)
RETURN WITH placed AS (
    SELECT *, row_number() OVER (PARTITION BY customer_id, group_id
      ORDER BY transaction_datetime DESC NULLS LAST, transaction_id DESC NULLS LAST) AS recent FROM {purchases}
  ), margins AS (
    SELECT customer_id, group_id, sum(margin) AS margin FROM placed
    WHERE method = 0 OR (method = 2 AND recent <= number) OR (method = 1 AND transaction_datetime
      BETWEEN (SELECT closing FROM {bounds}) - make_dt_interval(number) AND (SELECT closing FROM {bounds}))
    GROUP BY customer_id, group_id
  )
SELECT customer_id, group_id, group_affinity_index, group_churn_rate, group_stability_index, CAST(margin AS DOUBLE),
  group_discount_share, group_minimum_discount, group_average_discount
FROM {pairs} LEFT JOIN margins USING (customer_id, group_id)""",
}


def _views(ws: Workspace) -> dict[str, DataFrame]:
    tables = ws.tables
    receipts = tables.checks.groupBy("transaction_id").agg(F.sum("sku_summ").alias("summ"))
    visits = card_transactions(tables).dropna(subset=["customer_id"])
    stores = customers.primary_store(tables, ws.mode)
    details = ws.stored_details()
    pairs = details.join(ws.price_margin, "group_id", "left")
    best = cross_sell.max_margin_sku(tables, details, stores)
    best = cross_sell.sku_share(tables, ws.history, best, cross_sell.best_skus(tables))
    best = best.select(*PAIR, "sku_id", "sku_share", "max_margin", "sku_retail_price")
    names = tables.product_grid.select("sku_id", "sku_name")
    return {
        "bounds": tables.transactions.agg(F.min("transaction_datetime").alias("opening")).withColumn(
            "closing", ws.analysis
        ),
        "visits": visits.join(receipts, "transaction_id", "left").select(
            "customer_id", "transaction_id", "transaction_datetime", "summ"
        ),
        "pairs": pairs,
        "groups": tables.groups_sku,
        "frequencies": customers.customer_frequency(tables),
        # Groups without a product on sale still take their place in the ranking.
        "skus": details.join(best, PAIR, "left").join(names, "sku_id", "left"),
        "purchases": ws.history.select(
            *PAIR, "transaction_id", "transaction_datetime",
            (F.col("group_summ_paid") - F.col("group_cost")).alias("margin"),
        ),
    }


def register_functions(ws: Workspace, prefix: str = "") -> None:
    """Temporary table functions, for the rules of mode "spec", and the views they stand on.

    offers_average_check, offers_visit_frequency, offers_cross_sell and groups_by_margin, each name with
    the prefix. The history is written down first; functions are of no use after ws.close().
    """
    if ws.mode != "spec":
        raise ValueError("the table functions follow the written rules: use a workspace of mode 'spec'")
    ws.store_history()
    spark = ws.tables.checks.sparkSession
    named = {}
    for name, df in _views(ws).items():
        named[name] = f"{prefix}offer_{name}"
        df.createOrReplaceTempView(named[name])
    for name, text in FUNCTIONS.items():
        for view, full in named.items():
            text = text.replace(f"{{{view}}}", full)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{text}")
