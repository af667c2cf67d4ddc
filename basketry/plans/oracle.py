"""The registered queries once more, as plain SQL over the test tables (DuckDB dialect).

Each statement is put together from the named steps below, only those it needs.
The steps are written for clarity, with joins and counts where the operators use
running totals, and share no code with them.
"""

from __future__ import annotations

import re

STEPS: dict[str, str] = {}

# --- the eight inputs ---------------------------------------------------------

STEPS["personal_data"] = """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_name AS customer_surname,
       'customer' || c_custkey || '@example.com' AS customer_primary_email,
       '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_primary_phone
FROM customer"""
STEPS["cards"] = """
SELECT DISTINCT o_custkey * 2 + o_orderkey % 2 AS customer_card_id, o_custkey AS customer_id
FROM orders"""
STEPS["groups_sku"] = """
SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS group_id, p_brand AS group_name
FROM part"""
STEPS["product_grid"] = """
SELECT p_partkey AS sku_id, p_name AS sku_name,
       CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS group_id
FROM part"""
STEPS["stores"] = """
SELECT s.store AS transaction_store_id, p_partkey AS sku_id,
       CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.55 + 0.05 * s.store AS DECIMAL(4,2)) AS sku_purchase_price,
       CAST(p_retailprice AS DECIMAL(12,2)) AS sku_retail_price
FROM part CROSS JOIN (SELECT unnest(range(1, 6)) AS store) s"""
STEPS["transactions"] = """
SELECT o_orderkey AS transaction_id, o_custkey * 2 + o_orderkey % 2 AS customer_card_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS transaction_summ,
       o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS transaction_datetime,
       o_orderkey % 5 + 1 AS transaction_store_id
FROM orders"""
STEPS["checks"] = """
SELECT transaction_id, sku_id, sku_amount, sku_summ,
       sku_summ * CAST(1 - rate AS DECIMAL(4,2)) AS sku_summ_paid, sku_summ * rate AS sku_discount
FROM (SELECT l_orderkey AS transaction_id, l_partkey AS sku_id,
             CAST(l_quantity AS DECIMAL(12,2)) AS sku_amount,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS sku_summ,
             CAST(greatest(CAST(l_discount AS DECIMAL(4,2)) - 0.05, 0) * 4 AS DECIMAL(4,2)) AS rate
      FROM lineitem)"""
STEPS["analysis"] = """
SELECT max(transaction_datetime) + INTERVAL 1 DAY + INTERVAL 13 HOUR AS moment FROM transactions"""

# --- purchase history and periods ---------------------------------------------

STEPS["visits"] = """
SELECT c.customer_id, t.transaction_id, t.transaction_datetime, t.transaction_store_id, t.transaction_summ
FROM transactions t JOIN cards c USING (customer_card_id)"""
STEPS["bought"] = """
SELECT v.customer_id, v.transaction_id, v.transaction_datetime, v.transaction_store_id, g.group_id,
       l.sku_id, l.sku_amount, l.sku_summ, l.sku_summ_paid
FROM checks l
JOIN visits v ON v.transaction_id = l.transaction_id
JOIN personal_data p ON p.customer_id = v.customer_id
JOIN product_grid g ON g.sku_id = l.sku_id"""
STEPS["ph"] = """
SELECT b.customer_id, b.transaction_id, b.transaction_datetime, b.group_id,
       sum(s.sku_purchase_price * b.sku_amount) AS group_cost,
       sum(b.sku_summ) AS group_summ, sum(b.sku_summ_paid) AS group_summ_paid
FROM bought b
JOIN stores s ON s.sku_id = b.sku_id AND s.transaction_store_id = b.transaction_store_id
GROUP BY ALL"""
STEPS["rates"] = """
SELECT h.customer_id, h.group_id, l.transaction_id, l.sku_discount,
       CAST(l.sku_discount AS DOUBLE) / nullif(CAST(l.sku_summ AS DOUBLE), 0) AS rate
FROM ph h JOIN checks l ON l.transaction_id = h.transaction_id
JOIN product_grid g ON g.sku_id = l.sku_id AND g.group_id = h.group_id"""
STEPS["rates_as_written"] = """
SELECT h.customer_id, h.group_id, l.transaction_id, l.sku_discount,
       CAST(l.sku_discount AS DOUBLE) / nullif(CAST(l.sku_summ AS DOUBLE), 0) AS rate
FROM ph h JOIN checks l ON l.transaction_id = h.transaction_id"""
for mode in ("", "_as_written"):
    STEPS["least" + mode] = f"""
SELECT customer_id, group_id, min(rate) AS least FROM rates{mode} WHERE sku_discount <> 0 GROUP BY ALL"""
    STEPS["periods" + mode] = f"""
SELECT b.customer_id, b.group_id, first_group_purchase_date, last_group_purchase_date, group_purchase,
       ((epoch_us(last_group_purchase_date) - epoch_us(first_group_purchase_date)) / 1e6 / 86400.0 + 1)
           / group_purchase AS group_frequency,
       coalesce(d.least, 0) AS group_min_discount
FROM (SELECT customer_id, group_id, min(transaction_datetime) AS first_group_purchase_date,
             max(transaction_datetime) AS last_group_purchase_date, count(*) AS group_purchase
      FROM ph GROUP BY ALL) b
LEFT JOIN least{mode} d USING (customer_id, group_id)"""

# --- customers ----------------------------------------------------------------

STEPS["totals"] = """
SELECT customer_id, CAST(sum(transaction_summ) AS DOUBLE) / count(*) AS customer_average_check,
       (epoch_us(max(transaction_datetime)) - epoch_us(min(transaction_datetime))) / 1e6
           / (count(*) * 86400) AS customer_frequency,
       (epoch_us(any_value(a.moment)) - epoch_us(max(transaction_datetime))) / 1e6 / 86400.0
           AS customer_inactive_period
FROM visits CROSS JOIN analysis a GROUP BY customer_id"""
STEPS["check_segment"] = """
SELECT customer_id, customer_average_check,
       CASE WHEN place <= n * 10 // 100 THEN 'High' WHEN place <= n * 35 // 100 THEN 'Medium' ELSE 'Low' END
           AS customer_average_check_segment
FROM (SELECT *, count(*) OVER () AS n,
             row_number() OVER (ORDER BY customer_average_check DESC, customer_id) AS place FROM totals)"""
STEPS["frequency_segment"] = """
SELECT customer_id, customer_frequency,
       CASE WHEN place <= n * 10 // 100 THEN 'Often' WHEN place <= n * 35 // 100 THEN 'Occasionally'
            ELSE 'Rarely' END AS customer_frequency_segment
FROM (SELECT *, count(*) OVER () AS n,
             row_number() OVER (ORDER BY customer_frequency, customer_id) AS place FROM totals)"""
STEPS["churn"] = """
SELECT customer_id, customer_churn_rate,
       CASE WHEN customer_churn_rate BETWEEN 0 AND 2 THEN 'Low'
            WHEN customer_churn_rate > 2 AND customer_churn_rate <= 5 THEN 'Medium'
            ELSE 'High' END AS customer_churn_segment
FROM (SELECT customer_id, customer_inactive_period / nullif(customer_frequency, 0) AS customer_churn_rate
      FROM totals)"""
STEPS["levels"] = """
SELECT * FROM (VALUES ('Low', 'Rarely', 0), ('Medium', 'Occasionally', 1), ('High', 'Often', 2))
    AS levels(size, pace, code)"""
STEPS["segments"] = """
SELECT s.customer_id, customer_average_check_segment, customer_frequency_segment, customer_churn_segment,
       CAST(9 * a.code + 3 * b.code + c.code + 1 AS BIGINT) AS customer_segment
FROM check_segment s JOIN frequency_segment f USING (customer_id) JOIN churn h USING (customer_id)
JOIN levels a ON a.size = customer_average_check_segment
JOIN levels b ON b.pace = customer_frequency_segment
JOIN levels c ON c.size = customer_churn_segment"""
STEPS["segments_as_written"] = """
SELECT s.customer_id, customer_average_check_segment, customer_frequency_segment, customer_churn_segment,
       CAST(k.number AS BIGINT) AS customer_segment
FROM check_segment s JOIN frequency_segment f USING (customer_id) JOIN churn h USING (customer_id)
JOIN (SELECT a.size AS a, b.pace AS b, c.size AS c, row_number() OVER (ORDER BY a.code, b.code, c.code) AS number
      FROM levels a, levels b, levels c
      WHERE a.size IN (SELECT customer_average_check_segment FROM check_segment)
        AND c.size IN (SELECT customer_average_check_segment FROM check_segment)
        AND b.pace IN (SELECT customer_frequency_segment FROM frequency_segment)) k
  ON k.a = customer_average_check_segment AND k.b = customer_frequency_segment
 AND k.c = customer_churn_segment"""
STEPS["shares"] = """
SELECT customer_id, transaction_store_id, count(*) / sum(count(*)) OVER (PARTITION BY customer_id) AS store_share,
       max(transaction_datetime) AS last_visit
FROM visits GROUP BY customer_id, transaction_store_id"""
STEPS["last_three"] = """
SELECT customer_id, transaction_store_id, transaction_datetime FROM visits
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY transaction_datetime DESC, transaction_id DESC) <= 3"""
STEPS["last_three_as_written"] = """
SELECT customer_id, transaction_store_id, transaction_datetime
FROM (SELECT DISTINCT customer_id, transaction_store_id FROM visits)
JOIN (SELECT DISTINCT transaction_store_id, transaction_datetime FROM visits
      QUALIFY dense_rank() OVER (PARTITION BY transaction_store_id ORDER BY transaction_datetime DESC) <= 3)
    USING (transaction_store_id)
QUALIFY row_number() OVER (PARTITION BY customer_id
                           ORDER BY transaction_datetime DESC, transaction_store_id DESC) <= 3"""
STEPS["favourite"] = """
SELECT customer_id, transaction_store_id AS store FROM shares
QUALIFY row_number() OVER (PARTITION BY customer_id
                           ORDER BY store_share DESC, last_visit DESC, transaction_store_id DESC) = 1"""
STEPS["favourite_as_written"] = """
SELECT customer_id, transaction_store_id AS store
FROM shares JOIN (SELECT transaction_store_id, max(transaction_datetime) AS seen FROM visits GROUP BY 1)
    USING (transaction_store_id)
QUALIFY row_number() OVER (PARTITION BY customer_id
                           ORDER BY store_share DESC, seen DESC, transaction_store_id DESC) = 1"""
for mode in ("", "_as_written"):
    STEPS["primary_store" + mode] = f"""
SELECT r.customer_id, CASE WHEN r.low = r.high THEN r.low ELSE f.store END AS customer_primary_store
FROM (SELECT customer_id, min(transaction_store_id) AS low, max(transaction_store_id) AS high
      FROM last_three{mode} GROUP BY customer_id) r
JOIN favourite{mode} f USING (customer_id)"""
    STEPS["customers" + mode] = f"""
SELECT customer_id, t.customer_average_check, s.customer_average_check_segment, t.customer_frequency,
       s.customer_frequency_segment, customer_inactive_period, customer_churn_rate,
       s.customer_churn_segment, customer_segment, customer_primary_store
FROM totals t JOIN segments{mode} s USING (customer_id) JOIN churn USING (customer_id)
JOIN primary_store{mode} USING (customer_id)"""

# --- groups -------------------------------------------------------------------

STEPS["demanded"] = """
SELECT DISTINCT v.customer_id, g.group_id
FROM checks l JOIN visits v USING (transaction_id) JOIN product_grid g USING (sku_id)"""
for mode, counted in (("", "count(DISTINCT h.transaction_id)"), ("_as_written", "count(h.transaction_id)")):
    STEPS["affinity" + mode] = f"""
SELECT p.customer_id, p.group_id,
       CAST(p.group_purchase AS DOUBLE) / {counted} AS group_affinity_index
FROM periods p JOIN ph h ON h.customer_id = p.customer_id
 AND h.transaction_datetime BETWEEN p.first_group_purchase_date AND p.last_group_purchase_date
GROUP BY p.customer_id, p.group_id, p.group_purchase"""
    STEPS["discounts" + mode] = f"""
SELECT p.customer_id, p.group_id,
       CAST(nullif({counted.replace("h.", "r.")}, 0) AS DOUBLE) / p.group_purchase AS group_discount_share
FROM periods p LEFT JOIN (SELECT * FROM rates{mode} WHERE sku_discount > 0) r USING (customer_id, group_id)
GROUP BY p.customer_id, p.group_id, p.group_purchase"""
    STEPS["minimum" + mode] = f"""
SELECT customer_id, group_id, nullif(group_min_discount, 0) AS group_minimum_discount FROM periods{mode}"""
STEPS["group_churn"] = """
SELECT customer_id, group_id,
       date_sub('day', last_group_purchase_date, a.moment) / group_frequency AS group_churn_rate
FROM periods CROSS JOIN analysis a"""
STEPS["gaps"] = """
SELECT customer_id, group_id,
       date_sub('day', lag(transaction_datetime) OVER (PARTITION BY customer_id, group_id
                                                        ORDER BY transaction_datetime, transaction_id),
                transaction_datetime) AS gap
FROM ph"""
STEPS["stability"] = """
SELECT customer_id, group_id,
       CAST(sum(abs(CAST(gap AS HUGEINT) * 86400000000 * n - span)) AS DOUBLE)
           / CAST(any_value(span) * (any_value(n) - 1) AS DOUBLE) AS group_stability_index
FROM gaps
JOIN (SELECT customer_id, group_id, group_purchase AS n,
             CAST(epoch_us(last_group_purchase_date) - epoch_us(first_group_purchase_date) + 86400000000
                  AS HUGEINT) AS span
      FROM periods) USING (customer_id, group_id)
WHERE gap IS NOT NULL
GROUP BY customer_id, group_id"""
STEPS["margin"] = """
SELECT customer_id, group_id, CAST(sum(group_summ_paid - group_cost) AS DOUBLE) AS group_margin
FROM ph GROUP BY ALL"""
STEPS["margin_days"] = """
SELECT customer_id, group_id,
       CAST(sum(group_summ_paid - group_cost)
            FILTER (WHERE transaction_datetime BETWEEN a.moment - to_days({days}) AND a.moment) AS DOUBLE)
           AS group_margin
FROM ph CROSS JOIN analysis a GROUP BY customer_id, group_id"""
STEPS["margin_recent"] = """
SELECT customer_id, group_id, CAST(sum(group_summ_paid - group_cost) AS DOUBLE) AS group_margin
FROM ph CROSS JOIN analysis a
WHERE transaction_datetime BETWEEN a.moment - to_days({days}) AND a.moment
GROUP BY customer_id, group_id"""
STEPS["margin_last"] = """
SELECT customer_id, group_id, CAST(sum(group_summ_paid - group_cost) AS DOUBLE) AS group_margin
FROM (SELECT * FROM ph
      QUALIFY row_number() OVER (PARTITION BY customer_id, group_id
                                 ORDER BY transaction_datetime DESC, transaction_id DESC) <= {last})
GROUP BY ALL"""
STEPS["margin_first"] = """
SELECT customer_id, group_id, CASE WHEN place <= {first_pairs} THEN group_margin END AS group_margin
FROM (SELECT *, row_number() OVER (ORDER BY customer_id, group_id) AS place FROM margin)"""
STEPS["average"] = """
SELECT customer_id, group_id, CAST(sum(group_summ_paid) AS DOUBLE) / CAST(sum(group_summ) AS DOUBLE)
           AS group_average_discount
FROM ph GROUP BY ALL"""


def _groups(mode: str, margin: str, stability: str = "JOIN") -> str:
    return f"""
SELECT customer_id, group_id, group_affinity_index, group_churn_rate, group_stability_index, group_margin,
       group_discount_share, group_minimum_discount, group_average_discount
FROM demanded JOIN affinity{mode} USING (customer_id, group_id)
JOIN group_churn USING (customer_id, group_id) {stability} stability USING (customer_id, group_id)
JOIN {margin} USING (customer_id, group_id) JOIN discounts{mode} USING (customer_id, group_id)
JOIN minimum{mode} USING (customer_id, group_id) JOIN average USING (customer_id, group_id)"""


STEPS["groups"] = _groups("", "margin")
STEPS["groups_as_written"] = _groups("_as_written", "margin")
STEPS["groups_all"] = _groups("", "margin", "LEFT JOIN")
STEPS["groups_days"] = _groups("", "margin_days")
STEPS["groups_last"] = _groups("", "margin_last")
STEPS["groups_first"] = _groups("_as_written", "margin_first")

# --- offers -------------------------------------------------------------------

# An end given as a date includes its day.
STEPS["bounds"] = """
SELECT first, CASE WHEN wanted <= first OR wanted > moment THEN moment ELSE wanted END AS last
FROM (SELECT greatest(min(transaction_datetime), TIMESTAMP '{first_day}') AS first,
             TIMESTAMP '{last_day}' + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS wanted FROM transactions), analysis"""
STEPS["bounds_as_written"] = """
SELECT first, CASE WHEN TIMESTAMP '{last_day}' <= first OR TIMESTAMP '{last_day}' > moment
                   THEN date_trunc('day', moment) ELSE TIMESTAMP '{last_day}' END AS last
FROM (SELECT CASE WHEN TIMESTAMP '{first_day}' < min(transaction_datetime)
                  THEN date_trunc('day', min(transaction_datetime)) ELSE TIMESTAMP '{first_day}' END AS first
      FROM transactions), analysis"""
STEPS["latest_visits"] = """
SELECT * FROM visits
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY transaction_datetime DESC, transaction_id DESC) <= {visits}"""
for mode, counted in (("", "count(DISTINCT transaction_id)"), ("_as_written", "count(*)")):
    STEPS["check_by_period" + mode] = f"""
SELECT customer_id, CAST(sum(sku_summ) AS DOUBLE) / {counted} AS average_check
FROM visits JOIN checks USING (transaction_id)
JOIN bounds{mode} b ON transaction_datetime BETWEEN b.first AND b.last
GROUP BY customer_id"""
    STEPS["check_by_count" + mode] = f"""
SELECT customer_id, CAST(sum(sku_summ) AS DOUBLE) / {counted} AS average_check
FROM latest_visits JOIN checks USING (transaction_id) GROUP BY customer_id"""
STEPS["price_margin"] = """
SELECT group_id, CAST(sum(sku_retail_price - sku_purchase_price) AS DOUBLE)
           / CAST(sum(sku_retail_price) AS DOUBLE) AS average_margin
FROM stores JOIN product_grid USING (sku_id) GROUP BY group_id"""
STEPS["paid"] = """
SELECT customer_id, group_id, CAST(sum(group_summ_paid) AS DOUBLE) AS paid FROM ph GROUP BY ALL"""


def _reward(groups: str, allowed: str, rounding: str, owner: str, other: str) -> str:
    steps = {"up": "ceil(group_minimum_discount * 20 - 1e-9)", "down": "floor(group_minimum_discount * 20 + 1e-9)"}
    return f"""
SELECT customer_id, group_id, group_affinity_index, offer_discount_depth
FROM (SELECT *, {steps[rounding]} * 5 AS offer_discount_depth
      FROM {groups} JOIN price_margin USING (group_id) JOIN paid USING (customer_id, group_id))
WHERE group_churn_rate <= {{max_churn}} AND group_discount_share <= {{max_share}} / 100.0
  AND offer_discount_depth < {allowed}
QUALIFY row_number() OVER (PARTITION BY {owner} ORDER BY group_affinity_index DESC, {other}) = 1"""


_TOTAL = "group_margin * ({margin_share} / 100.0)"
_LIST = "average_margin * {margin_share}"
_RATIO = "group_margin / nullif(paid, 0) * {margin_share}"
STEPS["reward_total"] = _reward("groups", _TOTAL, "up", "customer_id", "group_id")
STEPS["reward_list"] = _reward("groups", _LIST, "up", "customer_id", "group_id")
STEPS["reward_ratio"] = _reward("groups", _RATIO, "up", "customer_id", "group_id")
STEPS["reward_total_as_written"] = _reward("groups_as_written", _TOTAL, "down", "group_id", "customer_id")
STEPS["reward_list_as_written"] = _reward("groups_as_written", _LIST, "up", "customer_id", "group_id")


def _check_offer(checks: str, reward: str) -> str:
    return f"""
SELECT customer_id, average_check * {{coefficient}} AS required_check_measure, group_name, offer_discount_depth
FROM {checks} JOIN {reward} USING (customer_id) JOIN groups_sku USING (group_id)"""


for mode in ("", "_as_written"):
    span = ("{visit_start}", "{visit_end}") if mode == "" else ("{visit_end}", "{visit_start}")
    STEPS["required" + mode] = f"""
SELECT customer_id,
       CAST(round(date_diff('second', TIMESTAMP '{span[0]}', TIMESTAMP '{span[1]}') / 86400.0
                  / nullif(customer_frequency, 0)) AS BIGINT) + {{added}} AS required_transactions_count
FROM totals"""
    STEPS["visit_offer" + mode] = f"""
SELECT customer_id, TIMESTAMP '{{visit_start}}' AS start_date, TIMESTAMP '{{visit_end}}' AS end_date,
       required_transactions_count, group_name, offer_discount_depth
FROM reward_list{mode} JOIN required{mode} USING (customer_id) JOIN groups_sku USING (group_id)"""

STEPS["selected_as_written"] = """
SELECT customer_id, group_id, group_affinity_index, group_minimum_discount FROM groups_as_written
WHERE group_churn_rate <= {cross_churn} AND group_stability_index < {cross_stability}"""
STEPS["selected"] = """
SELECT customer_id, group_id, group_affinity_index, group_minimum_discount FROM groups
WHERE group_churn_rate <= {cross_churn} AND group_stability_index < {cross_stability}
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY group_affinity_index DESC, group_id) <= {cross_groups}"""
STEPS["listed"] = """
SELECT s.transaction_store_id AS customer_primary_store, g.group_id, g.sku_id, g.sku_name,
       s.sku_retail_price - s.sku_purchase_price AS margin, s.sku_retail_price
FROM stores s JOIN product_grid g USING (sku_id)"""
STEPS["best_sku"] = """
SELECT c.customer_id, c.group_id, l.sku_id, l.sku_name, c.group_minimum_discount, m.customer_primary_store,
       l.margin AS max_margin, l.sku_retail_price
FROM selected c JOIN primary_store m USING (customer_id)
JOIN (SELECT *, row_number() OVER (PARTITION BY customer_primary_store, group_id
                                   ORDER BY margin DESC, sku_id) AS place FROM listed) l
  ON l.customer_primary_store = m.customer_primary_store AND l.group_id = c.group_id
WHERE l.place = 1"""
STEPS["sku_shares"] = """
SELECT b.customer_id, b.group_id, b.sku_id,
       CAST(count(DISTINCT l.transaction_id) AS DOUBLE) / count(DISTINCT h.transaction_id) AS sku_share
FROM best_sku b JOIN ph h ON h.customer_id = b.customer_id AND h.group_id = b.group_id
LEFT JOIN checks l ON l.transaction_id = h.transaction_id AND l.sku_id = b.sku_id
GROUP BY ALL"""
STEPS["depths"] = """
SELECT customer_id, group_id, sku_id, sku_name,
       CASE WHEN {margin_share} / 100.0 * (CAST(max_margin AS DOUBLE) / CAST(sku_retail_price AS DOUBLE))
                 >= ceil(group_minimum_discount * 20 - 1e-9) * 5 / 100.0
            THEN ceil(group_minimum_discount * 20 - 1e-9) * 5 END AS offer_discount_depth
FROM best_sku"""

# Cross-selling as written, joins and repeated rows included.
STEPS["peers"] = """
SELECT c.customer_id, c.group_id, m.customer_primary_store, s.sku_id
FROM selected_as_written c JOIN primary_store_as_written m USING (customer_id)
JOIN stores s ON s.transaction_store_id = m.customer_primary_store"""
STEPS["largest"] = """
SELECT customer_id, p.group_id, customer_primary_store, max(sku_retail_price - sku_purchase_price) AS max_margin
FROM peers p JOIN stores USING (sku_id) JOIN product_grid g USING (sku_id)
GROUP BY ALL"""
STEPS["sku_counts"] = """
SELECT DISTINCT customer_id, count_sku
FROM (SELECT b.customer_id, l.sku_id, count(l.transaction_id) AS count_sku
      FROM largest b JOIN ph h USING (customer_id, group_id) JOIN checks l ON l.transaction_id = h.transaction_id
      GROUP BY b.customer_id, l.sku_id)"""
STEPS["group_counts"] = """
SELECT customer_id, group_id, count(*) AS count_group
FROM largest JOIN ph USING (customer_id, group_id) GROUP BY ALL"""
STEPS["meetings"] = """
SELECT customer_id, count(*) AS repeats FROM sku_counts JOIN group_counts USING (customer_id)
WHERE count_sku * 100 <= {max_sku_share} * count_group GROUP BY customer_id"""
STEPS["repeated"] = """
SELECT customer_id, sku_name, repeats,
       CASE WHEN {margin_share} / 100.0 * (CAST(max_margin AS DOUBLE) / CAST(s.sku_retail_price AS DOUBLE))
                 >= ceil(group_minimum_discount * 20 - 1e-9) * 5 / 100.0
            THEN ceil(group_minimum_discount * 20 - 1e-9) * 5 END AS offer_discount_depth
FROM largest JOIN meetings USING (customer_id) JOIN selected_as_written USING (customer_id, group_id)
JOIN product_grid g USING (group_id)
JOIN stores s ON s.sku_id = g.sku_id AND s.transaction_store_id = customer_primary_store"""

# --- input checks -------------------------------------------------------------

# The tables with faults of every kind; all rows stay, some occur twice.
_FLAWED = {
    "personal_data": (
        """SELECT customer_id,
  CASE customer_id % 7 WHEN 0 THEN 'anna' WHEN 1 THEN 'Anna-Maria' WHEN 2 THEN NULL ELSE customer_name END
    AS customer_name,
  CASE customer_id % 5 WHEN 0 THEN 'Ёлкина' ELSE 'Smith' END AS customer_surname,
  CASE customer_id % 11 WHEN 0 THEN 'nobody' WHEN 1 THEN 'a b@example.com' ELSE customer_primary_email END
    AS customer_primary_email,
  CASE customer_id % 13 WHEN 0 THEN '+7123456789' WHEN 1 THEN customer_primary_phone || '00'
    WHEN 2 THEN customer_primary_phone || chr(10) ELSE customer_primary_phone END AS customer_primary_phone
FROM personal_data""",
        "customer_id % 50 = 0",
    ),
    "cards": (
        """SELECT customer_card_id,
  customer_id + CASE WHEN customer_card_id % 17 = 0 THEN 10000000 ELSE 0 END AS customer_id FROM cards""",
        "customer_card_id % 19 = 0",
    ),
    "groups_sku": (
        "SELECT CASE WHEN group_id % 5 <> 0 THEN group_id END AS group_id, group_name FROM groups_sku",
        "group_id % 3 = 0",
    ),
    "product_grid": (
        """SELECT sku_id, CASE WHEN sku_id % 29 <> 0 THEN sku_name END AS sku_name,
  group_id + CASE WHEN sku_id % 23 = 0 THEN 1000 ELSE 0 END AS group_id FROM product_grid""",
        "sku_id % 31 = 0",
    ),
    "stores": (
        """SELECT CASE WHEN NOT (sku_id % 41 = 0 AND transaction_store_id < 3) THEN transaction_store_id END
    AS transaction_store_id,
  sku_id + CASE WHEN sku_id % 43 = 0 THEN 1000000 ELSE 0 END AS sku_id FROM stores""",
        "sku_id % 37 = 0 AND transaction_store_id = 1",
    ),
    "transactions": (
        """SELECT transaction_id,
  customer_card_id + CASE WHEN transaction_id % 103 = 0 THEN 10000000 ELSE 0 END AS customer_card_id,
  CASE WHEN transaction_id % 107 <> 0 THEN transaction_datetime END AS transaction_datetime FROM transactions""",
        "transaction_id % 101 = 0",
    ),
    "checks": (
        """SELECT transaction_id + CASE WHEN transaction_id % 109 = 0 THEN 100000000 ELSE 0 END AS transaction_id,
  sku_id + CASE WHEN sku_id % 113 = 0 THEN 1000000 ELSE 0 END AS sku_id FROM checks""",
        "FALSE",
    ),
}
for table, (rows, twice) in _FLAWED.items():
    STEPS[f"flawed_{table}"] = f"""
WITH rows AS ({rows}) SELECT * FROM rows UNION ALL SELECT * FROM rows WHERE {twice}"""

# Unique keys, references and mandatory columns of the tables.
_UNIQUE = [
    ("personal_data", ["customer_id"]),
    ("cards", ["customer_card_id"]),
    ("groups_sku", ["group_id"]),
    ("product_grid", ["sku_id"]),
    ("stores", ["transaction_store_id", "sku_id"]),
    ("transactions", ["transaction_id"]),
]
_REFERENCES = [
    ("cards", "customer_id", "personal_data"),
    ("product_grid", "group_id", "groups_sku"),
    ("stores", "sku_id", "product_grid"),
    ("transactions", "customer_card_id", "cards"),
    ("checks", "transaction_id", "transactions"),
    ("checks", "sku_id", "product_grid"),
]
_MANDATORY = [
    ("personal_data", "customer_id", "customer_id"),
    ("personal_data", "customer_id", "customer_name"),
    ("personal_data", "customer_id", "customer_surname"),
    ("personal_data", "customer_id", "customer_primary_email"),
    ("personal_data", "customer_id", "customer_primary_phone"),
    ("cards", "customer_card_id", "customer_card_id"),
    ("groups_sku", "group_id", "group_id"),
    ("product_grid", "sku_id", "sku_id"),
    ("product_grid", "sku_id", "sku_name"),
    ("stores", "transaction_store_id", "transaction_store_id"),
    ("transactions", "transaction_id", "transaction_id"),
    ("transactions", "transaction_id", "transaction_datetime"),
]


def _key_checks(prefix: str = "") -> str:
    parts = []
    for table, columns in _UNIQUE:
        text = f"CAST({columns[0]} AS VARCHAR)"
        if len(columns) > 1:
            text = " || '/' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        parts.append(
            f"SELECT '{table}' AS \"table\", 'unique {'/'.join(columns)}' AS rule, {text} AS key, "
            f"CAST(count(*) AS VARCHAR) AS detail FROM {prefix}{table} "
            f"GROUP BY {', '.join(columns)} HAVING count(*) > 1"
        )
    for table, column, target in _REFERENCES:
        parts.append(
            f"SELECT '{table}', '{column} in {target}', CAST({column} AS VARCHAR), CAST(count(*) AS VARCHAR) "
            f"FROM {prefix}{table} a WHERE {column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {prefix}{target} b WHERE b.{column} = a.{column}) "
            f"GROUP BY {column}"
        )
    return " UNION ALL ".join(parts)


def _missing_checks(prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{column} present' AS rule, CAST({key} AS VARCHAR) AS key, "
        f"CAST(NULL AS VARCHAR) AS detail FROM {prefix}{table} WHERE {column} IS NULL"
        for table, key, column in _MANDATORY
    )


def _format_checks(prefix: str, name: str, email: str, phone: str) -> str:
    parts = []
    for column, pattern in (
        ("customer_name", name),
        ("customer_surname", name),
        ("customer_primary_email", email),
        ("customer_primary_phone", phone),
    ):
        parts.append(
            f"SELECT 'personal_data' AS \"table\", '{column} format' AS rule, "
            f"CAST(customer_id AS VARCHAR) AS key, {column} AS detail "
            f"FROM {prefix}personal_data WHERE NOT regexp_matches({column}, '{pattern}')"
        )
    return " UNION ALL ".join(parts)


# Formats of personal data, as written in the rules and as in the SQL.
_WRITTEN_RULES = (
    r"^[A-ZА-ЯЁ][-a-zа-яё]*([- ][A-ZА-ЯЁ][-a-zа-яё]*)*\z",
    r"^([A-Za-z0-9_\.-]+)@([A-Za-z0-9_\.-]+)\.([A-Za-z\.]{{2,6}})\z",
    r"^\+7[0-9]{{10}}\z",
)
_SQL_RULES = (
    r"(?i)^[A-ZА-Я][-a-zа-я]*([- ][A-ZА-Я][-a-zа-я]*)*\z",
    r"(?i)^([a-z0-9_\.-]+)@([a-z0-9_\.-]+)\.([a-z\.]{{2,6}})\z",
    r"^\+7[0-9]{{10}}",
)
for prefix in ("", "flawed_"):
    STEPS[prefix + "key_findings"] = _key_checks(prefix)
    STEPS[prefix + "missing_findings"] = _missing_checks(prefix)
    STEPS[prefix + "format_findings"] = _format_checks(prefix, *_WRITTEN_RULES)
    STEPS[prefix + "format_findings_as_written"] = _format_checks(prefix, *_SQL_RULES)

# --- statements ---------------------------------------------------------------

STATEMENTS: dict[str, str] = {
    "purchase_history": """SELECT customer_id, transaction_id, transaction_datetime, group_id,
        CAST(group_cost AS DOUBLE) AS group_cost, CAST(group_summ AS DOUBLE) AS group_summ,
        CAST(group_summ_paid AS DOUBLE) AS group_summ_paid FROM ph""",
    "periods": "SELECT * FROM periods",
    "min_discount": "SELECT customer_id, group_id, group_min_discount FROM periods",
    "average_check_segment": "SELECT * FROM check_segment",
    "visit_frequency_segment": "SELECT * FROM frequency_segment",
    "inactive_period": "SELECT customer_id, customer_inactive_period FROM totals",
    "customer_churn": "SELECT * FROM churn",
    "segment_number": "SELECT * FROM segments",
    "store_share": "SELECT customer_id, transaction_store_id, store_share FROM shares",
    "last_three_stores": "SELECT * FROM last_three",
    "primary_store": "SELECT * FROM primary_store",
    "customers": "SELECT * FROM customers",
    "demanded_groups": "SELECT * FROM demanded",
    "affinity_index": "SELECT * FROM affinity",
    "group_churn_rate": "SELECT * FROM group_churn",
    "stability_index": "SELECT * FROM stability",
    "group_margin_all": "SELECT * FROM margin",
    "group_margin_days": "SELECT * FROM margin_days",
    "group_margin_last_n": "SELECT * FROM margin_last",
    "recent_margin": "SELECT * FROM margin_recent",
    "months_recent_margin": "SELECT * FROM margin_recent",
    "months_avg_check_by_period": "SELECT * FROM check_by_period",
    "months_purchase_history": """SELECT customer_id, transaction_id, transaction_datetime, group_id,
        CAST(group_cost AS DOUBLE) AS group_cost, CAST(group_summ AS DOUBLE) AS group_summ,
        CAST(group_summ_paid AS DOUBLE) AS group_summ_paid FROM ph""",
    "discount_share": "SELECT * FROM discounts",
    "minimum_discount": "SELECT * FROM minimum",
    "average_discount": "SELECT * FROM average",
    "groups": "SELECT * FROM groups",
    "groups_all_pairs": "SELECT * FROM groups_all",
    "groups_margin_days": "SELECT * FROM groups_days",
    "groups_margin_last_n": "SELECT * FROM groups_last",
    "avg_check_by_period": "SELECT * FROM check_by_period",
    "avg_check_by_count": "SELECT * FROM check_by_count",
    "reward_group": "SELECT * FROM reward_total",
    "reward_group_price_list": "SELECT * FROM reward_list",
    "reward_group_customer_ratio": "SELECT * FROM reward_ratio",
    "offers_average_check_period": _check_offer("check_by_period", "reward_total"),
    "offers_average_check_count": _check_offer("check_by_count", "reward_total"),
    "group_price_margin": "SELECT * FROM price_margin",
    "required_transactions": "SELECT * FROM required",
    "offers_visit_frequency": "SELECT * FROM visit_offer",
    "cross_sell_groups": "SELECT customer_id, group_id, group_affinity_index FROM selected",
    "max_margin_sku": """SELECT customer_id, group_id, customer_primary_store, sku_id,
        CAST(max_margin AS DOUBLE) AS max_margin FROM best_sku""",
    "sku_share": "SELECT * FROM sku_shares",
    "cross_sell_discount": "SELECT customer_id, group_id, sku_id, offer_discount_depth FROM depths",
    "offers_cross_sell": """SELECT customer_id, sku_name, offer_discount_depth
        FROM depths JOIN sku_shares USING (customer_id, group_id, sku_id)
        WHERE offer_discount_depth IS NOT NULL AND sku_share <= {max_sku_share} / 100.0""",
    "validate_keys": "SELECT * FROM key_findings",
    "validate": """SELECT * FROM key_findings UNION ALL SELECT * FROM missing_findings
        UNION ALL SELECT * FROM format_findings""",
    "periods_as_written": "SELECT * FROM periods_as_written",
    "segment_number_as_written": "SELECT * FROM segments_as_written",
    "last_three_stores_as_written": "SELECT * FROM last_three_as_written",
    "primary_store_as_written": "SELECT * FROM primary_store_as_written",
    "customers_as_written": "SELECT * FROM customers_as_written",
    "affinity_index_as_written": "SELECT * FROM affinity_as_written",
    "discount_share_as_written": "SELECT * FROM discounts_as_written",
    "min_discount_as_written": "SELECT customer_id, group_id, group_min_discount FROM periods_as_written",
    "minimum_discount_as_written": "SELECT * FROM minimum_as_written",
    "groups_as_written": "SELECT * FROM groups_as_written",
    "avg_check_by_period_as_written": "SELECT * FROM check_by_period_as_written",
    "avg_check_by_count_as_written": "SELECT * FROM check_by_count_as_written",
    "reward_group_as_written": "SELECT * FROM reward_total_as_written",
    "offers_average_check_period_as_written": _check_offer(
        "check_by_period_as_written", "reward_total_as_written"
    ),
    "offers_average_check_count_as_written": _check_offer(
        "check_by_count_as_written", "reward_total_as_written"
    ),
    "required_transactions_as_written": "SELECT * FROM required_as_written",
    "offers_visit_frequency_as_written": "SELECT * FROM visit_offer_as_written",
    "cross_sell_groups_as_written": """SELECT customer_id, group_id, group_affinity_index
        FROM selected_as_written""",
    "validate_flawed": """SELECT * FROM flawed_key_findings UNION ALL SELECT * FROM flawed_missing_findings
        UNION ALL SELECT * FROM flawed_format_findings""",
    "group_margin_last_n_as_written": "SELECT * FROM margin_first",
    "groups_margin_last_n_as_written": "SELECT * FROM groups_first",
    "max_margin_sku_as_written": """SELECT customer_id, group_id, customer_primary_store,
        CAST(max_margin AS DOUBLE) AS max_margin FROM largest""",
    "sku_share_as_written": "SELECT * FROM meetings",
    "offers_cross_sell_as_written": """SELECT customer_id, sku_name, offer_discount_depth
        FROM repeated CROSS JOIN unnest(range(repeats))""",
    "offers_cross_sell_counted_as_written": """SELECT customer_id, sku_name, offer_discount_depth, repeats
        FROM repeated""",
    "validate_flawed_as_written": """SELECT * FROM flawed_key_findings
        UNION ALL SELECT * FROM flawed_missing_findings
        UNION ALL SELECT * FROM flawed_format_findings_as_written""",
    "files_transactions": """SELECT transaction_id, customer_card_id,
        CAST(transaction_summ AS DOUBLE) AS transaction_summ, transaction_datetime, transaction_store_id
        FROM transactions""",
    "files_checks": """SELECT transaction_id, sku_id, CAST(sku_amount AS DOUBLE) AS sku_amount,
        CAST(sku_summ AS DOUBLE) AS sku_summ, CAST(sku_summ_paid AS DOUBLE) AS sku_summ_paid,
        CAST(sku_discount AS DOUBLE) AS sku_discount FROM checks""",
    "files_personal_data": "SELECT * FROM personal_data",
    "files_cards": "SELECT * FROM cards",
    "files_groups_sku": "SELECT * FROM groups_sku",
    "files_product_grid": "SELECT * FROM product_grid",
    "files_stores": """SELECT transaction_store_id, sku_id,
        CAST(sku_purchase_price AS DOUBLE) AS sku_purchase_price,
        CAST(sku_retail_price AS DOUBLE) AS sku_retail_price FROM stores""",
    "files_analysis_date": "SELECT moment AS analysis_formation FROM analysis",
    "files_unreadable": """SELECT 'transactions' AS "table", 'readable row' AS rule,
        CAST(transaction_id AS VARCHAR) AS key, count(*) AS rows FROM transactions
        WHERE transaction_id % 97 < 2 OR transaction_id % 101 = 0 GROUP BY transaction_id
        UNION ALL SELECT 'checks', 'readable row', CAST(transaction_id AS VARCHAR), count(*) FROM checks
        WHERE transaction_id % 103 = 0 GROUP BY transaction_id""",
    "files_readable_transactions": """SELECT transaction_id, customer_card_id,
        CAST(transaction_summ AS DOUBLE) AS transaction_summ, transaction_datetime, transaction_store_id
        FROM transactions WHERE transaction_id % 97 >= 2 AND transaction_id % 101 <> 0""",
    "files_readable_checks": """SELECT transaction_id, sku_id, CAST(sku_amount AS DOUBLE) AS sku_amount,
        CAST(sku_summ AS DOUBLE) AS sku_summ, CAST(sku_summ_paid AS DOUBLE) AS sku_summ_paid,
        CAST(sku_discount AS DOUBLE) AS sku_discount FROM checks WHERE transaction_id % 103 <> 0""",
    "validate_as_written": """SELECT * FROM key_findings UNION ALL SELECT * FROM missing_findings
        UNION ALL SELECT * FROM format_findings_as_written""",
}
# A call of a table function gives what the method gives.
STATEMENTS |= {
    f"sql_{name}": STATEMENTS[name]
    for name in (
        "offers_average_check_period", "offers_average_check_count", "offers_visit_frequency", "offers_cross_sell",
        "groups", "groups_margin_days", "groups_margin_last_n",
    )
}


def _needed(sql: str) -> list[str]:
    """Steps a statement uses, directly or through others, in the order of STEPS."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        for word in set(re.findall(r"\w+", queue.pop())) & STEPS.keys() - found:
            found.add(word)
            queue.append(STEPS[word])
    return _ordered(found)


def _ordered(names: set[str]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for word in STEPS:
            if word in names and word != name and re.search(rf"\b{word}\b", STEPS[name]):
                visit(word)
        order.append(name)

    for name in STEPS:
        if name in names:
            visit(name)
    return order


def _kind(step: str) -> str:
    """Materialized steps keep the join order as written; price lists joined too early explode."""
    kept = (
        "bought", "ph", "visits", "checks", "listed", "selected", "selected_as_written", "primary_store_as_written",
    )
    return "MATERIALIZED" if step in kept else ""


def statements(parameters: dict[str, object]) -> dict[str, str]:
    """Every registered query as one self-contained statement."""
    complete = {}
    for name, sql in STATEMENTS.items():
        steps = ",\n".join(f"{step} AS {_kind(step)} ({STEPS[step]}\n)" for step in _needed(sql))
        complete[name] = f"WITH {steps}\n{sql}".format(**parameters)
    return complete
