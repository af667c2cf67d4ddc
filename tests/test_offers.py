from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest

from basketry import Workspace
from basketry.operators import cross_sell, offers
from basketry.session import shared_folder
from shop import at, by, shop

DETAILS = (
    "customer_id long, group_id long, group_affinity_index double, group_churn_rate double,"
    " group_stability_index double, group_margin double, group_discount_share double,"
    " group_minimum_discount double, group_average_discount double, group_purchase long,"
    " group_summ_paid double"
)


def details(spark, *pairs):
    """pairs: (customer, group, affinity, churn, stability, margin, share, minimum discount)"""
    rows = [
        (customer, group, *(None if v is None else float(v) for v in measures), 1.0, 10, 1000.0)
        for customer, group, *measures in pairs
    ]
    return spark.createDataFrame(rows, DETAILS)


PERIOD_SHOP = dict(
    receipts=[
        (1, 1, 0, "01-05 12:00", 1),
        (2, 1, 0, "01-10 12:00", 1),
        (3, 1, 0, "01-30 18:00", 1),
        (4, 2, 0, "01-10 12:00", 1),
        (5, 2, 0, "01-11 12:00", 1),  # without lines
    ],
    lines=[
        (1, 1, 1, 10, 0),
        (1, 2, 1, 20, 0),
        (2, 1, 1, 60, 0),
        (3, 1, 1, 90, 0),
        (4, 1, 1, 5, 0),
    ],
    analysis=datetime(2022, 1, 30, 20),
)


@pytest.mark.parametrize(
    "first, last, spec, written",
    [
        # An end given as a date includes its day; as written it is the day's midnight.
        ("2022-01-05", "2022-01-10", {1: 45.0, 2: 5.0}, {1: 15.0}),
        ("2022-01-05", date(2022, 1, 10), {1: 45.0, 2: 5.0}, {1: 15.0}),
        ("2022-01-05", "2022-01-10 00:00:00", {1: 30.0}, {1: 15.0}),
        ("2022-01-05", datetime(2022, 1, 10, 12), {1: 45.0, 2: 5.0}, {1: 30.0, 2: 5.0}),
        ("2022-01-05", "2022-01-11", {1: 45.0, 2: 5.0}, {1: 30.0, 2: 5.0}),
        # The analysis date's day ends at its moment.
        ("2022-01-06", "2022-01-30", {1: 75.0, 2: 5.0}, {1: 60.0, 2: 5.0}),
        (None, None, {1: 60.0, 2: 5.0}, {1: 30.0, 2: 5.0}),
        # Too early: starts at the first transaction, cut to its midnight as written.
        ("2020-01-01", "2022-01-06", {1: 30.0}, {1: 15.0}),
        # Too late, not after the start: the analysis date, its midnight as written.
        ("2022-01-06", "2023-01-01", {1: 75.0, 2: 5.0}, {1: 60.0, 2: 5.0}),
        ("2022-01-06", "2022-01-06 00:00:00", {1: 75.0, 2: 5.0}, {1: 60.0, 2: 5.0}),
        ("2022-01-10", "2022-01-10", {1: 60.0, 2: 5.0}, {1: 60.0, 2: 5.0}),
        ("2022-01-06", "2021-01-06", {1: 75.0, 2: 5.0}, {1: 60.0, 2: 5.0}),
    ],
)
def test_average_check_by_period(spark, first, last, spec, written):
    tables = shop(spark, **PERIOD_SHOP)
    assert by(offers.avg_check_by_period(tables, first, last), "customer_id") == spec
    assert by(offers.avg_check_by_period(tables, first, last, "as_written"), "customer_id") == written


@pytest.mark.parametrize(
    "count, spec, written",
    [
        (1, {1: 90.0}, {1: 90.0}),  # the latest of customer 2 has no lines
        (2, {1: 75.0, 2: 5.0}, {1: 75.0, 2: 5.0}),
        (99, {1: 60.0, 2: 5.0}, {1: 45.0, 2: 5.0}),
    ],
)
def test_average_check_by_count(spark, count, spec, written):
    tables = shop(spark, **PERIOD_SHOP)
    assert by(offers.avg_check_by_count(tables, count), "customer_id") == spec
    assert by(offers.avg_check_by_count(tables, count, "as_written"), "customer_id") == written


def test_price_margin(spark):
    tables = shop(spark, [(1, 1, 0, "01-01", 1)])
    # Dairy: (4 + 2) * 2 over 40; Bakery: 15 * 2 over 40.
    assert by(offers.group_price_margin(tables), "group_id") == {1: 0.3, 2: 0.75}


def test_reward_takes_next_group_until_all_conditions_hold(spark):
    pairs = details(
        spark,
        (1, 1, 0.9, 3.1, 0, 1000.0, 0.5, 0.10),  # churn too high
        (1, 2, 0.8, 1.0, 0, 1000.0, 0.71, 0.10),  # discounted too often
        (1, 3, 0.7, 1.0, 0, 50.0, 0.5, 0.11),  # 15 is not below 15
        (1, 4, 0.6, 1.0, 0, 1000.0, 0.5, None),  # never discounted
        (1, 5, 0.5, 3.0, 0, 1000.0, 0.7, 0.11),  # on the limits
        (1, 6, 0.4, 1.0, 0, 1000.0, 0.5, 0.05),
        (2, 7, 0.5, 1.0, 0, 1000.0, 0.5, 0.05),  # equal affinity: smaller key
        (2, 6, 0.5, 1.0, 0, 1000.0, 0.5, 0.10),
        (3, 1, 0.5, 9.0, 0, 1000.0, 0.5, 0.10),  # nothing left
    )
    reward = offers.reward_group(pairs, 3, 70, 30).drop("group_affinity_index")
    assert by(reward, "customer_id") == {1: (5, 15.0), 2: (6, 10.0)}


def test_reward_margin_bases(spark):
    pairs = details(spark, (1, 1, 0.9, 1.0, 0, 400.0, 0.5, 0.10), (1, 2, 0.8, 1.0, 0, 30.0, 0.5, 0.10))
    prices = spark.createDataFrame([(1, 0.3), (2, 0.75)], "group_id long, average_margin double")

    def chosen(**choice):
        return by(offers.reward_group(pairs, 3, 70, 30, **choice).select("customer_id", "group_id"), "customer_id")

    assert chosen() == {1: 1}  # 120 in money
    assert chosen(margin_basis="price_list", price_margin=prices) == {1: 2}  # 9 %, 22.5 %
    assert chosen(margin_basis="customer_ratio") == {1: 1}  # 40 % of 30
    with pytest.raises(ValueError):
        chosen(margin_basis="other")


def test_reward_per_group_rounding_down(spark):
    pairs = details(
        spark,
        (1, 1, 0.9, 1.0, 0, 1000.0, 0.5, 0.09),
        (1, 2, 0.9, 1.0, 0, 1000.0, 0.5, 0.10),
        (2, 1, 0.95, 1.0, 0, 1000.0, 0.5, 0.14),
    )
    reward = offers.reward_group(pairs, 3, 70, 30, per="group", rounding="down")
    assert by(reward.drop("group_affinity_index"), "group_id") == {1: (2, 10.0), 2: (1, 10.0)}


def test_average_check_offer(spark):
    tables = shop(spark, **PERIOD_SHOP)
    pairs = details(spark, (1, 1, 0.9, 1.0, 0, 1000.0, 0.5, 0.09), (2, 2, 0.9, 9.0, 0, 1000.0, 0.5, 0.1))
    offer = offers.offers_average_check(
        tables, pairs, 2, count=2, coefficient=2, max_churn=3, max_discount_share=70, margin_share=30
    )
    assert by(offer, "customer_id") == {1: (150.0, "Dairy", 10.0)}
    with pytest.raises(ValueError):
        offers.offers_average_check(tables, pairs, 3)


@pytest.mark.parametrize(
    "start, end, mode, expected",
    [
        ("2022-01-01", "2022-01-11", "spec", {1: 6, 2: 4, 3: None}),
        ("2022-01-01", "2022-01-11", "as_written", {1: -4, 2: -2, 3: None}),
        ("2022-01-01", "2022-01-01", "spec", {1: 1, 2: 1, 3: None}),
    ],
)
def test_required_transactions_round_half_away(spark, start, end, mode, expected):
    frequencies = spark.createDataFrame(
        [(1, 2.0), (2, 4.0), (3, 0.0)], "customer_id long, customer_frequency double"
    )
    # 10 days: 5 visits, and 2.5 rounded to 3 (or -2.5 to -3), plus 1.
    result = offers.required_transactions(frequencies, start, end, 1, mode)
    assert by(result, "customer_id") == expected


def test_visit_offer(spark):
    tables = shop(spark, [(1, 1, 0, "01-01", 1)])
    frequencies = spark.createDataFrame([(1, 2.0)], "customer_id long, customer_frequency double")
    pairs = details(spark, (1, 1, 0.9, 1.0, 0, 1e6, 0.5, 0.10), (1, 2, 0.8, 1.0, 0, 1e6, 0.5, 0.10))
    offer = offers.offers_visit_frequency(
        tables, pairs, frequencies, "2022-01-01", datetime(2022, 1, 11), 1, 3, 70, 30
    )
    assert by(offer, "customer_id") == {1: (at("01-01"), at("01-11"), 6, "Bakery", 10.0)}


def test_cross_sell_groups_filter_then_rank(spark):
    pairs = details(
        spark,
        (1, 1, 0.9, 3.5, 0.1, 0, 0, 0.1),
        (1, 2, 0.8, 3.0, 0.5, 0, 0, 0.1),  # stability must be below the limit
        (1, 3, 0.7, 3.0, 0.4, 0, 0, 0.1),
        (1, 4, 0.6, 1.0, 0.4, 0, 0, 0.1),
        (1, 5, 0.5, 1.0, 0.4, 0, 0, 0.1),
    )

    def chosen(count, mode="spec"):
        return {row.group_id for row in cross_sell.cross_sell_groups(pairs, count, 3, 0.5, mode).collect()}

    assert chosen(1) == {3} and chosen(2) == {3, 4} and chosen(9) == {3, 4, 5} and chosen(0) == set()
    assert chosen(1, "as_written") == {3, 4, 5} and chosen(0, "as_written") == set()


def test_best_sku_in_main_store(spark):
    tables = shop(
        spark,
        [(1, 1, 0, "01-01", 1)],
        prices=[(1, 1, 6, 10), (1, 2, 6, 10), (1, 3, 5, 20), (2, 1, 9, 10), (2, 2, 8, 10)],
    )
    stores = spark.createDataFrame([(1, 1), (2, 2)], "customer_id long, customer_primary_store long")
    pairs = details(spark, *((c, g, 0.9, 1.0, 0.1, 0, 0, 0.1) for c in (1, 2) for g in (1, 2)))
    best = cross_sell.max_margin_sku(tables, pairs, stores).select("customer_id", "group_id", "sku_id", "max_margin")
    # Equal margins in store 1: the smaller key. Store 2 lists no Bakery.
    assert by(best, "customer_id", "group_id") == {(1, 1): (1, 4), (1, 2): (3, 15), (2, 1): (2, 2)}


@pytest.mark.parametrize("minimum, depth", [(0.10, 10.0), (0.12, 15.0), (0.151, None), (None, None)])
def test_cross_sell_discount(spark, minimum, depth):
    # A margin of half the price, 30 % of it: up to 15 % discount.
    df = spark.createDataFrame(
        [(5.0, 10.0, minimum)], "max_margin double, sku_retail_price double, group_minimum_discount double"
    )
    assert df.select(cross_sell.cross_sell_discount(30)).first()[0] == depth


def cross_shop(spark):
    """Customer 1 buys Dairy four times: cream (sku 2) on three receipts, milk on two."""
    return shop(
        spark,
        receipts=[(i, 1, 0, f"01-{i * 4:02d}", 1) for i in range(1, 5)],
        lines=[
            (1, 1, 1, 10, 1),
            (1, 2, 1, 10, 1),
            (1, 2, 1, 10, 1),
            (2, 2, 1, 10, 1),
            (3, 2, 1, 10, 1),
            (4, 1, 1, 10, 1),
        ],
        prices=[(1, 1, 6, 10), (1, 2, 4, 10), (1, 3, 5, 20)],
    )


@pytest.mark.parametrize("limit, found", [(100, True), (75, True), (74, False)])
def test_cross_sell_offer_limits_the_sku_share(spark, limit, found):
    ws = Workspace(cross_shop(spark))
    offer = ws.offers_cross_sell(
        5, max_churn=9, max_stability=9, max_sku_share=limit, margin_share=30
    )
    assert by(offer, "customer_id") == ({1: ("Cream", 10.0)} if found else {})


def test_cross_sell_needs_enough_margin(spark):
    ws = Workspace(cross_shop(spark))
    limits = dict(max_churn=9, max_stability=9, max_sku_share=100)
    assert ws.offers_cross_sell(5, margin_share=16, **limits).count() == 0  # 9.6 % < 10 %
    assert ws.offers_cross_sell(5, margin_share=17, **limits).count() == 1


@pytest.mark.parametrize("limit, repeats", [(100, 2), (99, 1), (50, 1), (49, 0)])
def test_cross_sell_as_written_repeats_offers(spark, limit, repeats):
    # Milk has 2 lines and cream 4, the group has 4 purchases. Bread gives the largest margin.
    with Workspace(cross_shop(spark), mode="as_written") as ws:
        limits = dict(max_churn=9, max_stability=9, max_sku_share=limit)
        offers = ws.offers_cross_sell(5, margin_share=30, **limits)
        assert sorted(map(tuple, offers.collect())) == sorted(
            [(1, name, 10.0) for name in ("Milk", "Cream")] * repeats
        )
        # 6 % of 15 is less than a tenth of 10: the offers stay without a depth.
        counted = ws.offers_cross_sell_counted(5, margin_share=6, **limits)
        expected = {(1, "Milk"): (None, repeats), (1, "Cream"): (None, repeats)} if repeats else {}
        assert by(counted, "customer_id", "sku_name") == expected


def test_cross_sell_as_written_equal_counts_meet_once(spark):
    """Two products of 3 lines each are one count; receipts with both groups count twice."""
    tables = shop(
        spark,
        receipts=[(i, 1, 0, f"01-{i * 4:02d}", 1) for i in range(1, 5)],
        lines=[(i, sku, 1, 10, 1) for i in (1, 2, 3) for sku in (1, 3)] + [(4, 2, 1, 10, 1)],
    )
    with Workspace(tables, mode="as_written") as ws:
        selected = ws.cross_sell_selected(5, 99, 99)
        repeats = {}
        for limit in (100, 200, 150, 24, 25):
            found = cross_sell.share_repeats_as_written(tables, ws.history, selected, limit)
            repeats[limit] = by(found, "customer_id").get(1)
    # Counts 6 (milk, bread: 3 lines in two groups) and 1 (cream); purchases 4 (Dairy) and 3 (Bakery).
    values, purchases = (6, 1), (4, 3)
    for limit, found in repeats.items():
        count = sum(v * 100 <= limit * p for v in values for p in purchases)
        assert found == (count or None)


def test_spread_repeats_rows(spark):
    offers = spark.createDataFrame([("a", 1), ("b", 1024), ("c", 2500)], "sku_name string, repeats long")
    counts = cross_sell.spread(offers).groupBy("sku_name").count()
    assert by(counts, "sku_name") == {"a": 1, "b": 1024, "c": 2500}


def test_counted_offers_are_of_mode_as_written(spark):
    with pytest.raises(ValueError, match="as_written"):
        Workspace(cross_shop(spark)).offers_cross_sell_counted(5, 9, 9, 100, 30)


def test_workspace_views(spark):
    ws = Workspace(cross_shop(spark))
    ws.register_views("t_")
    count = spark.sql("SELECT count(*) FROM t_groups_ JOIN t_customers USING (customer_id)").first()[0]
    assert count == 1
    assert spark.table("t_purchase_history").count() == 4
    assert spark.table("t_periods").columns[:2] == ["customer_id", "group_id"]
    before = sorted(map(repr, ws.purchase_history.collect()))
    assert sorted(map(repr, ws.store_history().purchase_history.collect())) == before


def test_nothing_is_left_after_close(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    there = set(folder.glob("basketry/*"))
    with Workspace(cross_shop(spark)) as ws:
        ws.store_history().customers.collect()
        assert len(set(folder.glob("basketry/*")) - there) == 1
    assert set(folder.glob("basketry/*")) == there


def test_all_pairs(spark):
    ws = Workspace(shop(spark, **PERIOD_SHOP), min_purchases=1)
    assert by(ws.groups.select("customer_id", "group_id", "group_stability_index"), "customer_id", "group_id") == {
        (1, 1): pytest.approx(by(ws.groups.select("customer_id", "group_stability_index"), "customer_id")[1]),
        (2, 1): None,
    }
    assert {row.customer_id for row in Workspace(ws.tables).groups.collect()} == {1}
