"""What the plans must and must not contain, whatever the size of the tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from basketry import Workspace
from basketry.operators import customers, groups, offers
from basketry.sources import files, testtables
from shop import plan

FOLDER = "/root/testdata/sf0.001"
QUERIES = driver.queries()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables(spark):
    return testtables.load(spark, FOLDER)


def test_scans_read_only_what_is_needed(tables):
    text = plan(offers.avg_check_by_count(tables, 5))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)", text))
    assert "l_orderkey:bigint,l_extendedprice:double" in schemas
    assert not any("o_totalprice" in schema for schema in schemas)


def test_start_of_a_period_reaches_the_scan(spark, tables, tmp_path):
    files.write_parquet(tables, str(tmp_path))
    stored = files.read_parquet(spark, str(tmp_path))
    text = plan(offers.avg_check_by_period(stored, "1996-01-01", "1998-12-31"))
    assert "GreaterThanOrEqual(transaction_datetime,1996-01-01T00:00)" in text


def test_pairs_are_dealt_by_customer_and_group(tables):
    """Only windows over single hours and over single pairs: no task gets a whole customer."""
    text = plan(Workspace(tables).groups)
    dealt = set(re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text))
    columns = {tuple(re.sub(r"#\d+L?", "", part).split(", ")) for part in dealt}
    assert ("customer_id",) not in columns
    assert {("customer_id", "hour"), ("customer_id", "group_id"), ("customer_id", "at")} <= columns


def test_history_is_read_once_for_all_group_measures(tables):
    ws = Workspace(tables)
    assert plan(ws.groups).count("l_orderkey:bigint,l_partkey:bigint") == 1
    assert plan(ws.groups_by_margin(1, 30)).count("l_orderkey:bigint,l_partkey:bigint") == 1


def test_offers_cut_the_history_before_the_time_line(tables):
    """Customers without a qualifying pair are gone before any hour is laid out."""
    with Workspace(tables) as ws:
        text = plan(ws.reward_group(max_churn=3, max_discount_share=70, margin_share=30))
    hourly = text.index("windowspecdefinition(customer_id#", text.index("hour#"))
    assert text.index("LeftSemi") > hourly
    assert text.count("Exchange hashpartitioning(customer_id") <= 3


@pytest.mark.parametrize(
    "build",
    [
        lambda t: offers.avg_check_by_count(t, 5),
        lambda t: offers.avg_check_by_count(t, 5000),
        lambda t: customers.last_three_stores(t),
        lambda t: groups.group_margin(Workspace(t).history, Workspace(t).analysis, 2, 3),
    ],
)
def test_latest_rows_are_cut_before_the_shuffle(tables, build):
    text = plan(build(tables))
    partial = text.index("Partial", text.index("WindowGroupLimit"))
    assert "Exchange hashpartitioning" in text[:partial]
    assert "WindowGroupLimit" in text


def test_prices_are_joined_by_product_and_store(tables):
    text = plan(Workspace(tables).history)
    assert "map_from_entries" not in text and "collect_list" not in text
    assert "LeftOuter" in text


@pytest.mark.parametrize(
    "name, rows",
    [("purchase_history", 5479), ("groups", 1592), ("offers_average_check_count", 144), ("offers_visit_frequency", 100)],
)
def test_known_sizes(spark, name, rows):
    assert QUERIES[name](spark, FOLDER).count() == rows


def test_known_cross_selling_sizes(tables):
    ws = Workspace(tables)
    limits = dict(max_churn=3, max_stability=0.5, max_sku_share=100, margin_share=30)
    assert ws.offers_cross_sell(5, **limits).count() == 59


def test_invariants(tables):
    ws = Workspace(tables).store_history()
    pairs = ws.groups
    assert pairs.filter("group_affinity_index <= 0 OR group_affinity_index > 1").count() == 0
    assert pairs.filter("group_discount_share <= 0 OR group_discount_share > 1").count() == 0
    assert pairs.filter("group_stability_index < 0").count() == 0
    assert ws.customers.filter("customer_segment NOT BETWEEN 1 AND 27").count() == 0
    history = ws.purchase_history
    assert history.count() == history.select("customer_id", "transaction_id", "group_id").distinct().count()
    shares = customers.store_share(tables).groupBy("customer_id").sum("store_share")
    assert shares.filter("abs(`sum(store_share)` - 1) > 1e-9").count() == 0
    priced = tables.checks.join(tables.transactions, "transaction_id").join(
        tables.stores.select("sku_id", "transaction_store_id"), ["sku_id", "transaction_store_id"], "left_semi"
    )
    assert history.groupBy().sum("group_summ_paid").first() == priced.groupBy().sum("sku_summ_paid").first()


def test_nothing_is_broadcast_on_an_estimate(spark):
    """The price list is a few kilobytes of products on disk, and many rows once it is listed by store."""
    text = plan(QUERIES["discount_share"](spark, FOLDER))
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text


def test_prices_are_moved_before_they_are_aggregated(spark):
    text = plan(QUERIES["discount_share"](spark, FOLDER))
    listed = text[text.index("Generate explode") - 2000 :]
    below = listed[: listed.index("Generate explode")]
    assert re.search(r"REPARTITION_BY_COL", below)
    assert not re.search(r"partial_count\(1\)", below[below.rindex("REPARTITION_BY_COL") :])


@pytest.mark.parametrize("name", ["group_margin_last_n", "group_margin_last_n_as_written"])
def test_a_history_needed_twice_is_written(spark, name):
    assert "l_orderkey" not in plan(QUERIES[name](spark, FOLDER))
