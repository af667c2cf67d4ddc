from __future__ import annotations

from datetime import datetime

import pytest

from basketry import Workspace
from basketry.plans.sql_functions import register_functions
from shop import by, plan, shop

RECEIPTS = [(i, 1 + i % 2, 10, f"01-{i:02} 12:00", 1) for i in range(1, 13)]
LINES = [(i, 1 + i % 3, 2, 40, 4 if i % 4 else 0) for i in range(1, 13)]
LIMITS = dict(max_churn=9, max_discount_share=100, margin_share=100)


@pytest.fixture(scope="module")
def ws(spark):
    with Workspace(shop(spark, RECEIPTS, LINES, analysis=datetime(2022, 1, 20))) as workspace:
        register_functions(workspace, "t_")
        yield workspace


def test_calls_by_place_and_name_equal_the_method(spark, ws):
    method = ws.offers_average_check(2, count=3, coefficient=1.5, **LIMITS)
    call = spark.sql(
        "SELECT * FROM t_offers_average_check(2, last_visits => 3, coefficient => 1.5, max_churn => 9,"
        " max_discount_share => 100, margin_share => 100)"
    )
    assert call.columns == method.columns
    assert by(call, "customer_id") == by(method, "customer_id") != {}


def test_defaults(spark, ws):
    """Without limits nothing qualifies; the group table takes the margin of all history."""
    assert spark.sql("SELECT * FROM t_offers_average_check(1)").count() == 0
    call = spark.sql("SELECT * FROM t_groups_by_margin()")
    assert call.columns == ws.groups.columns
    margins = {k: float(v) for k, v in by(ws.groups.select("customer_id", "group_id", "group_margin"), "customer_id", "group_id").items()}
    assert by(call.select("customer_id", "group_id", "group_margin"), "customer_id", "group_id") == margins != {}


def test_what_is_not_asked_for_is_not_planned(spark, ws):
    text = plan(spark.sql("SELECT * FROM t_offers_average_check(1, max_churn => 9, max_discount_share => 100, margin_share => 100)"))
    assert "transaction_id#" not in "".join(line for line in text.split("\n") if "row_number()" in line)


def test_other_modes_have_no_functions(ws):
    with pytest.raises(ValueError):
        register_functions(Workspace(ws.tables, "as_written"))
