from __future__ import annotations

from decimal import Decimal

import pytest

from basketry.operators.history import analysis_moment, discounted_history, purchase_history
from basketry.operators.periods import group_min_discount, periods
from shop import at, by, shop


def money(df):
    return {
        key: tuple(float(v) for v in value)
        for key, value in by(df.drop("transaction_datetime"), "customer_id", "transaction_id", "group_id").items()
    }


def test_cards_stores_and_missing_prices(spark):
    tables = shop(
        spark,
        # Customer 1 has the cards 10 and 11; store 3 lists nothing; card 12 has no known owner.
        receipts=[
            (1, 10, 40, "01-01 10:00", 1),
            (2, 11, 10, "01-02 10:00", 2),
            (3, 11, 10, "01-03 10:00", 3),
            (4, 12, 10, "01-04 10:00", 1),
        ],
        lines=[(1, 1, 2, 20, 2), (1, 2, 1, 10, 0), (1, 3, 1, 20, 0), (2, 1, 1, 10, 0), (3, 1, 1, 10, 0), (4, 1, 1, 10, 0)],
        cards=[(10, 1), (11, 1), (12, 2)],
        people=[1],
        prices=[(1, 1, 6, 10), (1, 2, 8, 10), (1, 3, 5, 20), (2, 1, 7, 10)],
    )
    assert money(purchase_history(tables)) == {
        (1, 1, 1): (20.0, 30.0, 28.0),
        (1, 1, 2): (5.0, 20.0, 20.0),
        (1, 2, 1): (7.0, 10.0, 10.0),
    }


def test_duplicate_price_rows_multiply_money(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 10, "01-01", 1)],
        lines=[(1, 1, 1, 10, 0)],
        prices=[(1, 1, 6, 10), (1, 1, 6, 10)],
    )
    assert money(purchase_history(tables)) == {(1, 1, 1): (12.0, 20.0, 20.0)}


def test_unpriced_lines_count_for_discounts_only(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 20, "01-01", 1), (2, 1, 10, "01-02", 1)],
        lines=[(1, 1, 1, 10, 0), (1, 2, 1, 10, 2), (2, 2, 1, 10, 1)],
        prices=[(1, 1, 6, 10)],
    )
    history = discounted_history(tables).select(
        "transaction_id", "group_summ", "line_discount_min", "discount_count"
    )
    assert by(history, "transaction_id") == {1: (Decimal(10), 0.2, 1)}
    assert by(group_min_discount(discounted_history(tables)), "customer_id", "group_id") == {(1, 1): 0.2}


@pytest.mark.parametrize("mode", ["spec", "as_written"])
def test_both_histories_agree_on_money(spark, mode):
    tables = shop(
        spark,
        receipts=[(1, 1, 30, "01-01", 1), (2, 1, 10, "01-02", 2)],
        lines=[(1, 1, 1, 10, 1), (1, 3, 1, 20, 5), (2, 2, 1, 10, 0)],
    )
    full = discounted_history(tables, mode).drop("line_discount_min", "discount_count")
    assert money(full) == money(purchase_history(tables))


def test_discounts_of_other_groups(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 40, "01-01", 1)],
        lines=[(1, 1, 1, 10, 1), (1, 2, 1, 10, 0.5), (1, 3, 1, 20, 5)],
    )
    keys = ("customer_id", "group_id")
    columns = [*keys, "line_discount_min", "discount_count"]
    assert by(discounted_history(tables).select(columns), *keys) == {(1, 1): (0.05, 1), (1, 2): (0.25, 1)}
    written = discounted_history(tables, "as_written").select(columns)
    assert by(written, *keys) == {(1, 1): (0.05, 3), (1, 2): (0.05, 3)}


def test_zero_sum_and_negative_discount(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 0, "01-01", 1), (2, 1, 10, "01-02", 1)],
        lines=[(1, 1, 1, 0, 1), (2, 3, 1, 20, -2)],
    )
    columns = ["group_id", "line_discount_min", "discount_count"]
    assert by(discounted_history(tables).select(columns), "group_id") == {1: (None, 1), 2: (-0.1, 0)}


def test_periods(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 10, "01-01 00:00", 1), (2, 1, 10, "01-03 12:00", 1), (3, 1, 20, "01-09", 1)],
        lines=[(1, 1, 1, 10, 0), (2, 2, 1, 10, 0), (3, 3, 1, 20, 4)],
    )
    assert by(periods(discounted_history(tables)), "customer_id", "group_id") == {
        (1, 1): (at("01-01"), at("01-03 12:00"), 2, 1.75, 0.0),
        (1, 2): (at("01-09"), at("01-09"), 1, 1.0, 0.2),
    }


@pytest.mark.parametrize("times", [0, 2])
def test_analysis_date_must_be_single(spark, times):
    tables = shop(spark, receipts=[(1, 1, 10, "01-01", 1)])
    date = tables.date_of_analysis_formation
    dates = date.union(date) if times else date.limit(0)
    changed = type(tables)(**(dict(tables.items()) | {"date_of_analysis_formation": dates}))
    with pytest.raises(Exception, match=f"must be one, not {times}"):
        spark.range(1).select(analysis_moment(changed)).collect()
