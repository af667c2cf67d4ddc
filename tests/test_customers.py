from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from basketry.operators import customers as K
from shop import at, by, shop


def test_average_check_over_all_cards(spark):
    tables = shop(
        spark,
        receipts=[(1, 10, 30, "01-01", 1), (2, 11, 10, "01-02", 1), (3, 12, 5, "01-02", 1)],
        cards=[(10, 1), (11, 1), (12, 2)],
    )
    result = K.average_check(tables).select("customer_id", "customer_average_check")
    assert by(result, "customer_id") == {1: 20.0, 2: 5.0}


@pytest.mark.parametrize("size", [9, 10, 20, 23])
def test_segment_sizes(spark, size):
    receipts = [(i, i, 100 - i, "01-01", 1) for i in range(1, size + 1)]
    segments = by(
        K.average_check(shop(spark, receipts)).select("customer_id", "customer_average_check_segment"),
        "customer_id",
    )
    high, middle = size * 10 // 100, size * 35 // 100
    assert [segments[i] for i in sorted(segments)] == (
        ["High"] * high + ["Medium"] * (middle - high) + ["Low"] * (size - middle)
    )


def test_equal_frequencies_rank_by_customer(spark):
    receipts = [(2 * i, i, 1, "01-01", 1) for i in range(1, 11)]
    receipts += [(2 * i + 1, i, 1, "01-11", 1) for i in range(1, 11)]
    result = K.visit_frequency(shop(spark, receipts))
    values = by(result, "customer_id")
    assert {v[0] for v in values.values()} == {5.0}
    assert [values[i][1] for i in range(1, 11)] == ["Often"] + ["Occasionally"] * 2 + ["Rarely"] * 7


def test_churn_bounds(spark):
    # Frequency 1 day each (two visits two days apart), analysis on 01-31.
    def visits(customer, last):
        return [
            (customer * 10, customer, 1, f"01-{last - 2:02d}", 1),
            (customer * 10 + 1, customer, 1, f"01-{last:02d}", 1),
        ]

    receipts = visits(1, 31) + visits(2, 29) + visits(3, 28) + visits(4, 26) + visits(5, 25)
    receipts += [(60, 6, 1, "01-30", 1)]  # a single visit
    receipts += [(70, 7, 1, "02-01", 1), (71, 7, 1, "02-03", 1)]  # after the analysis
    churn = by(K.customer_churn(shop(spark, receipts)), "customer_id")
    assert churn == {
        1: (0.0, "Low"),
        2: (2.0, "Low"),
        3: (3.0, "Medium"),
        4: (5.0, "Medium"),
        5: (6.0, "High"),
        6: (None, "High"),
        7: (-3.0, "High"),
    }


def test_inactive_period_keeps_fractions(spark):
    tables = shop(spark, [(1, 1, 1, "01-29 18:00", 1)])
    assert by(K.inactive_period(tables), "customer_id") == {1: 1.25}


STORE_RECEIPTS = [
    # 1: most visits in store 1, the last three in store 2
    *[(10 + i, 1, 1, f"01-{i + 1:02d}", 1) for i in range(5)],
    *[(20 + i, 1, 1, f"01-{i + 10:02d}", 2) for i in range(3)],
    # 2: largest share in store 1, last three mixed
    *[(30 + i, 2, 1, f"01-{i + 1:02d}", 1) for i in range(3)],
    (33, 2, 1, "01-20", 2),
    # 3: equal shares, last in store 1; others were in store 2 later than in store 1
    (40, 3, 1, "01-01", 1),
    (41, 3, 1, "01-02", 2),
    (42, 3, 1, "01-03", 2),
    (43, 3, 1, "01-04", 1),
    # 4: one visit
    (50, 4, 1, "01-05", 2),
]


def test_primary_store(spark):
    tables = shop(spark, STORE_RECEIPTS)
    assert by(K.primary_store(tables), "customer_id") == {1: 2, 2: 1, 3: 1, 4: 2}


def test_primary_store_as_written(spark):
    # The last three moments of anybody in stores 1 and 2 are all in store 2
    # (01-20, 01-12, 01-11), so whoever knows both stores gets store 2.
    tables = shop(spark, STORE_RECEIPTS)
    assert by(K.primary_store(tables, "as_written"), "customer_id") == {1: 2, 2: 2, 3: 2, 4: 2}
    moments = K.last_three_stores(tables, "as_written").filter("customer_id = 3")
    assert sorted(row.transaction_datetime for row in moments.collect()) == [
        at("01-11"), at("01-12"), at("01-20"),
    ]


def test_last_three_break_ties_by_transaction(spark):
    receipts = [(i, 1, 1, "01-01", i) for i in range(1, 6)]
    stores = K.last_three_stores(shop(spark, receipts)).select("transaction_store_id").collect()
    assert sorted(row[0] for row in stores) == [3, 4, 5]


def test_store_shares_sum_to_one(spark):
    shares = by(K.store_share(shop(spark, STORE_RECEIPTS)), "customer_id", "transaction_store_id")
    assert shares[(1, 1)] == 5 / 8 and shares[(1, 2)] == 3 / 8
    assert shares[(4, 2)] == 1.0


def crowd(size):
    """Customers whose check, frequency and churn all differ."""
    receipts = []
    for i in range(1, size + 1):
        receipts += [
            (10 * i, i, 100 - i, "2021-12-01", 1),
            (10 * i + 1, i, 100 - i, f"2021-12-{1 + i:02d}", 1),
            (10 * i + 2, i, 100 - i, "01-30" if i % 2 else "2021-12-28", 1),
        ]
    return receipts


def test_segment_numbers(spark):
    check = ["Low", "Medium", "High"]
    pace = ["Rarely", "Occasionally", "Often"]
    table = K.customers(shop(spark, crowd(20))).collect()
    assert len(table) == 20
    for row in table:
        expected = (
            9 * check.index(row.customer_average_check_segment)
            + 3 * pace.index(row.customer_frequency_segment)
            + check.index(row.customer_churn_segment)
            + 1
        )
        assert row.customer_segment == expected
    assert {row.customer_average_check_segment for row in table} == set(check)


def test_segment_numbers_as_written_lose_customers(spark):
    # Under ten customers nobody is High, so High churn finds no number.
    receipts = crowd(5) + [(900, 9, 1, "01-30", 1)]
    tables = shop(spark, receipts)
    everybody = by(K.segment_number(tables), "customer_id")
    written = by(K.segment_number(tables, "as_written"), "customer_id")
    assert everybody[9][2] == "High" and 9 not in written
    assert written.keys() == {c for c, v in everybody.items() if v[2] != "High"}
    # Check and churn have the values Low, Medium; frequency Rarely, Occasionally.
    for check, pace, churn, number in written.values():
        places = (check == "Medium", pace == "Occasionally", churn == "Medium")
        assert number == 4 * places[0] + 2 * places[1] + places[2] + 1


def test_customers_equal_their_parts(spark):
    tables = shop(spark, STORE_RECEIPTS + [(900 + i, 20 + i, i, "01-02", 1) for i in range(12)])
    whole = by(K.customers(tables), "customer_id")
    checks = by(K.average_check(tables), "customer_id")
    paces = by(K.visit_frequency(tables), "customer_id")
    churn = by(K.customer_churn(tables), "customer_id")
    stores = by(K.primary_store(tables), "customer_id")
    for customer, row in whole.items():
        assert row[0:2] == checks[customer]
        assert row[2:4] == paces[customer]
        assert row[5:7] == churn[customer]
        assert row[8] == stores[customer]


@pytest.mark.parametrize("seed", [1, 2])
def test_stores_and_frequency_equal_their_definitions(spark, seed):
    """A customer with a third of all visits, two cards each, many equal moments."""
    rng = random.Random(seed)
    start = datetime(2021, 6, 1)
    receipts = []
    for number in range(300):
        customer = 1 if number % 3 == 0 else rng.randrange(2, 40)
        moment = start + timedelta(hours=rng.randrange(0, 4000, 8))
        card = 2 * customer + number % 2
        receipts.append((number, card, rng.randrange(100), moment.isoformat(" "), rng.randrange(1, 4)))
    cards = sorted({(card, card // 2) for _, card, *_ in receipts})
    tables = shop(spark, receipts, cards=cards)
    visits = defaultdict(list)
    for number, card, _, moment, store in receipts:
        visits[card // 2].append((datetime.fromisoformat(moment), number, store))
    expected = {}
    for customer, line in visits.items():
        line.sort()
        last = {store for *_, store in line[-3:]}
        counts = Counter(store for *_, store in line)
        latest = {store: moment for moment, _, store in line}
        favourite = max(counts, key=lambda s: (counts[s], latest[s], s))
        span = (line[-1][0] - line[0][0]) / timedelta(seconds=1)
        expected[customer] = (span / (86400 * len(line)), last.pop() if len(last) == 1 else favourite)
    result = K.customers(tables).select("customer_id", "customer_frequency", "customer_primary_store")
    assert by(result, "customer_id") == expected
