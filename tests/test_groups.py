from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from fractions import Fraction

import pytest

from basketry import Workspace
from basketry.operators import groups as G
from basketry.operators.history import analysis_moment, discounted_history
from shop import by, shop

KEYS = ("customer_id", "group_id")


def build(tables, mode="spec"):
    return discounted_history(tables, mode), analysis_moment(tables)


def test_demanded_groups_need_no_price(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 10, "01-01", 9), (2, 1, 10, "01-02", 1)],
        lines=[(1, 3, 1, 20, 0), (2, 1, 1, 10, 0), (2, 2, 1, 10, 0)],
    )
    assert {tuple(row) for row in G.demanded_groups(tables).collect()} == {(1, 1), (1, 2)}


TWO_GROUPS = dict(
    # Receipt 2 holds both groups; receipts 3 and 4 happen at the same moment.
    receipts=[
        (1, 1, 10, "01-01 10:00", 1),
        (2, 1, 30, "01-02 10:00", 1),
        (3, 1, 20, "01-03 10:00", 1),
        (4, 1, 10, "01-03 10:00", 1),
        (5, 1, 20, "01-04 10:00", 1),
    ],
    lines=[
        (1, 1, 1, 10, 0),
        (2, 1, 1, 10, 0),
        (2, 3, 1, 20, 0),
        (3, 3, 1, 20, 0),
        (4, 1, 1, 10, 0),
        (5, 3, 1, 20, 0),
    ],
)


def test_affinity_counts_transactions_once(spark):
    # Dairy from receipt 1 to 4: receipts 1, 2, 3, 4, the third at the very moment of the last.
    # Bakery from receipt 2 to 5: receipts 2, 3, 4, 5.
    affinity = G.affinity_index(*build(shop(spark, **TWO_GROUPS)))
    assert by(affinity, *KEYS) == {(1, 1): 3 / 4, (1, 2): 3 / 4}


def test_affinity_as_written_counts_groups_in_transactions(spark):
    history, analysis = build(shop(spark, **TWO_GROUPS), "as_written")
    affinity = G.affinity_index(history, analysis, "as_written")
    assert by(affinity, *KEYS) == {(1, 1): 3 / 5, (1, 2): 3 / 5}


def test_churn_and_stability_in_whole_days(spark):
    # Gaps of 1 day 23:10 and of 2 hours over midnight; the last purchase 27.9 days ago.
    tables = shop(
        spark,
        receipts=[
            (1, 1, 10, "01-01 00:00", 1),
            (2, 1, 10, "01-02 23:10", 1),
            (3, 1, 10, "01-03 01:10", 1),
        ],
        lines=[(1, 1, 1, 10, 0), (2, 1, 1, 10, 0), (3, 2, 1, 10, 0)],
    )
    history, analysis = build(tables)
    frequency = (2 + 70 / 1440 + 1) / 3
    stability = (abs(1 - frequency) + abs(0 - frequency)) / frequency / 2
    assert by(G.group_churn_rate(history, analysis), *KEYS)[(1, 1)] == pytest.approx(27 / frequency)
    assert by(G.stability_index(history, analysis), *KEYS)[(1, 1)] == pytest.approx(stability)


def test_single_purchases_drop_out_unless_kept(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 10, "01-01", 1), (2, 1, 10, "01-02", 1)],
        lines=[(1, 1, 1, 10, 0), (2, 1, 1, 10, 0), (2, 3, 1, 20, 0)],
    )
    history, analysis = build(tables)
    assert by(G.groups(history, analysis), *KEYS).keys() == {(1, 1)}
    kept = by(G.groups(history, analysis, min_purchases=1), *KEYS)
    assert kept.keys() == {(1, 1), (1, 2)}
    assert kept[(1, 2)][2] is None


def margins(spark):
    # Margins 4, 3, 2 on 01-01, 01-11, 01-30 of Dairy; 15 on 01-01 of Bakery.
    return shop(
        spark,
        receipts=[(1, 1, 30, "01-01", 1), (2, 1, 10, "01-11", 1), (3, 1, 10, "01-30", 1)],
        lines=[(1, 1, 1, 10, 0), (1, 3, 1, 20, 0), (2, 1, 1, 10, 1), (3, 2, 1, 10, 0)],
    )


@pytest.mark.parametrize(
    "method, number, dairy, bakery",
    [
        (0, 1, 9, 15),
        (1, 20, 5, None),  # exactly from 01-11 on
        (1, 19, 2, None),
        (1, 365, 9, 15),
        (2, 1, 2, 15),
        (2, 2, 5, 15),
        (2, 99, 9, 15),
    ],
)
def test_margin_methods(spark, method, number, dairy, bakery):
    history, analysis = build(margins(spark))
    result = by(G.group_margin(history, analysis, method, number), *KEYS)
    assert result == {(1, 1): dairy, (1, 2): bakery}
    table = G.groups(history, analysis, method, number, min_purchases=1)
    assert by(table.select(*KEYS, "group_margin"), *KEYS) == result


@pytest.mark.parametrize("number", [0, 1, 2, 3, 9])
def test_margin_as_written_of_the_first_pairs(spark, number):
    """Customer 1 buys both groups, Dairy once; customer 2 buys Dairy."""
    tables = shop(
        spark,
        receipts=[(1, 1, 0, "01-05", 1), (2, 1, 0, "01-09", 1), (3, 2, 0, "01-05", 1), (4, 2, 0, "01-09", 1)],
        lines=[(1, 1, 1, 10, 0), (1, 3, 1, 20, 0), (2, 3, 1, 20, 0), (3, 1, 1, 10, 0), (4, 1, 1, 10, 0)],
    )
    with Workspace(tables, mode="as_written") as ws:
        margin = G.group_margin(ws.history, ws.analysis, 2, number, "as_written")
        found = by(margin, *KEYS)
        every = [((1, 1), 4.0), ((1, 2), 30.0), ((2, 1), 8.0)]
        assert found == {key: value if i < number else None for i, (key, value) in enumerate(every)}
        # The pair bought once is not in the table but takes a place.
        table = by(ws.groups_by_margin(2, number).select(*KEYS, "group_margin"), *KEYS)
        assert table == {key: found[key] for key in ((1, 2), (2, 1))}


def test_unknown_margin_method(spark):
    with pytest.raises(ValueError):
        G.groups(*build(margins(spark)), margin_method=3)
    with pytest.raises(ValueError):
        G.group_margin(*build(margins(spark)), 7)


def test_discounts(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 40, "01-01", 1), (2, 1, 10, "01-02", 1), (3, 1, 20, "01-03", 1)],
        # Two discounted lines of Dairy in receipt 1 are one discounted transaction.
        lines=[(1, 1, 1, 10, 1), (1, 2, 1, 10, 2), (1, 3, 1, 20, 0), (2, 1, 1, 10, 0), (3, 3, 1, 20, 0)],
    )
    history, _ = build(tables)
    assert by(G.discount_share(history), *KEYS) == {(1, 1): 0.5, (1, 2): None}
    assert by(G.minimum_discount(history), *KEYS) == {(1, 1): 0.1, (1, 2): None}
    assert by(G.average_discount(history), *KEYS) == {(1, 1): 0.9, (1, 2): 1.0}
    written, _ = build(tables, "as_written")
    assert by(G.discount_share(written), *KEYS) == {(1, 1): 1.0, (1, 2): 1.0}


def test_products_without_group_make_visits_but_no_pairs(spark):
    tables = shop(
        spark,
        receipts=[(1, 1, 10, "01-01", 1), (2, 1, 20, "01-02", 1), (3, 1, 10, "01-03", 1)],
        lines=[(1, 1, 1, 10, 0), (2, 3, 1, 20, 1), (3, 1, 1, 10, 0)],
        products=[(1, "Milk", 1), (3, "Bag", None)],
    )
    history, analysis = build(tables)
    assert by(G.affinity_index(history, analysis), *KEYS) == {(1, 1): 2 / 3}
    assert by(G.discount_share(history), *KEYS) == {(1, 1): None}


def crowd(seed):
    """Customer 1 makes a third of the purchases; many fall on the same moments."""
    rng = random.Random(seed)
    start = datetime(2021, 6, 1)
    receipts, lines = [], []
    for number in range(400):
        card = 1 if number % 3 == 0 else rng.randrange(2, 25)
        moment = start + timedelta(minutes=rng.randrange(0, 12_000, 20))
        receipts.append((number, card, 1, moment.isoformat(" "), rng.choice([1, 2])))
        for sku in rng.sample([1, 2, 3], rng.randrange(1, 4)):
            lines.append((number, sku, 1, 10, rng.choice([0, 0, 1, 2])))
    return receipts, lines


def expected_indices(receipts, lines):
    """Affinity and stability straight from their definitions."""
    group = {1: 1, 2: 1, 3: 2}
    moments = {r[0]: datetime.fromisoformat(r[3]) for r in receipts}
    owner = {r[0]: r[1] for r in receipts}
    bought = defaultdict(set)
    for receipt, sku, *_ in lines:
        bought[owner[receipt], group[sku]].add(receipt)
    visits = defaultdict(set)
    for (customer, _), numbers in bought.items():
        visits[customer] |= numbers
    affinity, stability = {}, {}
    for (customer, key), numbers in bought.items():
        line = sorted(moments[n] for n in numbers)
        between = sum(line[0] <= moments[n] <= line[-1] for n in visits[customer])
        affinity[customer, key] = len(numbers) / between
        span = line[-1] - line[0] + timedelta(days=1)
        frequency = Fraction(span // timedelta(seconds=1), 86400 * len(line))
        gaps = [Fraction((b - a).days) for a, b in zip(line, line[1:], strict=False)]
        if gaps:
            stability[customer, key] = float(
                sum(abs(gap - frequency) / frequency for gap in gaps) / len(gaps)
            )
    return affinity, stability


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_indices_equal_their_definitions(spark, seed):
    receipts, lines = crowd(seed)
    history, analysis = build(shop(spark, receipts, lines))
    affinity, stability = expected_indices(receipts, lines)
    assert by(G.affinity_index(history, analysis), *KEYS) == affinity
    assert by(G.stability_index(history, analysis), *KEYS) == pytest.approx(stability)


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_groups_do_not_depend_on_partitioning(spark, partitions):
    receipts, lines = crowd(7)
    tables = shop(spark, receipts, lines)
    expected = sorted(map(repr, G.groups(*build(tables)).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        shuffled = type(tables)(
            **{
                name: df.repartition(partitions, df.columns[-1])
                if name != "date_of_analysis_formation"
                else df
                for name, df in tables.items()
            }
        )
        assert sorted(map(repr, G.groups(*build(shuffled)).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
