"""Small hand-made inputs. Two groups: 1 (skus 1, 2) and 2 (sku 3)."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from basketry.schema import SCHEMAS, Tables

ANALYSIS = datetime(2022, 1, 31)


def at(text: str) -> datetime:
    """'01-15' or '01-15 13:30' in 2022, or a full date."""
    text = text if text.count("-") == 2 else f"2022-{text}"
    return datetime.fromisoformat(text)


def shop(
    spark,
    receipts,
    lines=(),
    cards=None,
    analysis=ANALYSIS,
    prices=((1, 1, 6, 10), (1, 2, 8, 10), (1, 3, 5, 20), (2, 1, 6, 10), (2, 2, 8, 10), (2, 3, 5, 20)),
    products=((1, "Milk", 1), (2, "Cream", 1), (3, "Bread", 2)),
    people=None,
) -> Tables:
    """receipts: (id, card, sum, moment, store); lines: (receipt, sku, amount, summ, discount).

    Unless given, every card belongs to the customer of the same number.
    """
    cards = cards if cards is not None else sorted({(card, card) for _, card, *_ in receipts})
    people = people if people is not None else sorted({person for _, person in cards})
    rows = {
        "personal_data": [(p, "Anna", "Smith", f"a{p}@example.com", "+71234567890") for p in people],
        "cards": cards,
        "groups_sku": [(1, "Dairy"), (2, "Bakery")],
        "product_grid": products,
        "stores": [(s, k, Decimal(str(b)), Decimal(str(r))) for s, k, b, r in prices],
        "transactions": [(t, c, Decimal(str(s)), at(m), st) for t, c, s, m, st in receipts],
        "checks": [
            (t, k, Decimal(str(a)), Decimal(str(s)), Decimal(str(s)) - Decimal(str(d)), Decimal(str(d)))
            for t, k, a, s, d in lines
        ],
        "date_of_analysis_formation": [(analysis,)],
    }
    return Tables(
        **{
            name: spark.createDataFrame([tuple(row) for row in rows[name]], schema)
            for name, schema in SCHEMAS.items()
        }
    )


def rows(df, *order):
    order = order or df.columns
    return [tuple(row) for row in df.orderBy(*order).collect()]


def by(df, *keys):
    """Rows as a dictionary from the key columns to the rest (single values unwrapped)."""
    rest = [name for name in df.columns if name not in keys]
    result = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        value = tuple(row[name] for name in rest)
        result[key[0] if len(key) == 1 else key] = value[0] if len(value) == 1 else value
    return result


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
