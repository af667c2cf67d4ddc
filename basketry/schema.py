"""The eight input tables: column types, and the bundle operators take."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

KEY = LongType()
TEXT = StringType()
MOMENT = TimestampNTZType()
MONEY = DecimalType(24, 13)

# Carried by receipts and their lines where these are laid out by the month of the receipt.
MONTH = "receipt_month"


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, StructType] = {
    "personal_data": _struct(
        customer_id=KEY,
        customer_name=TEXT,
        customer_surname=TEXT,
        customer_primary_email=TEXT,
        customer_primary_phone=TEXT,
    ),
    "cards": _struct(customer_card_id=KEY, customer_id=KEY),
    "groups_sku": _struct(group_id=KEY, group_name=TEXT),
    "product_grid": _struct(sku_id=KEY, sku_name=TEXT, group_id=KEY),
    "stores": _struct(
        transaction_store_id=KEY,
        sku_id=KEY,
        sku_purchase_price=MONEY,
        sku_retail_price=MONEY,
    ),
    "transactions": _struct(
        transaction_id=KEY,
        customer_card_id=KEY,
        transaction_summ=MONEY,
        transaction_datetime=MOMENT,
        transaction_store_id=KEY,
    ),
    "checks": _struct(
        transaction_id=KEY,
        sku_id=KEY,
        sku_amount=MONEY,
        sku_summ=MONEY,
        sku_summ_paid=MONEY,
        sku_discount=MONEY,
    ),
    "date_of_analysis_formation": _struct(analysis_formation=MOMENT),
}


@dataclass(frozen=True)
class Tables:
    """The inputs of every operator. Money may be any decimal type."""

    personal_data: DataFrame
    cards: DataFrame
    groups_sku: DataFrame
    product_grid: DataFrame
    stores: DataFrame
    transactions: DataFrame
    checks: DataFrame
    date_of_analysis_formation: DataFrame

    @property
    def by_month(self) -> bool:
        return MONTH in self.transactions.columns and MONTH in self.checks.columns

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for field in fields(self):
            yield field.name, getattr(self, field.name)
