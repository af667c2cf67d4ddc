"""Checks of the input tables: keys, references, mandatory fields, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import check_mode
from basketry.schema import Tables

# Unique keys, references and mandatory columns of the tables. The
# price list has no declared key, but a second row per store and SKU would
# multiply the money of every line it prices.
UNIQUE = {
    "personal_data": ["customer_id"],
    "cards": ["customer_card_id"],
    "groups_sku": ["group_id"],
    "product_grid": ["sku_id"],
    "stores": ["transaction_store_id", "sku_id"],
    "transactions": ["transaction_id"],
}
REFERENCES = [
    ("cards", "customer_id", "personal_data"),
    ("product_grid", "group_id", "groups_sku"),
    ("stores", "sku_id", "product_grid"),
    ("transactions", "customer_card_id", "cards"),
    ("checks", "transaction_id", "transactions"),
    ("checks", "sku_id", "product_grid"),
]
MANDATORY = {
    "personal_data": [
        "customer_id",
        "customer_name",
        "customer_surname",
        "customer_primary_email",
        "customer_primary_phone",
    ],
    "cards": ["customer_card_id"],
    "groups_sku": ["group_id"],
    "product_grid": ["sku_id", "sku_name"],
    "stores": ["transaction_store_id"],
    "transactions": ["transaction_id", "transaction_datetime"],
    "date_of_analysis_formation": ["analysis_formation"],
}

# Formats of personal data. The written rules anchor the phone
# number, insist on the capital and know the letter Ё; those of mode "as_written"
# ignore case and let anything follow the ten digits.
NAME = r"^[A-ZА-ЯЁ][-a-zа-яё]*([- ][A-ZА-ЯЁ][-a-zа-яё]*)*\z"
EMAIL = r"^([A-Za-z0-9_\.-]+)@([A-Za-z0-9_\.-]+)\.([A-Za-z\.]{2,6})\z"
PHONE = r"^\+7[0-9]{10}\z"
LOOSE_NAME = r"(?iu)^[A-ZА-Я][-a-zа-я]*([- ][A-ZА-Я][-a-zа-я]*)*\z"
LOOSE_EMAIL = r"(?iu)^([a-z0-9_\.-]+)@([a-z0-9_\.-]+)\.([a-z\.]{2,6})\z"
LOOSE_PHONE = r"^\+7[0-9]{10}"
FORMATS = {
    "spec": {
        "customer_name": NAME,
        "customer_surname": NAME,
        "customer_primary_email": EMAIL,
        "customer_primary_phone": PHONE,
    },
    "as_written": {
        "customer_name": LOOSE_NAME,
        "customer_surname": LOOSE_NAME,
        "customer_primary_email": LOOSE_EMAIL,
        "customer_primary_phone": LOOSE_PHONE,
    },
}


def _finding(df: DataFrame, table: str, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


def _key_text(columns: list[str]) -> Column:
    """The key's parts; a missing one shows as a dash, and a key that is missing as none."""
    parts = [F.col(name).cast("string") for name in columns]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("/", *(F.coalesce(part, F.lit("-")) for part in parts))


def key_violations(tables: Tables) -> DataFrame:
    """Duplicate keys and dangling references, one row per key with its row count.

    Rows are counted per key before any join, so a key that fills a table costs
    one row per map task.
    """
    named = dict(tables.items())
    rows = F.col("rows")
    findings = []
    for table, columns in UNIQUE.items():
        counts = named[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        findings.append(
            _finding(
                counts.filter(rows > 1),
                table,
                "unique " + "/".join(columns),
                _key_text(columns),
                rows,
            )
        )
    for table, column, target in REFERENCES:
        used = (
            named[table]
            .filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        dangling = used.join(named[target].select(column), column, "left_anti")
        findings.append(
            _finding(dangling, table, f"{column} in {target}", F.col(column), rows)
        )
    return reduce(DataFrame.unionByName, findings)


def _row_findings(
    df: DataFrame, table: str, key: str, rules: list[tuple[str, Column, Column]]
) -> DataFrame:
    """Rows that break rules (name, condition of the breach, detail): one pass over the table."""
    broken = reduce(Column.__or__, (breach for _, breach, _ in rules))
    found = F.array_compact(
        F.array(
            *(
                F.when(
                    breach,
                    F.struct(
                        F.lit(name).alias("rule"), detail.cast("string").alias("detail")
                    ),
                )
                for name, breach, detail in rules
            )
        )
    )
    return (
        df.filter(broken)
        .select(F.col(key).alias("key"), F.explode(found).alias("found"))
        .select(
            F.lit(table).alias("table"),
            F.col("found.rule").alias("rule"),
            F.col("key").cast("string").alias("key"),
            F.col("found.detail").alias("detail"),
        )
    )


def field_violations(tables: Tables, mode: str = "spec") -> DataFrame:
    """Missing mandatory values and malformed personal data, one row per occurrence."""
    findings = []
    for table, df in tables.items():
        columns = MANDATORY.get(table, [])
        rules = [(f"{c} present", F.col(c).isNull(), F.lit(None)) for c in columns]
        if table == "personal_data":
            rules += [
                (f"{c} format", ~F.coalesce(F.col(c).rlike(pattern), F.lit(True)), F.col(c))
                for c, pattern in FORMATS[check_mode(mode)].items()
            ]
        if rules:
            findings.append(_row_findings(df, table, columns[0], rules))
    moments = tables.date_of_analysis_formation.agg(F.count(F.lit(1)).alias("rows"))
    findings.append(
        _finding(
            moments.filter(F.col("rows") != 1),
            "date_of_analysis_formation",
            "one row",
            F.lit(None),
            F.col("rows"),
        )
    )
    return reduce(DataFrame.unionByName, findings)


def validate(tables: Tables, mode: str = "spec") -> DataFrame:
    """All violations as (table, rule, key, detail)."""
    return key_violations(tables).unionByName(field_violations(tables, mode))
