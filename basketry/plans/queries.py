"""Every operator as a named query over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from basketry.operators import cross_sell, customers, groups, offers, periods, quality
from basketry.operators.periods import PAIR
from basketry.plans.sql_functions import register_functions
from basketry.schema import Tables
from basketry.session import new_path, tune_joins
from basketry.sources import files, testtables
from basketry.workspace import Workspace

# Shared by the queries and their SQL counterparts.
PARAMETERS: dict[str, object] = {
    "days": 365,
    "last": 2,
    "first_pairs": 500,
    "first_day": "1996-01-01",
    "last_day": "1998-12-31",
    "visits": 5,
    "coefficient": 1.15,
    "max_churn": 3,
    "max_share": 70,
    "margin_share": 30,
    "visit_start": "2001-09-01",
    "visit_end": "2002-08-31",
    "added": 1,
    "cross_groups": 2,
    "cross_churn": 3,
    "cross_stability": 0.8,
    "max_sku_share": 30,
}
P = PARAMETERS
LIMITS = {
    "max_churn": P["max_churn"],
    "max_discount_share": P["max_share"],
    "margin_share": P["margin_share"],
}
PERIOD = {"first": P["first_day"], "last": P["last_day"]}
CROSS_LIMITS = {
    "max_churn": P["cross_churn"],
    "max_stability": P["cross_stability"],
    "max_sku_share": P["max_sku_share"],
    "margin_share": P["margin_share"],
}
VISIT_PERIOD = (P["visit_start"], P["visit_end"], P["added"])

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Money as double, as the SQL side returns it."""
    return df.select(
        *(
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        )
    )


def _selected(ws: Workspace) -> DataFrame:
    return cross_sell.cross_sell_groups(
        ws.group_details, P["cross_groups"], P["cross_churn"], P["cross_stability"], ws.mode
    )


def _best_skus(ws: Workspace) -> DataFrame:
    return cross_sell.max_margin_sku(
        ws.tables, _selected(ws), customers.primary_store(ws.tables, ws.mode)
    )


def _sku_shares(ws: Workspace) -> DataFrame:
    among = cross_sell.best_skus(ws.tables)
    shares = cross_sell.sku_share(ws.tables, ws.history, _best_skus(ws), among)
    return shares.select(*PAIR, "sku_id", "sku_share")


def _reached_written(ws: Workspace) -> DataFrame:
    """Chosen pairs whose customer's main store lists anything, as the SQL takes them."""
    selected = ws.cross_sell_selected(P["cross_groups"], P["cross_churn"], P["cross_stability"])
    return cross_sell.max_margin_as_written(
        ws.tables, selected, customers.primary_store(ws.tables, ws.mode)
    )


def _reward(ws: Workspace, **choices) -> DataFrame:
    return ws.reward_group(**LIMITS, **choices)


def _through_files(ws: Workspace) -> Tables:
    """The tables written as delimited files into the shared folder and read again."""
    spark = ws.tables.checks.sparkSession
    folder = new_path(spark, "files")
    files.write_tables(ws.tables, folder)
    return files.read_tables(spark, folder)


def _by_month(ws: Workspace) -> Tables:
    """The tables laid out by month in the shared folder and read again."""
    spark = ws.tables.checks.sparkSession
    folder = new_path(spark, "months")
    files.write_by_month(ws.tables, folder)
    return files.read_parquet(spark, folder)


def _called(text: str) -> Callable[[Workspace], DataFrame]:
    """A call of a table function as SQL text."""

    def run(ws: Workspace) -> DataFrame:
        register_functions(ws)
        return ws.tables.checks.sparkSession.sql(text.format(**P))

    return run


CALLS = {
    "sql_offers_average_check_period": """SELECT * FROM offers_average_check(1, DATE'{first_day}', DATE'{last_day}',
        coefficient => {coefficient}, max_churn => {max_churn}, max_discount_share => {max_share},
        margin_share => {margin_share})""",
    "sql_offers_average_check_count": """SELECT * FROM offers_average_check(2, last_visits => {visits},
        coefficient => {coefficient}, max_churn => {max_churn}, max_discount_share => {max_share},
        margin_share => {margin_share})""",
    "sql_offers_visit_frequency": """SELECT * FROM offers_visit_frequency(DATE'{visit_start}', DATE'{visit_end}',
        {added}, {max_churn}, {max_share}, {margin_share})""",
    "sql_offers_cross_sell": """SELECT * FROM offers_cross_sell({cross_groups}, {cross_churn}, {cross_stability},
        {max_sku_share}, {margin_share})""",
    "sql_groups": "SELECT * FROM groups_by_margin()",
    "sql_groups_margin_days": "SELECT * FROM groups_by_margin(1, {days})",
    "sql_groups_margin_last_n": "SELECT * FROM groups_by_margin(method => 2, number => {last})",
}


def _checked(ws: Workspace) -> tuple[Tables, DataFrame]:
    """Files with rows that cannot be read, loaded all the same."""
    spark = ws.tables.checks.sparkSession
    folder = new_path(spark, "files")
    files.write_tables(testtables.misspelt(ws.tables), folder)
    return files.read_checked(spark, folder)


SPEC: dict[str, Callable[[Workspace], DataFrame]] = {
    "purchase_history": lambda ws: ws.purchase_history,
    "periods": lambda ws: ws.periods,
    "min_discount": lambda ws: periods.group_min_discount(ws.history),
    "average_check_segment": lambda ws: customers.average_check(ws.tables),
    "visit_frequency_segment": lambda ws: customers.visit_frequency(ws.tables),
    "inactive_period": lambda ws: customers.inactive_period(ws.tables),
    "customer_churn": lambda ws: customers.customer_churn(ws.tables),
    "segment_number": lambda ws: customers.segment_number(ws.tables, ws.mode),
    "store_share": lambda ws: customers.store_share(ws.tables),
    "last_three_stores": lambda ws: customers.last_three_stores(ws.tables, ws.mode),
    "primary_store": lambda ws: customers.primary_store(ws.tables, ws.mode),
    "customers": lambda ws: ws.customers,
    "demanded_groups": lambda ws: groups.demanded_groups(ws.tables),
    "affinity_index": lambda ws: groups.affinity_index(ws.history, ws.analysis, ws.mode),
    "group_churn_rate": lambda ws: groups.group_churn_rate(ws.history, ws.analysis),
    "stability_index": lambda ws: groups.stability_index(ws.history, ws.analysis),
    "group_margin_all": lambda ws: groups.group_margin(ws.history, ws.analysis),
    "group_margin_days": lambda ws: groups.group_margin(ws.history, ws.analysis, 1, P["days"]),
    "group_margin_last_n": lambda ws: groups.group_margin(
        ws.store_history().history, ws.analysis, 2, P["last"]
    ),
    "recent_margin": lambda ws: groups.recent_margin(ws.tables, P["days"]),
    "months_recent_margin": lambda ws: groups.recent_margin(_by_month(ws), P["days"]),
    "months_avg_check_by_period": lambda ws: offers.avg_check_by_period(
        _by_month(ws), mode=ws.mode, **PERIOD
    ),
    "months_purchase_history": lambda ws: Workspace(_by_month(ws)).purchase_history,
    "discount_share": lambda ws: groups.discount_share(ws.history),
    "minimum_discount": lambda ws: groups.minimum_discount(ws.history),
    "average_discount": lambda ws: groups.average_discount(ws.history),
    "groups": lambda ws: ws.stored_groups(),
    "groups_all_pairs": lambda ws: Workspace(ws.tables, ws.mode, min_purchases=1).stored_groups(),
    "groups_margin_days": lambda ws: ws.stored_groups(1, P["days"]),
    "groups_margin_last_n": lambda ws: ws.stored_groups(2, P["last"]),
    "avg_check_by_period": lambda ws: offers.avg_check_by_period(ws.tables, mode=ws.mode, **PERIOD),
    "avg_check_by_count": lambda ws: offers.avg_check_by_count(ws.tables, P["visits"], ws.mode),
    "reward_group": lambda ws: _reward(ws),
    "reward_group_price_list": lambda ws: _reward(ws, margin_basis="price_list"),
    "reward_group_customer_ratio": lambda ws: _reward(ws, margin_basis="customer_ratio"),
    "offers_average_check_period": lambda ws: ws.offers_average_check(
        1, coefficient=P["coefficient"], **PERIOD, **LIMITS
    ),
    "offers_average_check_count": lambda ws: ws.offers_average_check(
        2, count=P["visits"], coefficient=P["coefficient"], **LIMITS
    ),
    "group_price_margin": lambda ws: ws.price_margin,
    "required_transactions": lambda ws: offers.required_transactions(
        customers.customer_frequency(ws.tables), *VISIT_PERIOD, ws.mode
    ),
    "offers_visit_frequency": lambda ws: ws.offers_visit_frequency(*VISIT_PERIOD, **LIMITS),
    "cross_sell_groups": lambda ws: _selected(ws).select(*PAIR, "group_affinity_index"),
    "max_margin_sku": lambda ws: _best_skus(ws).select(
        *PAIR, "customer_primary_store", "sku_id", "max_margin"
    ),
    "sku_share": lambda ws: _sku_shares(ws.store_history()),
    "cross_sell_discount": lambda ws: _best_skus(ws).select(
        *PAIR,
        "sku_id",
        cross_sell.cross_sell_discount(P["margin_share"]).alias("offer_discount_depth"),
    ),
    "offers_cross_sell": lambda ws: ws.offers_cross_sell(P["cross_groups"], **CROSS_LIMITS),
    "validate_keys": lambda ws: quality.key_violations(ws.tables),
    "validate": lambda ws: ws.validate(),
    "validate_flawed": lambda ws: quality.validate(testtables.flawed(ws.tables), ws.mode),
    "files_transactions": lambda ws: _through_files(ws).transactions,
    "files_checks": lambda ws: _through_files(ws).checks,
    "files_personal_data": lambda ws: _through_files(ws).personal_data,
    "files_cards": lambda ws: _through_files(ws).cards,
    "files_groups_sku": lambda ws: _through_files(ws).groups_sku,
    "files_product_grid": lambda ws: _through_files(ws).product_grid,
    "files_stores": lambda ws: _through_files(ws).stores,
    "files_analysis_date": lambda ws: _through_files(ws).date_of_analysis_formation,
    "files_unreadable": lambda ws: _checked(ws)[1].groupBy("table", "rule", "key").agg(
        F.count(F.lit(1)).alias("rows")
    ),
    "files_readable_transactions": lambda ws: _checked(ws)[0].transactions,
    "files_readable_checks": lambda ws: _checked(ws)[0].checks,
    **{name: _called(text) for name, text in CALLS.items()},
}

# Queries whose result differs when the SQL is taken at its word.
AS_WRITTEN = SPEC | {
    "reward_group": lambda ws: _reward(ws, per="group", rounding="down"),
    "group_margin_last_n": lambda ws: groups.group_margin(
        ws.store_history().history, ws.analysis, 2, P["first_pairs"], ws.mode
    ),
    "groups_margin_last_n": lambda ws: ws.stored_groups(2, P["first_pairs"]),
    "max_margin_sku": lambda ws: _reached_written(ws).select(
        *PAIR, "customer_primary_store", "max_margin"
    ),
    "sku_share": lambda ws: cross_sell.share_repeats_as_written(
        ws.tables, ws.store_history().history, _reached_written(ws), P["max_sku_share"]
    ),
    "offers_cross_sell_counted": lambda ws: ws.offers_cross_sell_counted(
        P["cross_groups"], **CROSS_LIMITS
    ),
}
AS_WRITTEN_NAMES = [
    "periods",
    "segment_number",
    "last_three_stores",
    "primary_store",
    "customers",
    "affinity_index",
    "discount_share",
    "min_discount",
    "minimum_discount",
    "groups",
    "avg_check_by_period",
    "avg_check_by_count",
    "reward_group",
    "offers_average_check_period",
    "offers_average_check_count",
    "required_transactions",
    "offers_visit_frequency",
    "cross_sell_groups",
    "group_margin_last_n",
    "groups_margin_last_n",
    "max_margin_sku",
    "sku_share",
    "offers_cross_sell",
    "offers_cross_sell_counted",
    "validate",
    "validate_flawed",
]


def _query(build: Callable[[Workspace], DataFrame], mode: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Workspace(testtables.load(tune_joins(spark), folder), mode)))

    return run


def registry() -> dict[str, Query]:
    queries = {name: _query(build, "spec") for name, build in SPEC.items()}
    for name in AS_WRITTEN_NAMES:
        queries[f"{name}_as_written"] = _query(AS_WRITTEN[name], "as_written")
    return queries
