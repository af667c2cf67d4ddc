from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketry.operators import groups, offers
from basketry.operators.history import purchase_history
from basketry.schema import MONTH
from basketry.sources import files
from shop import by, rows, shop

RECEIPTS = [
    (1, 1, 10, "2021-11-30 23:59:59", 1),
    (2, 1, 30, "2021-12-01", 1),
    (3, 2, 50, "01-15 10:00", 2),
    (4, 2, 70, "01-31", 1),
    (5, 2, 90, "2022-02-01", 1),  # after the analysis date
    (6, 1, 20, "2021-12-05", 1),  # listed in two months
    (6, 1, 20, "01-20", 1),
]
LINES = [(r, 1 + r % 3, 1, 10 * r, 0) for r in (1, 2, 3, 4, 5, 6)] + [(4, 1, 2, 5, 1), (99, 1, 1, 7, 0)]


@pytest.fixture
def plain(spark):
    return shop(spark, RECEIPTS, LINES)


@pytest.fixture
def laid_out(spark, plain, tmp_path):
    files.write_by_month(plain, str(tmp_path / "months"), files=2)
    return files.read_parquet(spark, str(tmp_path / "months"))


def folders(df):
    """Folders the files read by a query stand in."""
    names = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {re.search(f"{MONTH}=([^/]*)", row.f).group(1) for row in names}


def test_every_row_is_laid_out_once(plain, laid_out):
    for name, df in plain.items():
        assert rows(getattr(laid_out, name).select(*df.columns)) == rows(df)
    assert folders(laid_out.transactions) == {str(y * 12 + m - 1) for y, m in ((2021, 11), (2021, 12), (2022, 1), (2022, 2))}
    loose = laid_out.checks.filter(F.col(MONTH).isNull())
    assert {row.transaction_id for row in loose.collect()} == {6, 99}


@pytest.mark.parametrize("mode", ["spec", "as_written"])
@pytest.mark.parametrize(
    "first, last",
    [
        (None, None),
        ("2021-12-01", "2021-12-31"),
        ("2021-01-01", "2022-01-15"),
        ("2022-01-01", None),
        ("2022-01-31", "2021-01-01"),
        (datetime(2021, 11, 30, 23, 59, 59), datetime(2021, 12, 5)),
    ],
)
def test_checks_of_a_period_are_the_same(plain, laid_out, mode, first, last):
    expected = by(offers.avg_check_by_period(plain, first, last, mode), "customer_id")
    assert by(offers.avg_check_by_period(laid_out, first, last, mode), "customer_id") == expected


@pytest.mark.parametrize("days", [0, 31, 1000])
def test_recent_margin_is_that_of_the_window(plain, laid_out, days):
    end = F.lit("2022-01-31").cast("timestamp_ntz")
    start = end - F.make_dt_interval(F.lit(days))
    window = purchase_history(plain).filter(F.col("transaction_datetime").between(start, end))
    expected = by(
        window.groupBy("customer_id", "group_id").agg(F.sum(F.col("group_summ_paid") - F.col("group_cost"))),
        "customer_id",
        "group_id",
    )
    assert by(groups.recent_margin(plain, days), "customer_id", "group_id") == expected
    assert by(groups.recent_margin(laid_out, days), "customer_id", "group_id") == expected


def scanned(df):
    """Partitions each scan of receipts or lines has read, after the query ran."""
    df.collect()
    scans, queue = [], [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            queue.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            queue.append(node.plan())
            continue
        if name == "FileSourceScanExec" and MONTH in node.simpleString(500):
            scans.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        queue.extend(children.apply(i) for i in range(children.size()))
    return sorted(scans)


def test_only_the_months_of_a_period_are_read(laid_out):
    """Of four months, one of receipts, and of lines that one and those without a month."""
    assert scanned(offers.avg_check_by_period(laid_out, "2021-12-01", "2021-12-31")) == [1, 2]
    assert scanned(groups.recent_margin(laid_out, 16)) == [1, 2]


def test_no_rows(spark, tmp_path):
    empty = shop(spark, [], [], cards=[(1, 1)])
    files.write_by_month(empty, str(tmp_path / "none"))
    assert not list(Path(tmp_path / "none" / "checks").glob("*/*.parquet"))
