from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from basketry import Tables
from basketry.operators.history import purchase_history
from basketry.schema import SCHEMAS
from basketry.sources import files
from shop import shop

# One- and two-digit hours, many decimals, separators and quotes inside fields,
# an empty field, no line break at the end.
TEXTS = {
    "Personal_Data_Mini": '1\tИван\tСмирнов-Ёлкин\ti@ya.ru\t+71234567890\n2\t"An\tna"\t"O""Neil"\t\t""',
    "Cards_Mini": "1\t1\n2\t1",
    "Groups_SKU_Mini": "1\tЧай",
    "SKU_Mini": "1\tЧай, зелёный\t1",
    "Stores_Mini": "1\t1\t78.0071743954938\t104.882359988255",
    "Transactions_Mini": "1\t1\t336.3206767\t23.08.2018 0:47:37\t1\n2\t2\t0\t22.09.2019 12:32:00\t1",
    "Checks_Mini": "1\t1\t3.20664673\t336.3206767\t190.2882909\t146.0323858\n2\t1\t1\t5\t5\t0",
    "Date_Of_Analysis_Formation": "21.08.2022 13:10:46",
}


def write_samples(folder, separator="\t", extension="tsv"):
    for name, text in TEXTS.items():
        text = text.replace("\t", separator)
        (folder / f"{name}.{extension}").write_text(text, encoding="utf-8")
    return str(folder)


def contents(tables):
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


def test_reading_delimited_files(spark, tmp_path):
    tables = files.read_tables(spark, write_samples(tmp_path), "_Mini")
    for name, df in tables.items():
        assert df.schema == SCHEMAS[name]
    people = [tuple(row) for row in tables.personal_data.orderBy("customer_id").collect()]
    assert people == [
        (1, "Иван", "Смирнов-Ёлкин", "i@ya.ru", "+71234567890"),
        (2, "An\tna", 'O"Neil', None, ""),
    ]
    first, second = tables.transactions.orderBy("transaction_id").collect()
    assert first.transaction_datetime == datetime(2018, 8, 23, 0, 47, 37)
    assert second.transaction_datetime == datetime(2019, 9, 22, 12, 32)
    assert tables.stores.first().sku_purchase_price == Decimal("78.0071743954938")
    history = purchase_history(tables).orderBy("transaction_id").collect()
    assert len(history) == 2
    assert float(history[0].group_cost) == pytest.approx(3.20664673 * 78.0071743954938)


@pytest.mark.parametrize("separator, extension", [("\t", "tsv"), (",", "csv"), (";", "csv")])
def test_round_trip(spark, tmp_path, separator, extension):
    tables = files.read_tables(spark, write_samples(tmp_path), "_Mini")
    target = str(tmp_path / "out")
    files.write_tables(tables, target, "_Copy", separator, extension)
    copy = files.read_tables(spark, target, "_Copy", separator, extension)
    assert contents(copy) == contents(tables)


def test_fractions_of_a_second_stay(spark, tmp_path):
    moments = ["01-01 00:00:00", "01-01 10:00:00.25", "01-01 23:59:59.999999", "01-02 01:02:03.1"]
    tables = shop(spark, [(i, 1, 5, m, 1) for i, m in enumerate(moments)])
    files.write_tables(tables, str(tmp_path / "out"))
    assert contents(files.read_tables(spark, str(tmp_path / "out"))) == contents(tables)


def test_line_breaks_in_fields(spark, tmp_path):
    tables = shop(spark, [(1, 1, 5, "01-01", 1)], products=[(1, "two\nlines", 1), (2, "x", 1)])
    files.write_tables(tables, str(tmp_path / "out"))
    copy = files.read_tables(spark, str(tmp_path / "out"), multiline=True)
    assert contents(copy) == contents(tables)


def test_zero_is_written_plainly(spark, tmp_path):
    files.write_tables(shop(spark, [(1, 1, 0, "01-01", 1)]), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out" / "Transactions.tsv").glob("part-*"))
    assert text == "1\t1\t0.0000000000000\t01.01.2022 0:00:00\t1\n"


@pytest.mark.parametrize("bad", ["1\tx", "x\t1"])
def test_malformed_rows_fail(spark, tmp_path, bad):
    folder = write_samples(tmp_path)
    (tmp_path / "Cards_Mini.tsv").write_text(bad)
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_tables(spark, folder, "_Mini").cards.collect()


def test_parquet_round_trip(spark, tmp_path):
    tables = shop(spark, [(1, 1, 5, "01-01", 1)], [(1, 1, 1, 10, 1)])
    files.write_parquet(tables, str(tmp_path / "lake"))
    assert contents(files.read_parquet(spark, str(tmp_path / "lake"))) == contents(tables)


def test_bucketed_tables_join_without_shuffle(spark):
    receipts = [(i, i % 5, 5, "01-01", 1) for i in range(50)]
    tables = shop(spark, receipts, [(i, 1, 1, 10, 1) for i in range(50)])
    files.save_bucketed(tables, "bucketed_", 4)
    stored = files.read_catalog(spark, "bucketed_")
    assert isinstance(stored, Tables) and contents(stored) == contents(tables)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        joined = stored.checks.join(stored.transactions, "transaction_id")
        plan = joined.groupBy("transaction_id", "customer_card_id").count()
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
        for name, _ in tables.items():
            spark.sql(f"DROP TABLE bucketed_{name}")
    assert "SortMergeJoin" in text and "Exchange" not in text


FLAWED = {
    "Transactions_Mini": "1\t1\t10\t23.08.2018 0:47:37\t1\n2\t2\t0\t2019-09-22\t1\n3\t2\t0\t22.09.2019 1:00:00\n"
    "4\t2\t0\t22.09.2019 1:00:00\t1\t9\nx\t1\t10\t23.08.2018 0:47:37\t1",
    "Checks_Mini": "1\t1\t3\t3\t1\t2\n2\t1\tmany\t5\t5\t0",
}


def test_rows_that_cannot_be_read_are_findings(spark, tmp_path):
    folder = write_samples(tmp_path)
    for name, text in FLAWED.items():
        (tmp_path / f"{name}.tsv").write_text(text, encoding="utf-8")
    tables, findings = files.read_checked(spark, folder, "_Mini")
    assert [r["transaction_id"] for r in tables.transactions.collect()] == [1]
    # Whatever is asked of a table, the same rows are in it.
    assert tables.transactions.select("transaction_id").count() == tables.transactions.count() == 1
    assert [tuple(r) for r in tables.checks.select("transaction_id").collect()] == [(1,)]
    lines = {name: text.split("\n") for name, text in FLAWED.items()}
    assert sorted(map(tuple, findings.collect()), key=repr) == sorted(
        [("transactions", "readable row", key, lines["Transactions_Mini"][i]) for i, key in ((1, "2"), (2, "3"), (3, "4"), (4, None))]
        + [("checks", "readable row", "2", lines["Checks_Mini"][1])],
        key=repr,
    )
    for name, df in tables.items():
        assert df.schema == SCHEMAS[name]


def test_sound_files_have_no_findings(spark, tmp_path):
    folder = write_samples(tmp_path)
    tables, findings = files.read_checked(spark, folder, "_Mini")
    assert contents(tables) == contents(files.read_tables(spark, folder, "_Mini"))
    assert findings.collect() == []
