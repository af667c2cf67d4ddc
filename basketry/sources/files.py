"""Loading and saving the eight tables: delimited text, Parquet, bucketed tables."""

from __future__ import annotations

import posixpath
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampNTZType

from basketry.functions.columns import month_number
from basketry.schema import MONTH, SCHEMAS, Tables

# File names of the tables. The analysis date takes no suffix.
FILE_NAMES = {
    "personal_data": "Personal_Data",
    "cards": "Cards",
    "groups_sku": "Groups_SKU",
    "product_grid": "SKU",
    "stores": "Stores",
    "transactions": "Transactions",
    "checks": "Checks",
    "date_of_analysis_formation": "Date_Of_Analysis_Formation",
}
WITHOUT_SUFFIX = "date_of_analysis_formation"
MOMENT_FORMAT = "dd.MM.yyyy H:mm:ss[.SSSSSS]"
WHOLE_SECONDS = "dd.MM.yyyy H:mm:ss"
WITH_FRACTION = "dd.MM.yyyy H:mm:ss.SSSSSS"

# Tells an unquoted empty field (NULL) from a quoted one (empty text).
_UNQUOTED_EMPTY = "\u0000"
# Holds the line of a row that cannot be read.
_RAW = "_unreadable"


def _file(path: str, table: str, suffix: str, extension: str) -> str:
    suffix = "" if table == WITHOUT_SUFFIX else suffix
    return posixpath.join(path, f"{FILE_NAMES[table]}{suffix}.{extension}")


def read_tables(
    spark: SparkSession,
    path: str,
    suffix: str = "",
    separator: str = "\t",
    extension: str = "tsv",
    multiline: bool = False,
) -> Tables:
    """Headerless delimited files or folders of them; a malformed row fails the read.

    Line breaks inside quoted fields need multiline=True, which makes every file
    one task; leave it off for large files.
    """
    reader = _reader(spark, separator, multiline).option("mode", "FAILFAST")
    return Tables(
        **{
            table: reader.schema(schema).csv(_file(path, table, suffix, extension))
            for table, schema in SCHEMAS.items()
        }
    )


def read_checked(
    spark: SparkSession,
    path: str,
    suffix: str = "",
    separator: str = "\t",
    extension: str = "tsv",
    multiline: bool = False,
) -> tuple[Tables, DataFrame]:
    """The readable rows of the files, and a finding (table, rule, key, detail) per other row.

    A row is not readable if it has more or fewer fields than its table, or one that is not of its
    column's type, such as a moment in another format. Its finding holds the first field, if
    that could be read, as key and the raw line as detail, in the form of the input checks. All
    fields of a row are parsed whatever columns are asked for, so that every use of a table sees the same rows.
    """
    reader = _reader(spark, separator, multiline).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW, columnPruning=False
    )
    found, unreadable = {}, []
    for table, schema in SCHEMAS.items():
        raw = reader.schema(StructType([*schema.fields, StructField(_RAW, StringType())])).csv(
            _file(path, table, suffix, extension)
        )
        # Always true, but asks for every field: only fields that are asked for are parsed.
        parsed = F.xxhash64(*schema.names) >= F.lit(-(1 << 63))
        found[table] = raw.filter(F.col(_RAW).isNull() & parsed).drop(_RAW)
        unreadable.append(
            raw.filter(F.col(_RAW).isNotNull() & parsed).select(
                F.lit(table).alias("table"),
                F.lit("readable row").alias("rule"),
                F.col(schema.names[0]).cast("string").alias("key"),
                F.col(_RAW).alias("detail"),
            )
        )
    return Tables(**found), reduce(DataFrame.unionByName, unreadable)


def _reader(spark: SparkSession, separator: str, multiline: bool) -> DataFrameReader:
    return spark.read.options(
        sep=separator,
        quote='"',
        escape='"',
        nullValue=_UNQUOTED_EMPTY,
        timestampNTZFormat=MOMENT_FORMAT,
        multiLine=multiline,
    )


def write_tables(
    tables: Tables,
    path: str,
    suffix: str = "",
    separator: str = "\t",
    extension: str = "tsv",
) -> None:
    """Headerless delimited dump, one folder per table, readable by read_tables."""
    for table, df in tables.items():
        as_text(df.select(*SCHEMAS[table].names)).write.options(
            sep=separator,
            quote='"',
            escape='"',
            nullValue="",
            emptyValue='""',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(_file(path, table, suffix, extension))


def as_text(df: DataFrame) -> DataFrame:
    """Decimals as plain digits, where a zero is not 0E-13; moments with a fraction if they have one."""

    def text(field: StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("string")
        if isinstance(field.dataType, TimestampNTZType):
            whole = column == F.date_trunc("second", column)
            return F.when(whole, F.date_format(column, WHOLE_SECONDS)).otherwise(
                F.regexp_replace(F.date_format(column, WITH_FRACTION), "0+$", "")
            )
        return column

    return df.select(*(text(field).alias(field.name) for field in df.schema.fields))


def read_parquet(spark: SparkSession, path: str) -> Tables:
    return Tables(
        **{table: spark.read.parquet(posixpath.join(path, table)) for table in SCHEMAS}
    )


def write_parquet(tables: Tables, path: str) -> None:
    for table, df in tables.items():
        df.write.parquet(posixpath.join(path, table))


def write_by_month(tables: Tables, path: str, files: int = 8) -> None:
    """Parquet, receipts and their lines in a folder per month of the receipt, of `files` files at most.

    A period then reads the folders of its months only. Lines whose receipt is unknown, has no
    moment, or stands in several months go to a folder without a month, which every period reads:
    a receipt listed twice meets all its lines whatever the period. Rows are dealt by month and
    receipt, so that a month with most of the rows is written by `files` tasks; choose them
    by the size of a month. Read it with read_parquet.
    """
    dated = tables.transactions.withColumn(MONTH, month_number("transaction_datetime"))
    month = F.when(F.min(MONTH) == F.max(MONTH), F.min(MONTH))
    # A listing without a moment joins the lines, but no period; it does not hide the month.
    months = dated.groupBy("transaction_id").agg(month.alias(MONTH))
    facts = {"transactions": dated, "checks": tables.checks.join(months, "transaction_id", "left")}
    deal = F.pmod(F.xxhash64("transaction_id"), F.lit(files))
    for table, df in tables.items():
        if table in facts:
            dealt = facts[table].select(*SCHEMAS[table].names, MONTH).repartition(F.col(MONTH), deal)
            dealt.write.partitionBy(MONTH).parquet(posixpath.join(path, table))
        else:
            df.write.parquet(posixpath.join(path, table))


def save_bucketed(tables: Tables, prefix: str, buckets: int) -> None:
    """Save as catalog tables, receipts and their lines bucketed by transaction.

    The join of check lines to transactions, the largest there is, then needs
    no shuffle, nor does the aggregation per transaction and group behind it.
    """
    for table, df in tables.items():
        writer = df.write.format("parquet")
        if table in ("transactions", "checks"):
            writer = writer.bucketBy(buckets, "transaction_id").sortBy("transaction_id")
        writer.saveAsTable(f"{prefix}{table}")


def read_catalog(spark: SparkSession, prefix: str) -> Tables:
    return Tables(**{table: spark.table(f"{prefix}{table}") for table in SCHEMAS})
