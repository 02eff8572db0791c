"""From a CSV file to a raw table and a staging view over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearbrook.fixed_values import RAW_TABLE
from clearbrook.operators.publish import ensure_databases, require_table, write_table
from clearbrook.operators.staging import stage_sales
from clearbrook.sources.files import read_csv_lenient


def load_raw(spark: SparkSession, csv_path: str, table: str = RAW_TABLE, multi_line: bool = False) -> DataFrame:
    """Copy a CSV file into a columnar raw table, replacing the former copy.

    Later steps read only the columns they need, which a CSV scan cannot.
    """
    if "." in table:
        ensure_databases(spark, table.split(".")[0])
    return write_table(read_csv_lenient(spark, csv_path, multi_line=multi_line), table)


def stage_table(spark: SparkSession, table: str = RAW_TABLE, view: str | None = None) -> DataFrame:
    """Staged rows of a raw table; nothing is stored.

    ``view`` also registers them as a temporary view, which lives as long as the session.
    """
    staged = stage_sales(require_table(spark, table))
    if view:
        staged.createOrReplaceTempView(view)
    return staged


def ingest(spark: SparkSession, csv_path: str, table: str = RAW_TABLE, view: str | None = None) -> DataFrame:
    load_raw(spark, csv_path, table)
    return stage_table(spark, table, view)
