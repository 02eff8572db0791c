"""Tables in the catalog: bootstrap, idempotent write, promotion with a backup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearbrook.sources.files import write_csv


def ensure_databases(spark: SparkSession, *names: str, location: str | None = None) -> None:
    for name in names:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def require_table(spark: SparkSession, table: str) -> DataFrame:
    """The table or view, or an error that says what to do."""
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"'{table}' does not exist: load and stage the data first")
    return spark.table(table)


def write_table(df: DataFrame, table: str) -> DataFrame:
    """Create or replace a managed table; a second run gives the same content."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def promote(spark: SparkSession, new: str, table: str) -> DataFrame:
    """Swap ``new`` in as ``table`` and keep the former one as ``<table>_backup``.

    Renames move no data.  They are separate steps: between the two a reader
    may find no table, and a failure there leaves the backup to rename back.
    """
    backup = f"{table}_backup"
    require_table(spark, new)
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {backup}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def snapshot_csv(spark: SparkSession, table: str, path: str) -> str:
    write_csv(require_table(spark, table), path)
    return path
