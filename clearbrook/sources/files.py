"""Readers and writers for the formats in use: CSV, JSON records, text, Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SALES_COLUMNS = (
    "order_id", "date", "store_id", "product_id", "unit_price", "quantity", "customer_id", "channel",
)

BASELINE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "n_rows", "n_dup_pairs", "n_dup_rows", "n_missing_customer", "n_price_zero_or_null",
            "n_qty_invalid", "n_date_null",
        )
    ]
    + [T.StructField(name, T.DoubleType()) for name in ("p01", "p99")]
)


def text_schema(columns: Sequence[str] = RAW_SALES_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


_CORRUPT = "_corrupt_record"


def _parsed_csv(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool) -> DataFrame:
    """The wanted columns by the names in the header, and malformed lines as they stand in the file.

    Only the header is read while the plan is made.  Every file's header is
    compared with it when its lines are read; one that differs is an error.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path}: columns missing from the header: {', '.join(missing)}")
    schema = T.StructType([*text_schema(header).fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = (
        spark.read.schema(schema).options(**options)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False).option("enforceSchema", False)
        .csv(path)
    )
    # The parser refuses plans that need nothing but the malformed line, so it comes with nothing of the first column.
    line = F.concat(F.coalesce(F.col(_CORRUPT), F.lit("")), F.substring(F.coalesce(F.col(columns[0]), F.lit("")), 0, 0))
    return parsed.select(*columns, line.alias(_CORRUPT))


def _each(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_csv_lenient(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = RAW_SALES_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, the named columns as text, short and long lines skipped.

    Columns are found by name, in any order and beside others; a missing one
    is an error.  Several paths may have different headers.  Skipped lines are
    what :func:`csv_rejects` returns.

    Column pruning is off for the parser: a pruned parse does not notice that
    a line has the wrong number of fields, and counts would depend on which
    columns a query happens to use.  ``multi_line`` allows line breaks inside
    quotes, at the price of files that cannot be split.
    """
    parts = [_parsed_csv(spark, p, columns, multi_line).where(F.col(_CORRUPT) == "").drop(_CORRUPT) for p in _each(path)]
    return reduce(DataFrame.unionByName, parts)


def csv_rejects(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = RAW_SALES_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """The lines that :func:`read_csv_lenient` skips, in ``line``."""
    parts = [_parsed_csv(spark, p, columns, multi_line).where(F.col(_CORRUPT) != "").select(F.col(_CORRUPT).alias("line")) for p in _each(path)]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; a folder with one file per task, nothing is gathered."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a known schema; a missing path is an error, not an empty table."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


#: Bytes of the largest text artifact that is read.
LARGEST_ARTIFACT = 16 << 20


def _judged(files: DataFrame, largest: int) -> DataFrame:
    """The rows that the readers of text artifacts return, from a table of files as the whole-file reader has them."""
    text = F.col("content").cast("string")
    about = ["path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified")]
    # The condition on the length reaches the reader, which then leaves the bytes of larger files alone.
    read = files.where(F.col("length") <= largest).select(
        *about, F.when(F.is_valid_utf8(text), text).alias("content"), F.when(F.is_valid_utf8(text), "read").otherwise("unreadable").alias("state")
    )
    listed = files.where(F.col("length") > largest).select(*about, F.lit(None).cast("string").alias("content"), F.lit("too large").alias("state"))
    return read.unionByName(listed)


def read_text_artifacts(spark: SparkSession, path: str, largest: int = LARGEST_ARTIFACT, pattern: str | None = None) -> DataFrame:
    """One row per file at or below ``path``: ``path``, ``n_bytes``, ``modified``, ``content`` and ``state``.

    A file is one value, so files of more than ``largest`` bytes are listed but
    not opened (``state`` is ``too large``); those that are not UTF-8 are
    ``unreadable``.  Neither has content, and nothing of a file is read in
    part.  ``pattern`` is a glob for file names.  Files without a byte are not
    listed; that is how the reader has it.

    Every file costs a listing and an opening; very many small ones are better
    kept in bundles (:func:`read_bundled_artifacts`).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return _judged((reader.option("pathGlobFilter", pattern) if pattern else reader).load(path), largest)


def write_bundled_artifacts(artifacts: DataFrame, path: str) -> None:
    """Text files (``path``, ``content``) as a table of whole files: their number does not count, only what they hold."""
    artifacts.select(
        "path", F.current_timestamp().alias("modificationTime"), F.octet_length("content").cast("long").alias("length"),
        F.col("content").cast("binary").alias("content"),
    ).write.parquet(path)


def read_bundled_artifacts(spark: SparkSession, path: str, largest: int = LARGEST_ARTIFACT) -> DataFrame:
    """What :func:`read_text_artifacts` returns, of files that are bundled in a table with the columns of ``binaryFile``.

    A file is one value of that table.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return _judged(spark.read.schema(schema).parquet(path), largest)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
