"""Corrections to a history that is partitioned by day: rows of a key replace those loaded before.

Files are never changed in place.  The days that a correction touches are written again, from what they hold and what
is new; all other days keep their files.  So a merge costs what its days cost, not what the history costs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbrook.fixed_values import KEYS
from clearbrook.operators.dedupe import dedupe
from clearbrook.session import written


def write_history(df: DataFrame, path: str, day: str = "date_parsed") -> None:
    """A history partitioned by day, to be merged into later."""
    df.repartition(day, F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.mode("overwrite").partitionBy(day).parquet(path)


def read_history(spark: SparkSession, path: str, schema) -> DataFrame:
    """The history with its columns in the order and types of ``schema``."""
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def touched_days(batch: DataFrame, removals: DataFrame | None, day: str) -> DataFrame:
    days = batch.select(day)
    return (days if removals is None else days.union(removals.select(day))).distinct()


def merged_rows(
    existing: DataFrame, batch: DataFrame, removals: DataFrame | None = None, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Existing rows without those whose key the batch or ``removals`` name, and the batch, one row per key.

    Rows with an incomplete key have none: existing ones stay, and those of
    the batch are added unless equal rows are there.  Of rows of one key in
    the batch the first stays, in the order of :func:`dedupe`.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fresh = dedupe(batch.where(complete), keys).select(*existing.columns)
    gone = fresh.select(*keys)
    if removals is not None:
        gone = gone.union(removals.where(complete).select(*keys)).distinct()
    stay = existing.where(complete).join(gone, list(keys), "left_anti").select(*existing.columns)
    kept = existing.where(~complete)
    unkeyed = batch.where(~complete).select(*existing.columns).subtract(kept)
    return stay.unionByName(fresh).unionByName(kept).unionByName(unkeyed)


def merge_history(
    spark: SparkSession, path: str, batch: DataFrame, removals: DataFrame | None = None, keys: Sequence[str] = KEYS,
    day: str = "date_parsed",
) -> None:
    """Merge ``batch`` into the history below ``path`` and rewrite the days it touches, and only those.

    ``day`` must be a part of the key, so that rows of a key lie in one day.
    ``removals`` has the keys of rows to delete; the folder of a
    day of which nothing is left goes.  The new content is written aside first, so the
    days are read before they are replaced, and a failure until then leaves
    the history as it was.
    """
    if day not in keys:
        raise ValueError(f"{day} must be a part of the key {tuple(keys)}")
    source = written(batch, "merge-batch")
    schema = source.schema
    days = touched_days(source, removals, day)
    # The semi-join prunes folders: days that are not touched are not opened.
    stored = read_history(spark, path, schema)
    existing = stored.join(F.broadcast(days), stored[day].eqNullSafe(days[day]), "left_semi")
    new = written(merged_rows(existing, source, removals, keys), "merged")
    emptied = days.join(new.select(day).distinct(), new[day].eqNullSafe(days[day]), "left_anti").select(day)
    _replace_days(new, emptied, path, day)


def _replace_days(new: DataFrame, emptied: DataFrame, path: str, day: str) -> None:
    spark = new.sparkSession
    spread = new.repartition(day, F.pmod(F.xxhash64(*new.columns), F.lit(16)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for row in emptied.toLocalIterator():  # days that removals have left without rows
        name = "__HIVE_DEFAULT_PARTITION__" if row[day] is None else str(row[day])
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day}={name}")
        place.getFileSystem(hadoop).delete(place, True)
