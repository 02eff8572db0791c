"""Quantile and distinct-count sketches per day, stored, and merged for any range of days.

A sketch has a bounded size whatever the number of rows, and sketches of parts merge into one of the whole.  So each day
is read once, when it is loaded; a range of days is answered from a few kilobytes a day and group, and adding a day reads
no earlier one.  Quantiles come with a bound on the error of their rank, counts with one on the relative error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a quantile sketch; a larger one is more exact.
SKETCH_SIZE = 1000
#: How far the rank of an estimate may lie from the wanted one, as a share of the rows (about eight deviations).
RANK_ERROR = 0.01
#: Binary logarithm of the registers of a distinct-count sketch, and its relative error (five deviations).
REGISTERS_LOG, COUNT_ERROR = 14, 0.04


def daily_sketches(
    df: DataFrame, day: str, value: str | None = None, distinct: str | None = None, by: Sequence[str] = (),
    size: int = SKETCH_SIZE, registers: int = REGISTERS_LOG,
) -> DataFrame:
    """One row per group and day: ``n`` values, the sketch of their ranks, and the sketch of distinct ones of a column.

    NULL and NaN values, and NULLs of the distinct column, are left out; rows
    without a day are one day of their own.  Sketches are built before the
    shuffle, so a day or group with a third of the rows is one small record
    per task.
    """
    figures: list[Column] = []
    if value:
        number = F.col(value).cast("double")
        known = F.when(~F.isnan(number), number)
        figures += [F.count(known).alias("n"), F.kll_sketch_agg_double(known, F.lit(size)).alias("ranks")]
    if distinct:
        figures.append(F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(registers)).alias("members"))
    if not figures:
        raise ValueError("neither a value nor a distinct column to sketch")
    return df.groupBy(*by, F.col(day).alias("day")).agg(*figures)


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Add days to a store, or replace them: only the folders of the days given are touched."""
    # A few rows a day: all of a day's groups go to one file.
    (
        sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(path)
    )


def stored_range(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last``; folders of other days are not opened."""
    stored = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    if first:
        stored = stored.where(F.col("day") >= F.lit(first).cast("date"))
    if last:
        stored = stored.where(F.col("day") <= F.lit(last).cast("date"))
    return stored


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of all given days as one per group, with the number of days."""
    figures = [F.count_distinct("day").alias("n_days")]
    if "ranks" in sketches.columns:
        figures += [F.sum("n").cast("long").alias("n"), F.kll_merge_agg_double("ranks").alias("ranks")]
    if "members" in sketches.columns:
        figures.append(F.hll_union_agg("members").alias("members"))
    return sketches.groupBy(*by).agg(*figures)


def estimated_quantiles(merged_sketches: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """The merged rows with one column per probability; NULL where a group has no value."""
    wanted = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(float(p)))).alias(name)
        for name, p in probabilities.items()
    ]
    return merged_sketches.select("*", *wanted)


def estimated_distinct(merged_sketches: DataFrame, name: str = "n_distinct") -> DataFrame:
    return merged_sketches.withColumn(name, F.hll_sketch_estimate("members"))


def rank_errors(df: DataFrame, value: str, estimates: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """How far each estimate's rank lies from the wanted one, measured on the rows themselves.

    One row per group and probability: ``rank_error`` is the distance between
    the probability and the stretch of ranks that the estimate takes.
    """
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col(name).alias("estimate")) for name, p in probabilities.items()])
    wanted = estimates.select(*by, F.inline(pairs))
    # Rows meet the estimates of their group only, which are as many as there are probabilities.
    held = wanted.groupBy(*by).agg(F.collect_list(F.struct("probability", "estimate")).alias("wanted"))
    number = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(number))
    if by:
        condition = [rows[c].eqNullSafe(held[c]) for c in by]
        met = rows.join(held, condition).select(*[rows[c] for c in by], number.alias("x"), "wanted")
    else:
        met = rows.select(number.alias("x")).withColumn("wanted", held.select("wanted").scalar())
    counted = met.select(*by, "x", F.explode("wanted").alias("w")).groupBy(*by, "w").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.col("w.estimate")).alias("below"),
        F.count_if(F.col("x") <= F.col("w.estimate")).alias("upto"),
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    wanted_rank = F.col("w.probability")
    return counted.select(
        *by, wanted_rank.alias("probability"), "n", F.col("w.estimate").alias("estimate"),
        F.greatest(low - wanted_rank, wanted_rank - high, F.lit(0.0)).alias("rank_error"),
    )
