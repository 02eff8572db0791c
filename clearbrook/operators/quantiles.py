"""Exact interpolated quantiles without gathering the values of a group.

Values are counted in a distributed way and the wanted ranks located by prefixes of the values, as in a histogram of
three levels.  A prefix is computed from the value alone and never decreases as the value grows:

1. equal values collapse into one counted row (partial aggregation, so a value or a group holding a third of the rows
   costs no more than any other);
2. counts per logarithmic bucket, cumulated per group, name the bucket that holds each wanted rank.  Buckets follow the
   magnitude of a double, so their number per group is bounded whatever the number of rows;
3. every bucket has the same number of slices of equal width, from the bucket's own bounds and not from the data's;
   those of the chosen buckets are cumulated and the slices of the wanted ranks named;
4. only the values inside these slices, at most ``2 ** 24`` different doubles each, are ranked.

Every level reads the counted values once, and cumulates with one window: three of each, whatever the number of
probabilities.  With groups the named cells reach the values by joins, which adaptive execution broadcasts when they are
small; without groups they are a few numbers in a scalar subquery and there is no join at all.

It is one lazy plan at every size; nothing is counted or collected while it is built.  ``method="gathered"`` takes the
built-in aggregate instead, which holds every distinct value of a group in one task: for groups that the caller knows
to be small.  Both interpolate alike, to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.operators.joins import null_safe_join

BUCKETS_PER_OCTAVE = 256
SLICES = 1 << 20
_OCTAVE_SHIFT = 1080  # log2 of the smallest double is -1074
_TOP_BUCKET = (_OCTAVE_SHIFT + 1100) * BUCKETS_PER_OCTAVE


def _magnitude_bucket(x: Column) -> Column:
    """A bucket number that never decreases as ``x`` grows; NaN sorts last."""
    size = F.floor(F.log2(F.abs(x)) * BUCKETS_PER_OCTAVE) + _OCTAVE_SHIFT * BUCKETS_PER_OCTAVE
    return (
        F.when(F.isnan(x), F.lit(_TOP_BUCKET + 1))
        .when(F.abs(x) == float("inf"), F.signum(x).cast("long") * _TOP_BUCKET)
        .when(x == 0, F.lit(0))
        .otherwise(F.signum(x).cast("long") * size)
        .cast("long")
    )


def _slice(x: Column, bucket: Column) -> Column:
    """The slice of ``x`` inside its bucket, from the bucket's analytic bounds; never decreases as ``x`` grows."""
    size = F.abs(bucket) - F.lit(_OCTAVE_SHIFT * BUCKETS_PER_OCTAVE)
    low = F.pow(F.lit(2.0), size / BUCKETS_PER_OCTAVE)
    width = F.pow(F.lit(2.0), (size + 1) / BUCKETS_PER_OCTAVE) - low
    share = F.greatest(F.least((F.abs(x) - low) / width, F.lit(1.0)), F.lit(0.0))
    # Zero, the odd values, and buckets among the smallest doubles whose bounds fall together have one slice.
    plain = (bucket != 0) & (F.abs(bucket) < _TOP_BUCKET) & (width > 0)
    return F.when(plain, F.signum(x).cast("long") * F.floor(share * SLICES)).otherwise(F.lit(0)).cast("long")


def _window(columns: Sequence[str]):
    # With no group the histogram is one bounded list of buckets.
    return Window.partitionBy(*(columns or [F.lit(0)]))


def _wanted_inside(ranks: Column, before: Column, count: Column) -> Column:
    """Ranks that fall into ``count`` rows preceded by ``before``, made relative."""
    inside = F.filter(ranks, lambda r: (r["k"] >= before) & (r["k"] < before + count))
    return F.transform(
        inside,
        lambda r: F.struct(r["q"].alias("q"), r["frac"].alias("frac"), (r["k"] - before).alias("k"), r["upper"].alias("upper")),
    )


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Non-NULL values of ``column`` per group with their number of rows."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c"))
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    count_as: str | None = None,
    method: str = "distributed",
) -> DataFrame:
    """Linear-interpolated quantiles, one output column per probability.

    One row per group with a value (one row in all without ``by``, NULLs when
    there is none).  ``count_as`` names a further column with the number of
    values.  ``method`` is ``distributed`` or ``gathered``; both return the
    same quantiles.
    """
    if method == "gathered":
        return _gathered(df, column, probabilities, by, count_as)
    if method == "distributed":
        return _distributed(df, column, probabilities, by, count_as)
    raise ValueError(f"unknown method: {method}")


def _gathered(df, column, probabilities, by, count_as) -> DataFrame:
    # NULLs are skipped by the aggregate; a filter would compute the value twice.
    value = F.col(column).cast("double")
    found = df.groupBy(*by).agg(
        F.percentile(value, list(probabilities.values())).alias("q"), F.count(value).alias("n")
    )
    if by:
        found = found.where("n > 0")
    outputs = [F.get("q", F.lit(i)).alias(alias) for i, alias in enumerate(probabilities)]
    if count_as:
        outputs.append(F.col("n").alias(count_as))
    return found.select(*by, *outputs)


def _inside(rows: DataFrame, chosen: DataFrame, by: Sequence[str], place: Sequence[str]) -> DataFrame:
    """Rows of the chosen cells, with the cell's ``n`` and ``ranks``."""
    if by:
        return null_safe_join(rows, chosen, [*by, *place])
    # At most two cells per probability; as a scalar they reach the rows without a join.
    cells = chosen.agg(F.collect_list(F.struct(*place, "n", "ranks"))).scalar()
    same = lambda c: reduce(lambda a, b: a & b, [c[p] == F.col(p) for p in place])
    # Exploded rather than looked up, as a column used twice would repeat the subquery in the plan.
    found = rows.withColumn("__cells", cells).select("*", F.explode(F.filter("__cells", same)).alias("__cell"))
    return found.select(*rows.columns, F.col("__cell.n").alias("n"), F.col("__cell.ranks").alias("ranks"))


def _located(cells: DataFrame, by: Sequence[str], place: Sequence[str], within: Sequence[str]) -> DataFrame:
    """The cells that hold a wanted rank, with the ranks made relative to the cell."""
    upto = _window([*by, *within]).orderBy(place[-1]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cells.withColumn("before", F.sum("cell").over(upto) - F.col("cell"))
    wanted = _wanted_inside(F.col("ranks"), F.col("before"), F.col("cell"))
    return counted.select(*by, *place, "n", wanted.alias("ranks")).where(F.size("ranks") > 0)


def _ranks(probabilities: Mapping[str, float]) -> Column:
    """The two ranks around each quantile's position among ``n`` values."""
    ranks = []
    for i, probability in enumerate(probabilities.values()):
        position = F.lit(float(probability)) * (F.col("n") - 1)
        below = F.floor(position)
        for upper, k in ((False, below), (True, F.ceil(position))):
            ranks.append(
                F.struct(
                    F.lit(i).alias("q"), (position - below).alias("frac"),
                    k.cast("long").alias("k"), F.lit(upper).alias("upper"),
                )
            )
    return F.array(*ranks)


def _distributed(df, column, probabilities, by, count_as) -> DataFrame:
    by = list(by)
    counts = value_counts(df, column, by).withColumn("b", _magnitude_bucket(F.col("x")))

    # Step 2: which bucket holds each rank.
    buckets = counts.groupBy(*by, "b").agg(F.sum("c").alias("cell"))
    whole = _window(by).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # ordered as in _located
    buckets = buckets.withColumn("n", F.sum("cell").over(whole)).withColumn("ranks", _ranks(probabilities))
    chosen = _located(buckets, by, ["b"], [])

    # Step 3: which of the bucket's slices.
    sliced = counts.withColumn("s", _slice(F.col("x"), F.col("b")))
    slices = _inside(sliced, chosen, by, ["b"]).groupBy(*by, "b", "s").agg(
        F.sum("c").alias("cell"), F.first("n").alias("n"), F.first("ranks").alias("ranks")
    )
    chosen = _located(slices, by, ["b", "s"], ["b"])

    # Step 4: rank the few values left.
    values = _inside(sliced, chosen, by, ["b", "s"]).withColumnRenamed("c", "cell")
    found = _located(values, by, ["b", "s", "x"], ["b", "s"]).select(*by, "x", "n", F.explode("ranks").alias("r"))

    outputs = []
    for i, alias in enumerate(probabilities):
        here = F.col("r.q") == i
        low = F.max(F.when(here & ~F.col("r.upper"), F.col("x")))
        high = F.max(F.when(here & F.col("r.upper"), F.col("x")))
        frac = F.max(F.when(here, F.col("r.frac")))
        # Equal neighbours are returned as they are, so infinities survive too.
        outputs.append(F.when(low == high, low).otherwise((1 - frac) * low + frac * high).alias(alias))
    if count_as:
        outputs.append(F.coalesce(F.max("n"), F.lit(0)).cast("long").alias(count_as))
    return found.groupBy(*by).agg(*outputs) if by else found.agg(*outputs)
