"""What a patch does to rows: multiset difference of two tables, paired by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.fixed_values import KEYS


def surplus_rows(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Different rows that are not as often on both sides, with ``delta``: copies after less copies before.

    NULLs are equal to each other.  One shuffle of both sides, with equal rows
    counted before it, so a row that is there very often is one partial count
    per task.
    """
    tagged = before.select(*columns, F.lit(-1).alias("side")).unionByName(after.select(*columns, F.lit(1).alias("side")))
    return tagged.groupBy(*columns).agg(F.sum("side").alias("delta")).where("delta <> 0")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def row_diff(before: DataFrame, after: DataFrame, keys: Sequence[str] = KEYS, columns: Sequence[str] | None = None) -> DataFrame:
    """Added, removed and changed rows: the key, ``kind``, ``changed_columns``, copies ``n``, and both rows.

    Removed and added rows of one complete key are paired in the order of
    their content: a pair is a changed row.  What one side has more of is added
    or removed.  Rows with an incomplete key have no partner.  ``columns`` are
    those compared, all that both sides have by default; the keys are always
    among them.

    Pairs are not made by joining the sides of a key.  Copies of a side are
    laid end to end and both sides cut where either begins a new row, so the
    work grows with the number of different rows and not with pairs of them,
    or with copies.
    """
    if columns is None:
        columns = [c for c in before.columns if c in after.columns]
    columns = [*keys, *[c for c in columns if c not in keys]]
    content = [c for c in columns if c not in keys]
    surplus = surplus_rows(before, after, columns)
    row = F.struct(*columns)
    complete = _all([F.col(k).isNotNull() for k in keys])

    sided = surplus.where(complete).withColumns({"added": F.col("delta") > 0, "copies": F.abs("delta"), "row": row})
    laid = Window.partitionBy(*keys, "added").orderBy(*content).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sided = sided.withColumn("stop", F.sum("copies").over(laid)).withColumn("start", F.col("stop") - F.col("copies"))
    end = F.struct(F.col("stop").alias("at"), F.lit(None).cast(surplus.select(row.alias("r")).schema["r"].dataType).alias("row"), F.col("stop").alias("stop"))
    begin = F.struct(F.col("start").alias("at"), F.col("row"), F.col("stop"))
    marks = sided.select(*keys, "added", F.inline(F.array(begin, end))).groupBy(*keys, "at").agg(
        F.max(F.when(~F.col("added") & F.col("row").isNotNull(), F.struct("stop", "row"))).alias("old"),
        F.max(F.when(F.col("added") & F.col("row").isNotNull(), F.struct("stop", "row"))).alias("new"),
    )
    along = Window.partitionBy(*keys).orderBy("at")
    segments = marks.select(
        *keys, "at", F.lead("at").over(along).alias("until"),
        F.last("old", ignorenulls=True).over(along).alias("old"), F.last("new", ignorenulls=True).over(along).alias("new"),
    ).where("until IS NOT NULL")
    alive = lambda side: F.when(F.col(f"{side}.stop") > F.col("at"), F.col(f"{side}.row"))
    paired = segments.select((F.col("until") - F.col("at")).alias("n"), alive("old").alias("before"), alive("new").alias("after"))
    alone = surplus.where(~complete).select(
        F.abs("delta").alias("n"), F.when(F.col("delta") < 0, row).alias("before"), F.when(F.col("delta") > 0, row).alias("after")
    )
    both = paired.where("before IS NOT NULL OR after IS NOT NULL").unionByName(alone)
    changed = F.array_compact(F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in content]).cast("array<string>"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return both.select(
        *[F.coalesce(F.col(f"before.{k}"), F.col(f"after.{k}")).alias(k) for k in keys], kind.alias("kind"),
        F.when(kind == "changed", changed).otherwise(F.array().cast("array<string>")).alias("changed_columns"), "n", "before", "after",
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    """Rows by kind, and for changed rows by the columns that changed."""
    return diff.groupBy("kind", F.array_join("changed_columns", ",").alias("changed")).agg(F.sum("n").alias("n"))
