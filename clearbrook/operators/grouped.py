"""A user's own function per group, also where one group is too large for a task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.operators.joins import null_safe_join

#: Rows of a group that one task takes at once.
MOST_ROWS = 1_000_000
#: Stretches of a group at most; beyond that they grow with the group.
STRETCHES = 1000

#: Rows of results that are handed back together.
_BATCH = 10_000
#: Kinds without a null of their own, and what pandas takes for a column of them that has one.
_PLAIN = {"tinyint": "float64", "smallint": "float64", "int": "float64", "bigint": "float64", "boolean": "object"}

Frame = Callable[[pd.DataFrame], pd.DataFrame]


def _position(df: DataFrame, order: str) -> Column:
    """The order column as a number."""
    kind = dict(df.dtypes)[order]
    return F.unix_micros(F.col(order).cast("timestamp")).cast("double") if kind in ("date", "timestamp") else F.col(order).cast("double")


def split_groups(df: DataFrame, by: Sequence[str], order: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """``df`` with ``part``: the number of the row's stretch of ``order`` within its group, from 0.

    Groups of up to ``most_rows`` rows have one stretch.  Larger ones are cut at
    approximate quantiles of ``order``, into as many stretches as they need, so
    that stretches follow each other and equal values stay together (a value
    that alone has more rows than that is one stretch).  Rows without a value
    are in stretch 0.
    """
    position = _position(df, order)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most_rows)
    hot = null_safe_join(df.select(*by, position.alias("position")), sizes, list(by))
    # Sketches are built before the shuffle and merge, so a hot group's bounds cost no more than another's.
    sketched = hot.groupBy(*by).agg(F.kll_sketch_agg_double("position", F.lit(4000)).alias("ranks"), F.first("rows").alias("rows"))
    grid = F.array(*[F.lit(k / STRETCHES) for k in range(1, STRETCHES)])
    pieces = F.least(F.lit(STRETCHES), F.ceil(F.col("rows") / most_rows).cast("int"))
    steps = sketched.select(*by, pieces.alias("pieces"), F.kll_sketch_get_quantile_double("ranks", grid).alias("steps"))
    chosen = F.transform(F.sequence(F.lit(1), F.col("pieces") - 1), lambda k: F.get("steps", F.floor(k * STRETCHES / F.col("pieces")).cast("int") - 1))
    bounds = steps.select(*by, F.array_distinct(chosen).alias("bounds"))
    cut = null_safe_join(df.withColumn("__position", position), bounds, list(by), "left")
    part = F.size(F.filter("bounds", lambda b: b < F.col("__position")))
    whole = F.col("bounds").isNull() | F.col("__position").isNull()
    return cut.withColumn("part", F.when(whole, 0).otherwise(part)).drop("__position", "bounds")


def _runs(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows between one ``__place`` of 1 and the next, each run as one frame without that column."""
    pieces: list[pd.DataFrame] = []
    for frame in frames:
        starts = np.flatnonzero(frame["__place"].to_numpy() == 1).tolist()
        rows = frame.drop(columns="__place")
        edges = [0, *starts, len(rows)]
        for at, (low, high) in enumerate(zip(edges, edges[1:])):
            if at and pieces:
                yield pieces[0] if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)
                pieces = []
            if high > low:
                pieces.append(rows.iloc[low:high].reset_index(drop=True))
    if pieces:
        yield pieces[0] if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)


def _each_group(df: DataFrame, columns: Sequence[str], order: str, function: Frame, schema: str) -> DataFrame:
    """``function`` over the rows of each group, sorted by ``order`` with missing values last.

    Groups follow each other within a task, so that small ones share their batches and results.  Tasks are as many as
    the session's shuffle partitions: results are few bytes, and would otherwise be joined into one task that calls the
    function for all groups.
    """
    place = F.row_number().over(Window.partitionBy(*columns).orderBy(F.col(order).asc_nulls_last()))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(tasks, *columns).withColumn("__place", place).sortWithinPartitions(*columns, "__place")
    # A batch with a null has a column of floats or objects, also for groups without one: nulls travel in columns of their own.
    plain = {c: _PLAIN[t] for c, t in df.dtypes if t in _PLAIN}
    marks = {f"__null_{c}": F.col(c).isNull() for c in plain}
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in plain}
    placed = placed.withColumns(marks).withColumns(zeros)

    def restored(rows: pd.DataFrame) -> pd.DataFrame:
        missing = {c: rows[f"__null_{c}"].to_numpy() for c in plain}
        rows = rows.drop(columns=[f"__null_{c}" for c in plain])
        for c, mask in missing.items():
            if mask.any():
                values = rows[c].to_numpy().astype(plain[c])
                values[mask] = None
                rows[c] = values
        return rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        results: list[pd.DataFrame] = []
        size = 0
        for rows in _runs(frames):
            found = function(restored(rows))
            if results and (size > _BATCH or not found.dtypes.equals(results[0].dtypes)):
                yield pd.concat(results, ignore_index=True)
                results, size = [], 0
            results.append(found)
            size += len(found)
        if results:
            yield pd.concat(results, ignore_index=True)

    return placed.mapInPandas(run, schema)


def apply_by_group(
    df: DataFrame, by: Sequence[str], order: str, function: Frame, schema: str, merge: Frame | None = None,
    merged_schema: str | None = None, most_rows: int = MOST_ROWS,
) -> DataFrame:
    """``function`` over the rows of each group in the order of a column; then, with ``merge``, over its results.

    Both take and return pandas frames, in Arrow batches.  ``function`` gets a
    group's rows sorted by ``order``; its result has the group's columns and
    whatever ``schema`` says.  Without ``merge`` a group goes to one task as a
    whole: give none only where groups are known to fit.

    With it, groups of more than ``most_rows`` rows are cut into stretches of
    ``order``; ``function`` sees one at a time, and ``merge`` gets the results
    of a group, sorted by ``part``, the number of the stretch.  A function that
    is wrong on a stretch gives a wrong result; that it may be cut is the
    caller's promise.
    """
    columns = list(by)
    if merge is None:
        return _each_group(df, columns, order, function, schema)
    split = split_groups(df, columns, order, most_rows)

    def stretch(rows: pd.DataFrame) -> pd.DataFrame:
        part = rows["part"].iloc[0]
        return function(rows.drop(columns="part")).assign(part=part)

    partial = _each_group(split, [*columns, "part"], order, stretch, f"{schema}, part int")
    return _each_group(partial, columns, "part", merge, merged_schema or schema)
