"""Ways of putting frames together, and of dealing their rows to tasks, that several operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task gets where rows are dealt by their number.
ROWS_OF_A_TASK = 250_000


def null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns both sides name alike; NULL keys meet NULL keys."""
    renamed = {c: f"__right_{c}" for c in columns}
    other = right.withColumnsRenamed(renamed)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(r)) for c, r in renamed.items()])
    return left.join(other, same, how).drop(*renamed.values())


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames side by side through scalar subqueries."""
    result = frames[0]
    for i, frame in enumerate(frames[1:]):
        packed = frame.select(F.struct(*frame.columns).alias("packed")).scalar()
        name = f"__side{i}"
        result = result.withColumn(name, packed).select(
            *[F.col(c) for c in result.columns], *[F.col(f"{name}.{c}").alias(c) for c in frame.columns]
        )
    return result


def dealt(df: DataFrame, columns: Sequence[str], rows: int = ROWS_OF_A_TASK) -> DataFrame:
    """``df`` dealt by the columns to as many tasks as its rows need, so that one task's share does not grow with them.

    Counts the rows at once, which for a table of files reads no column.  Aggregations by these columns that follow
    need no shuffle of their own, and build no tables of keys while the input is read.
    """
    return df.repartition(max(1, -(-df.count() // rows)), *columns)
