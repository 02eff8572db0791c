"""Static guardrails over a column of SQL texts.  Nothing is executed."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clearbrook.fixed_values import (
    BARE_CHANNEL_MESSAGE,
    BARE_CHANNEL_SQL,
    BLOCKED_SQL,
    CHANNEL_ALIAS_SQL,
    EXTRA_BLOCKED_SQL,
    GOLD_TABLE,
    REQUIRED_SQL,
    SQL_HINTS,
    UNKNOWN_SQL_COLUMNS,
)
from clearbrook.functions.scalars import as_column

# Any case, lines end at \n only, letters and digits of every language are words.
FLAGS = "(?iumdU)"


def _messages(pairs: list[tuple[Column, str]]) -> Column:
    # array_except drops the NULLs of rules that did not fire; it has no lambda,
    # so equal lists are recognised as such and computed once.
    fired = F.array(*[F.when(found, F.lit(message)) for found, message in pairs])
    return F.array_except(fired, F.array(F.lit(None).cast("string")))


def _matches(text: Column, pattern: str, hints: tuple[str, ...] = ()) -> Column:
    """Whether a pattern occurs; long texts without a hint skip the pattern."""
    found = text.rlike(FLAGS + pattern)
    if not hints:
        return found
    folded = F.lower(text)
    worth_trying = reduce(lambda a, b: a | b, [folded.contains(h) for h in hints])
    return F.when(worth_trying, found).otherwise(F.lit(False))


def audit_sql(text: Column | str, strict: bool = False, target: str = GOLD_TABLE) -> Column:
    """Struct of three message lists and ``safe``.

    ``safe`` ignores missing requirements.  ``strict`` adds rules for
    statements the usual ones let through.
    """
    text = F.coalesce(as_column(text), F.lit(""))
    blocked_rules = BLOCKED_SQL + (EXTRA_BLOCKED_SQL if strict else ())
    blocked = _messages([(_matches(text, p, SQL_HINTS[m]), m) for p, m in blocked_rules])
    required = [
        (p.replace(re.escape(GOLD_TABLE), re.escape(target)), m.replace(GOLD_TABLE, target)) for p, m in REQUIRED_SQL
    ]
    missing = _messages([(~_matches(text, p, ("create", "row_number")), m) for p, m in required])
    without_alias = F.regexp_replace(text, FLAGS + CHANNEL_ALIAS_SQL, "")
    bare_channel = F.when(F.lower(text).contains("channel"), without_alias.rlike(FLAGS + BARE_CHANNEL_SQL))
    unknown = _messages(
        [(_matches(text, rf"\b{c}\b", ("ted_at",)), c) for c in UNKNOWN_SQL_COLUMNS]
        + [(bare_channel, BARE_CHANNEL_MESSAGE)]
    )
    return F.struct(
        blocked.alias("blocked_commands"),
        missing.alias("missing_requirements"),
        unknown.alias("unknown_columns"),
        ((F.size(blocked) == 0) & (F.size(unknown) == 0)).alias("safe"),
    )


def audit_one(spark: SparkSession, sql: str, strict: bool = False, target: str = GOLD_TABLE) -> dict:
    """The same audit for a single text held by the driver."""
    return spark.range(1).select(audit_sql(F.lit(sql), strict, target).alias("a")).first()["a"].asDict()
