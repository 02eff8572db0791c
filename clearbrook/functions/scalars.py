"""Column expressions for staging dirty text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbrook.fixed_values import DATE_FORMATS


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


_DATE_PIECES = {"yyyy": r"(\d{4})", "MM": r"(\d{2})", "M": r"(\d{1,2})", "dd": r"(\d{2})", "d": r"(\d{1,2})"}


def _numeric_date(text: Column, fmt: str) -> Column | None:
    """Parse an all-numeric format by rearranging it to year-month-day.

    Formatters signal a mismatch by an exception for every row, which is slow
    in a column of mixed formats; a pattern and a safe cast are not.
    """
    pieces = re.findall(r"y+|M+|d+|[^yMd]+", fmt)
    letters = [p for p in pieces if p in _DATE_PIECES]
    if sorted(p[0] for p in letters) != ["M", "d", "y"] or any(p not in letters and p.isalnum() for p in pieces):
        return None
    shape = "^" + "".join(_DATE_PIECES.get(p) or re.escape(p) for p in pieces) + "$"
    place = {p[0]: i + 1 for i, p in enumerate(letters)}
    if list(place) == ["y", "M", "d"] and all(len(p) == 1 for p in pieces if p not in letters):
        iso = F.translate(text, "".join(p for p in pieces if p not in letters), "--")
    else:
        iso = F.regexp_replace(text, shape, f"${place['y']}-${place['M']}-${place['d']}")
    return F.when(text.rlike(shape), iso.try_cast("date"))


def parse_date(value: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, as DATE; NULL when none does."""
    text = F.trim(as_column(value))
    parsed = []
    for fmt in formats:
        quick = _numeric_date(text, fmt)
        parsed.append(F.try_to_date(text, fmt) if quick is None else quick)
    return F.coalesce(*parsed)


def safe_double(value: Column | str) -> Column:
    """Text to DOUBLE, NULL when it is not a number.

    The JVM also reads Java literals such as ``1.5d`` or ``0x1p3``; those are
    not numbers in a data file.
    """
    text = F.trim(as_column(value))
    java_literal = text.rlike(r"[0-9.][dDfF]$|^[+-]?0[xX]")
    return F.when(~java_literal, text.try_cast("double"))


def safe_int(value: Column | str) -> Column:
    """Text to INT: fractions round half away from zero, exponents are read."""
    return F.round(safe_double(value)).try_cast("int")


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def normalize_label(value: Column | str) -> Column:
    return F.lower(F.translate(as_column(value), "- ", "__"))


def composite_key(*parts: Column | str) -> Column:
    """``a|b|...``; NULL as soon as one part is NULL (unlike ``concat_ws``)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)


def relative_deviation(value: Column | str, base: Column | str) -> Column:
    """``(value - base) / base``; NULL when the base is NULL or zero."""
    base = as_column(base)
    return (as_column(value) - base) / F.nullif(base.cast("double"), F.lit(0.0))


def not_positive(value: Column | str) -> Column:
    """True for NULL, zero and negative; never NULL."""
    value = as_column(value)
    return F.coalesce(value <= 0, F.lit(True))


def off_domain(value: Column | str, domain: Sequence[str]) -> Column:
    """True for labels outside the domain, NULL included; never NULL."""
    return F.coalesce(~as_column(value).isin(*domain), F.lit(True))


def missing_safe_text(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(""))


def missing_safe_number(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(0))
