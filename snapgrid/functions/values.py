"""Number, flag and name expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: what counts as a number in text.
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"


def number(value: Column, kind: str = "double", text: bool = False) -> Column:
    """Numeric coercion: what is no number becomes null, NaN too.

    ``text`` checks the shape before the cast, which is far cheaper than a failing cast per row.
    """
    parsed = value.try_cast(kind)
    if text:
        parsed = F.when(value.rlike(NUMBER_TEXT), parsed)
    return F.when(~F.isnan(parsed), parsed) if kind in ("double", "float") else parsed


def truth_flag(value: Column) -> Column:
    """``true`` in any case and padding is 1; everything else, null included, is 0."""
    text = F.lower(F.trim(value.cast("string")))
    return F.coalesce((text == "true").cast("int"), F.lit(0))


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the scaled binary double half to even, as float libraries do."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def safe_rate(part: Column, whole: Column, digits: int = 2) -> Column:
    ratio = F.when(whole > 0, part / whole.cast("double")).otherwise(F.lit(0.0))
    return round_half_even(ratio, digits)


def safe_name(name: str) -> str:
    """Letters, digits, ``-`` and ``_`` stay; every other character becomes ``_``."""
    return re.sub(r"[^\w-]", "_", name)


def file_tag(file_name: Column, parts: int = 2) -> Column:
    """The first ``_`` separated parts of a file stem."""
    return F.substring_index(F.regexp_replace(file_name, r"\.[^.]*$", ""), "_", parts)


def differs(value: Column, other) -> Column:
    """Inequality that keeps nulls."""
    return ~value.eqNullSafe(F.lit(other))
