"""Money and integer cleaning for report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outpulse.functions.numeric import col


def parse_money(text, scale: int = 2) -> Column:
    """'$1,234.50' -> 1234.50, '(5.00)' -> -5.00, 'N/A', '' and NULL -> 0."""
    raw = F.trim(F.coalesce(col(text).cast("string"), F.lit("")))
    negative = raw.rlike(r"^\(.*\)$")
    digits = F.regexp_replace(raw, r"[^0-9.\-]", "")
    value = digits.try_cast(f"decimal(18,{scale})")
    return F.coalesce(F.when(negative, -value).otherwise(value), F.lit(0).cast(f"decimal(18,{scale})"))


def parse_count(text) -> Column:
    """Integer text with separators; anything unreadable is 0."""
    digits = F.regexp_replace(F.coalesce(col(text).cast("string"), F.lit("")), r"[,\s]", "")
    return F.coalesce(F.round(digits.try_cast("double")).cast("long"), F.lit(0).cast("long"))
