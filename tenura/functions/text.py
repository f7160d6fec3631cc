"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s plus the separators and no-break spaces that Python's str.strip also removes.
_EDGE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(value: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(value, f"^{_EDGE}|{_EDGE}$", "")


def tokens(value: Column, sep: str = ",") -> Column:
    """Split at a literal separator, trim each part and leave out empty parts."""
    literal = "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)
    parts = F.split(value, literal)
    return F.filter(F.transform(parts, strip), lambda part: part != "")


def digits_key(value: Column, strict: bool = True) -> Column:
    """First run of digits as a number; text without digits raises, or gives null if lenient."""
    run = F.regexp_extract(value, r"(\d+)", 1)
    return run.cast("long") if strict else run.try_cast("long")


def standard_name(name: str) -> str:
    """Column name without outer spaces, in lower case, inner spaces as underscores."""
    return name.strip().lower().replace(" ", "_")
