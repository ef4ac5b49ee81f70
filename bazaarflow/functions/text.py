"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import col

# Romanised words whose presence marks a review as mixed-language.
HINGLISH_WORDS = ("bahut", "accha", "mila", "bilkul", "deta", "hoon")


def language_hint(text: str | Column) -> Column:
    """'hinglish' when any marker word occurs as a substring, else 'english'."""
    marked = F.lower(col(text)).rlike("|".join(HINGLISH_WORDS))
    return F.when(marked, F.lit("hinglish")).otherwise(F.lit("english"))


def strip_fence(raw: str | Column) -> Column:
    """Model text without its surrounding code fence and json tag."""
    trimmed = F.regexp_replace(col(raw), r"^\s+|\s+$", "")
    inner = F.split_part(trimmed, F.lit("```"), F.lit(2))
    untagged = F.when(F.startswith(inner, F.lit("json")), F.substr(inner, F.lit(5))).otherwise(inner)
    return F.when(F.startswith(trimmed, F.lit("```")), untagged).otherwise(trimmed)


def clean_name(name: str) -> str:
    """Warehouse-safe column name."""
    return name.lower().translate(str.maketrans({" ": "_", "-": "_", ".": "_"}))


def stable_bucket(key: str | Column, buckets: int) -> Column:
    """Deterministic bucket of a key in [0, buckets), the same in any engine with md5."""
    head = F.conv(F.substring(F.md5(col(key).cast("string").cast("binary")), 1, 8), 16, 10)
    return head.cast("bigint") % F.lit(buckets)
