"""Words, lines and hashes as column expressions, and the same words in Python for tests of single texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that ends a word, and the letters that are lower-cased.
SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text; none for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def lower_ascii(text: Column) -> Column:
    """A-Z in small letters and nothing else; the built-in is faster and the same where all is ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lower_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))
