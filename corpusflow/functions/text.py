"""Cleaning of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware stripping removes.
STRIP_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000,
]
STRIP_CHARACTERS = "".join(map(chr, STRIP_CODES))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(STRIP_CHARACTERS))


def clean_text(text: Column) -> Column:
    """Strip every line, join the non-empty ones by a space, halve double spaces once."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")
    return F.replace(F.array_join(lines, " "), F.lit("  "), F.lit(" "))


def length_between(text: Column, shortest: int, longest: int) -> Column:
    return F.length(text).between(shortest, longest)


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""
