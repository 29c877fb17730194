"""Rule compilers: ordered (label, pattern) lists become Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Rules = list[tuple[str, str]]


def first_match(c: Column, rules: Rules, otherwise: str | None = None) -> Column:
    """The label of the first rule whose pattern is found."""
    out = F.lit(otherwise).cast("string")
    for label, pattern in reversed(rules):
        out = F.when(c.rlike(pattern), label).otherwise(out)
    return out


def all_matches(c: Column, rules: Rules) -> Column:
    """The labels of all rules found, in order."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), label) for label, p in rules]))


def count_contained(c: Column, words: list[str]) -> Column:
    """How many of the words are contained; they may overlap."""
    total = F.lit(0)
    for w in words:
        total = total + c.contains(w).cast("int")
    return total


def word(text: str) -> str:
    """A pattern for the word or phrase between word ends, ASCII rules."""
    import re

    return rf"(?<![A-Za-z0-9_]){re.escape(text)}(?![A-Za-z0-9_])"
