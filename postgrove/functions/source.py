"""The site a record came from, out of its many spellings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The three sites.
SITES = ["linkedin", "naukri", "indeed"]


def site(c: Column) -> Column:
    """``' Linked In'``, ``linkedin.com``, ``LINKEDIN`` -> ``linkedin``; anything unknown -> null."""
    bare = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z]", "")
    out = F.lit(None).cast("string")
    for name in reversed(SITES):
        out = F.when(bare.startswith(name), name).otherwise(out)
    return out
