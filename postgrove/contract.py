"""The data contract: persisted columns, missing-value sets and the helpers built on them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The persisted columns, in order.
CSV_FIELDS = [
    "job_id", "source", "title", "company", "city", "state", "country", "min_experience_years", "max_experience_years",
    "skills", "degree_required", "specialization_required", "collected_at", "link", "full_description",
]

NOT_SPECIFIED = "Not Specified"

#: The three missing-value sets (after trim and lower).  They differ on purpose.
QUALITY_MISSING = ["", "not specified", "not_specified", "n/a", "na", "none", "null", "-"]
ENRICH_MISSING = ["", "none", "null", "n/a", "na", "not specified", "not_specified", "not available", "not_available"]
PARSE_MISSING = ["", "not specified", "n/a", "none"]
#: Placeholders of the test tables.
DATA_MISSING = ["", "not specified", "not_specified", "not available", "n/a", "na", "none", "null", "-"]

_BLANKS = " \t\n\x0b\f\r\u00a0"


def trimmed(c: Column) -> Column:
    """Without outer blanks of any kind (space, tab, line ends, no-break space)."""
    return F.btrim(c, F.lit(_BLANKS))


def missing(c: Column, members: list[str] = DATA_MISSING) -> Column:
    """True for null, blank, or a placeholder in any case; never null."""
    return c.isNull() | F.lower(trimmed(F.coalesce(c, F.lit("")))).isin(members)


def known(c: Column, members: list[str] = DATA_MISSING) -> Column:
    """The value, or null where it is missing."""
    return F.when(~missing(c, members), c)


def ns(c: Column) -> Column:
    """Blank or null becomes the literal placeholder."""
    v = trimmed(c.cast("string"))
    return F.when(F.length(v) > 0, v).otherwise(F.lit(NOT_SPECIFIED))
