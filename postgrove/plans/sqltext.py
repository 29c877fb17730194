"""Pieces of SQL shared by the oracle queries."""

BLANKS = r"'^[\s\x{00A0}]+|[\s\x{00A0}]+$'"


def trim(c: str) -> str:
    return f"regexp_replace({c}, {BLANKS}, '', 'g')"


MISSING = "('', 'not specified', 'not_specified', 'not available', 'n/a', 'na', 'none', 'null', '-')"
QUALITY = "('', 'not specified', 'not_specified', 'n/a', 'na', 'none', 'null', '-')"


def known(c: str) -> str:
    return f"({c} IS NOT NULL AND lower({trim(c)}) NOT IN {MISSING})"


def lost(c: str) -> str:
    return f"({c} IS NULL OR lower({trim(c)}) IN {QUALITY})"


def specified(c: str) -> str:
    return f"({c} IS NOT NULL AND {trim(c)} <> '' AND lower({trim(c)}) <> 'not specified')"


SITE = "nullif(regexp_extract(regexp_replace(lower(coalesce(source, '')), '[^a-z]', '', 'g'), '^(linkedin|naukri|indeed)', 1), '')"
NUMBER = r"""CASE WHEN {c} IS NULL OR lower(regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')) IN ('', 'not specified', 'n/a', 'none') THEN NULL
  WHEN TRY_CAST(regexp_extract(trim({c}), '^[-+]?\d*\.?\d+') AS DOUBLE) > 35 AND regexp_matches(trim({c}), '^[1-9]\S{{1,2}}$') THEN CAST(substr(trim({c}), 1, 1) AS DOUBLE)
  WHEN regexp_extract(trim({c}), '^[-+]?\d*\.?\d+') <> '' THEN TRY_CAST(regexp_extract(trim({c}), '^[-+]?\d*\.?\d+') AS DOUBLE)
  ELSE TRY_CAST(nullif(regexp_extract(trim({c}), '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) END"""
INSTANT = r"""CASE WHEN regexp_full_match({c}, '\d{{9,11}}') THEN to_timestamp(CAST({c} AS BIGINT)) AT TIME ZONE 'UTC' WHEN regexp_full_match({c}, '\d{{2}}-\d.*') THEN try_strptime({c}, '%d-%m-%Y %H:%M')
  WHEN contains({c}, '/') THEN try_strptime({c}, '%Y/%m/%d %H:%M') WHEN contains({c}, ',') THEN try_strptime({c}, '%d %b %Y, %H:%M') ELSE TRY_CAST({c} AS TIMESTAMP) END"""


def number(c: str) -> str:
    return NUMBER.format(c=c)


def instant(c: str) -> str:
    return INSTANT.format(c=c)


def cleaned(c: str) -> str:
    return trim(f"regexp_replace({c}, '[\\s\\x{{00A0}}]+', ' ', 'g')")


def found(c: str, pattern: str) -> str:
    """The cleaned text is known and holds the pattern; never null."""
    return f"(NOT {lost(cleaned(c))} AND regexp_matches({cleaned(c)}, '{pattern}'))"


#: What the quality rules of the places and the degree look for, as one pattern each.
GARBAGE_PLACE = (
    r"(?i)\b\d+\s+(minute|minutes|hour|hours|day|days|week|weeks|month|months)\s+ago\b|\b\d+\s+applicants?\b|\bbe\s+among\s+the\s+first\b|\bpromoted\b|\beasy\s+apply\b|\bactively\s+recruiting\b"
    r"|\bpeople\s+clicked\s+apply\b|(telangana|karnataka|tamil\s*nadu|kerala|maharashtra|gujarat|haryana|delhi|west\s*bengal|rajasthan|uttar\s*pradesh|madhya\s*pradesh)india$"
)
GARBAGE_CITY = GARBAGE_PLACE + r"|^(StateStreet|AmericanExpress|GLOBELANCE|Crunchyroll|Capco|TriNetTriNet|Andaz)\s+"
GARBAGE_DEGREE = r"\\\.|\(\?:|\?:|\(\?=|\(\?!|\[\^"


def experience_is_bad(low: str, high: str) -> str:
    """A known figure that is no number or above 100, or a least above the most."""
    n = lambda c: f"TRY_CAST({trim(c)} AS DOUBLE)"
    odd = lambda c: f"(NOT {lost(c)} AND {n(c)} IS NULL) OR coalesce({n(c)} > 100, false)"
    return f"({odd(low)} OR {odd(high)} OR coalesce({n(low)} > {n(high)}, false))"
