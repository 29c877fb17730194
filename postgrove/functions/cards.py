"""Card-level parsing of a portal's postings: experience, freshness, links, titles from links, places."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postgrove.contract import NOT_SPECIFIED
from postgrove.functions.text import clean

_YEARS = r"\s*(?:years?|yrs?)"
#: Range, open range, then figures tied to the word experience.
_RANGE = rf"(?i)\b(\d+)\s*(?:to|-)\s*(\d+){_YEARS}\b"
_OPEN = rf"(?i)\b(\d+)\s*\+{_YEARS}\b"
_SINGLE = [rf"(?i)\b(\d+){_YEARS}\s*(?:of\s+)?experience\b", rf"(?i)\bexperience\s+(?:of\s+)?(\d+){_YEARS}\b", rf"(?i)\bexperience\s*[:\-]\s*(\d+){_YEARS}\b"]


def card_experience(c: Column) -> Column:
    """``a to b years``, ``a+ years`` or ``a years`` from a card's text; else the placeholder."""
    t = clean(c)
    got = lambda p, g=1: F.nullif(F.regexp_extract(t, p, g), F.lit(""))
    single = F.coalesce(*[got(p) for p in _SINGLE])
    return F.coalesce(F.concat(got(_RANGE), F.lit(" to "), got(_RANGE, 2), F.lit(" years")), F.concat(got(_OPEN), F.lit("+ years")), F.concat(single, F.lit(" years")), F.lit(NOT_SPECIFIED))


def last_day(c: Column) -> Column:
    """Whether the words of a card tell of the last day; false for null."""
    t = F.lower(F.trim(c))
    days = F.regexp_extract(t, r"\bposted\s+(\d+)\s+days?\s+ago\b", 1).try_cast("int")
    return F.coalesce(t.rlike(r"\bposted\s+today\b|\bjust\s+now\b|\b\d+\s+hours?\s+ago\b") | F.coalesce(days <= 1, F.lit(False)), F.lit(False))


def absolute_url(c: Column, base: str) -> Column:
    """A link made absolute against the site; empty where none comes of it."""
    t = F.coalesce(clean(c), F.lit(""))
    full = F.when(t.startswith("//"), F.concat(F.lit("https:"), t)).when(t.startswith("/"), F.concat(F.lit(base.rstrip("/")), t)).otherwise(t)
    return F.when(full.startswith("http"), full).otherwise("")


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", "-"), F.lit("-"))


#: Headings that scrapers take for a title.
GENERIC_TITLES = ["", "not specified", "job description", "job details", "about the role", "about the job", "job summary", "key responsibilities"]


def title_from_link(title: Column, link: Column, company: Column, location: Column) -> Column:
    """The title, or where it is a generic heading the words of the link before the company, else before the first place named."""
    last = F.element_at(F.split(F.regexp_replace(F.split_part(link, F.lit("?"), F.lit(1)), r"/+$", ""), "/"), -1)
    body = F.regexp_replace(F.regexp_replace(last, r"(?i)^job-listings-", ""), r"(?i)-\d+-to-\d+-years?-\d+$", "")

    def before(text: Column, mark: Column) -> Column:
        """What stands before the mark as whole words; null where it does not stand there."""
        at = F.instr(F.concat(F.lit("-"), text, F.lit("-")), F.concat(F.lit("-"), mark, F.lit("-")))
        return F.when((mark != "") & (at > 0), F.btrim(F.substr(text, F.lit(1), F.greatest(at - 1, F.lit(0))), F.lit("-")))

    places = F.transform(F.split(F.coalesce(location, F.lit("")), "[,/]"), slug)
    cut = F.coalesce(before(body, slug(company)), F.try_element_at(F.filter(F.transform(places, lambda p: before(body, p)), lambda x: x.isNotNull()), F.lit(1)), body)
    words = F.trim(F.replace(cut, F.lit("-"), F.lit(" ")))
    generic = F.lower(F.trim(F.coalesce(title, F.lit("")))).isin(GENERIC_TITLES)
    return F.when(generic, F.coalesce(F.nullif(words, F.lit("")), F.lit(NOT_SPECIFIED))).otherwise(title)


def clean_place(c: Column, company: Column, garbage: str) -> Column:
    """A place text without scraper garbage and not a company with something glued to it; false where empty."""
    t, firm = F.coalesce(clean(c), F.lit("")), F.coalesce(clean(company), F.lit(""))
    glued = (firm != "") & F.contains(F.lower(t), F.lower(firm)) & (F.length(t) > F.length(firm) + 10)
    return (t != "") & ~t.rlike(garbage) & ~glued
