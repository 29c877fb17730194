"""Dates and times written in many layouts.  The present enters as an argument, never from the clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postgrove.contract import known, trimmed

#: Layouts tried in order; with two-digit groups first, the day comes first.
LAYOUTS = [
    (r"\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}", "yyyy/M/d H:mm"),
    (r"\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}", "yyyy/M/d H:mm:ss"),
    (r"\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{2}", "d-M-yyyy H:mm"),
    (r"\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{2}:\d{2}", "d-M-yyyy H:mm:ss"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}", "d/M/yyyy H:mm"),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}", "d/M/yyyy H:mm:ss"),
    (r"\d{1,2} [A-Za-z]{3} \d{4}, \d{1,2}:\d{2}", "d MMM yyyy, H:mm"),
    (r"\d{1,2} [A-Za-z]{3} \d{4}", "d MMM yyyy"),
    (r"\d{1,2}[-]\d{1,2}[-]\d{4}", "d-M-yyyy"),
]


def parse_instant(c: Column) -> Column:
    """A timestamp (UTC under a UTC session) from ISO text, epoch seconds or one of ``LAYOUTS``; else null."""
    v = known(trimmed(c))
    out = F.when(v.rlike(r"^\d{9,11}(\.\d+)?$"), F.timestamp_seconds(v.try_cast("double")))
    for pattern, layout in LAYOUTS:
        out = out.when(v.rlike(f"^{pattern}$"), F.try_to_timestamp(v, F.lit(layout)))
    return out.otherwise(v.try_cast("timestamp"))


def posted_instant(c: Column, now: Column) -> Column:
    """When a posting was put up, from relative words, layouts or ISO text; offsets are dropped, not converted.

    Relative phrases are tried before layouts and anywhere in the text; "today" is six hours ago.
    """
    v = F.lower(trimmed(c))
    ago = lambda unit: F.nullif(F.regexp_extract(v, unit, 1), F.lit("")).try_cast("double")
    back = lambda seconds: F.timestamp_micros(F.unix_micros(now) - (seconds * 1_000_000).cast("bigint"))
    minutes, hours, days = ago(r"(\d+)\s*(?:minutes?|mins?|m)\b"), ago(r"(\d+)\s*(?:hours?|hrs?|h)\b"), ago(r"(\d+)\s*(?:days?|d)\b")
    weeks, months = ago(r"(\d+)\s*(?:weeks?|w)\b"), ago(r"(\d+)\s*(?:months?|mo)\b")
    text = F.regexp_replace(trimmed(c), r"(?:Z|[+-]\d{2}:?\d{2})$", "")
    relative = (
        F.when(v.rlike(r"\b(?:just now|just posted|moments? ago|now)\b"), now).when(v.rlike(r"\bfew hours\b"), back(F.lit(9000.0)))
        .when(v.rlike(r"\ban? hour\b"), back(F.lit(3600.0))).when(minutes.isNotNull(), back(minutes * 60)).when(hours.isNotNull(), back(hours * 3600))
        .when(v.rlike(r"\ba day\b"), back(F.lit(86400.0))).when(v.rlike(r"\bfew days\b"), back(F.lit(172800.0))).when(v.rlike(r"\btoday\b"), back(F.lit(21600.0)))
        .when(v.rlike(r"\byesterday\b"), back(F.lit(86400.0))).when(days.isNotNull(), back(days * 86400)).when(weeks.isNotNull(), back(weeks * 604800))
        .when(months.isNotNull(), back(months * 2592000))
    )
    dated = v.rlike(r"^\d{4}[-/]\d{1,2}|^\d{1,2}[-/]\d|^\d{1,2} [a-z]{3} \d{4}")
    return F.when(~dated & relative.isNotNull(), relative).otherwise(parse_instant(text))


def within_recency(c: Column, now: Column, hours: float, strict: bool = False) -> Column:
    """Fresh within the window and its tolerance; unknown dates pass unless strict; the future does not."""
    buffer = 3.0 if hours >= 24 else 0.5
    only_date = trimmed(c).rlike(r"^\d{4}-\d{2}-\d{2}$")
    days = max(1, int(hours // 24))

    def fits(at: Column) -> Column:
        age = (F.unix_micros(now) - F.unix_micros(at)) / 3.6e9
        by_date = (F.to_date(at) == F.to_date(now)) if hours < 24 else (F.to_date(at) >= F.date_sub(F.to_date(now), days))
        return F.when(at.isNull(), F.lit(not strict)).when(only_date, by_date & (F.to_date(at) <= F.to_date(now))).otherwise((age <= hours + buffer) & (age >= -0.2))

    return F.transform(F.array(posted_instant(c, now)), fits)[0]  # the instant is bound once


def ist_stamp(c: Column, layout: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """UTC to India's wall clock, UTC+5:30."""
    return F.date_format(c + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), layout)


def age_words(then: Column, now: Column) -> Column:
    """``5 Mins Ago``, ``3 Hours Ago``, ``2 Days Ago``."""
    mins = F.floor((F.unix_micros(now) - F.unix_micros(then)) / 6e7).cast("bigint")
    return (
        F.when(mins < 60, F.concat(F.greatest(mins, F.lit(1)).cast("string"), F.lit(" Mins Ago"))).when(mins < 1440, F.concat(F.floor(mins / 60).cast("string"), F.lit(" Hours Ago")))
        .otherwise(F.concat(F.floor(mins / 1440).cast("string"), F.lit(" Days Ago")))
    )
