"""Rows that fail to parse: strict load, anti-join on offsets, diagnosis of the remainder.

``strict_load`` keeps the records that are sound comma-separated text with the contract's number of fields and
valid values; ``rejects`` subtracts their offsets and texts from the raw ones and names the fault of what is left.

Defined cases: a null record is rejected as ``column_count`` (it has no field); an empty text too; a byte-order
mark in front is dropped; records with one offset, or with none, are told apart by their texts, and each faulty one is
reported, with a null offset where it has none; extra columns of the input are
kept by ``strict_load`` under their own names behind the contract's, a name that clashes with a contract column
gets the prefix ``raw_``.

The patterns use possessive groups only: java.util.regex walks those in a loop, so a record of many megabytes
with many quotes neither recurses nor backtracks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postgrove.contract import CSV_FIELDS

FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
SOUND = rf"(?s)\A{FIELD}(?:,{FIELD})*+\z"
#: Control characters but tab, line feed and carriage return, and the replacement character.
BAD_TEXT = r"[�[\p{Cc}&&[^\t\n\r]]]"


def _body(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\A﻿", "")


def _fields(body: Column) -> Column:
    # Every match begins with a comma, so that none is empty.
    return F.regexp_extract_all(F.concat(F.lit(","), body), F.lit(rf"(?s),({FIELD})"), 1)


def _plain(field: Column) -> Column:
    return F.when(field.startswith('"'), F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))).otherwise(field)


def strict_load(raw: DataFrame, record: str = "raw_record", fields: list[str] = CSV_FIELDS) -> DataFrame:
    """Only the conforming records, one column per field; all other input columns are kept."""
    exact = rf"(?s)\A{FIELD}(?:,{FIELD}){{{len(fields) - 1}}}+\z"
    body = _body(F.col(record))
    rest = [F.col(f"`{c}`").alias(f"raw_{c}" if c in fields else c) for c in raw.columns if c != record]
    loaded = raw.filter(body.rlike(exact)).select(*rest, F.transform(_fields(body), _plain).alias("__f"))
    loaded = loaded.select(*[F.col(f"`{c}`") for c in loaded.columns if c != "__f"], *[F.col("__f")[i].alias(n) for i, n in enumerate(fields)])
    return loaded.filter(_valid("job_id", "link", "full_description"))


def _valid(job_id: str, link: str, text: str) -> Column:
    return (
        (F.length(job_id) > 0) & ~F.col(job_id).rlike(r"[\s :]")
        & F.col(link).rlike(r"\Ahttps?://")
        & ~F.col(text).rlike(BAD_TEXT)
    )


def rejects(raw: DataFrame, offset: str = "record_no", record: str = "raw_record", fields: list[str] = CSV_FIELDS) -> DataFrame:
    """(offset, reason) of every faulty record: ``quoting``, else ``column_count``, else ``invalid_value``."""
    # A record is its offset and its text, so a repeated or missing offset hides no faulty record behind a sound one.
    keyed = raw.select(F.col(offset).alias("__at"), F.col(record).alias("__raw"), F.xxhash64(record).alias("__h"))
    loaded = strict_load(keyed, "__raw", fields).select(F.col("__at").alias("__lat"), F.col("__h").alias("__lh"))
    left = keyed.select("__at", "__h", _body(F.col("__raw")).alias("__body")).join(loaded, (F.col("__h") == F.col("__lh")) & F.col("__at").eqNullSafe(F.col("__lat")), "left_anti")
    sound = F.col("__body").rlike(SOUND)
    whole = (F.size("__f") == len(fields)) & (F.length(F.col("__body")) > 0)
    diagnosed = left.withColumn("__f", F.when(sound, _fields(F.col("__body"))))
    reason = (
        F.when(F.col("__body").isNull(), "column_count").when(~sound, "quoting").when(~whole, "column_count").otherwise("invalid_value")
    )
    return diagnosed.select(F.col("__at").alias(offset), reason.alias("reason"))
