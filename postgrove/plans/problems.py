"""Queries of the general data problems (2 and 6) over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postgrove.functions.source import site
from postgrove.operators.packed import infer_delimiters, long_form, split_packed
from postgrove.operators.rejects import rejects, strict_load
from postgrove.plans.sqltext import SITE
from postgrove.session import spread, table

PACKED = ["skills", "degree_required", "specialization_required"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects(table(spark, d, "unified_jobs"))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    return strict_load(table(spark, d, "unified_jobs")).drop("file_name")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(spread(table(spark, d, "jobs"), "row_id"), "row_id", PACKED, site(F.col("source")))


def p6_delimiters(spark: SparkSession, d: str) -> DataFrame:
    return infer_delimiters(long_form(table(spark, d, "jobs"), "row_id", F.coalesce(site(F.col("source")), F.lit("")), PACKED)).withColumnRenamed("__source", "source")


QUERIES = {"p2_found": p2_found, "p2_loaded": p2_loaded, "p6_found": p6_found, "p6_delimiters": p6_delimiters}

# DuckDB has no possessive groups and no lookaround: the text is cut at the quotes instead.  Pieces at odd
# positions (from 1) stand outside quotes; a sound text has an even number of quotes, and every outside piece is
# empty between two quotes or touches them with commas only.
_P2_PARTS = r"""
parts AS (
  SELECT record_no, body, string_split(body, '"') AS s FROM (
    SELECT record_no, CASE WHEN starts_with(raw_record, chr(65279)) THEN substr(raw_record, 2) ELSE raw_record END AS body FROM unified_jobs)
), judged AS (
  SELECT record_no, body, s, len(s) AS n,
    (len(s) % 2 = 1) AND NOT list_contains(list_transform(range(1, len(s) + 1), lambda i:
        i % 2 = 1 AND len(s) > 1 AND CASE
          WHEN i = 1 THEN NOT (s[i] = '' OR ends_with(s[i], ','))
          WHEN i = len(s) THEN NOT (s[i] = '' OR starts_with(s[i], ','))
          ELSE NOT (s[i] = '' OR (starts_with(s[i], ',') AND ends_with(s[i], ','))) END), true) AS sound
  FROM parts
), marked AS (
  SELECT record_no, body, sound, array_to_string(list_transform(range(1, n + 1), lambda i:
    CASE WHEN i % 2 = 0 THEN s[i] WHEN s[i] = '' AND i > 1 AND i < n THEN '"' ELSE replace(s[i], ',', chr(64976)) END), '') AS m
  FROM judged
), cut AS (SELECT record_no, body, sound, string_split(m, chr(64976)) AS f FROM marked
), named AS (
  SELECT record_no, f, CASE
    WHEN body IS NULL THEN 'column_count' WHEN NOT sound THEN 'quoting' WHEN len(f) <> 15 OR body = '' THEN 'column_count'
    WHEN f[1] = '' OR regexp_matches(f[1], '[\s\x{00A0}:]') OR NOT (starts_with(f[14], 'http://') OR starts_with(f[14], 'https://'))
      OR regexp_matches(f[15], '[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{009F}]') THEN 'invalid_value' END AS reason
  FROM cut
)"""
_P2_COLUMNS = "job_id source title company city state country min_experience_years max_experience_years skills degree_required specialization_required collected_at link full_description".split()

_P6 = r"""
WITH long AS (
  SELECT row_id, 'skills' AS field, skills AS v FROM jobs UNION ALL SELECT row_id, 'degree_required', degree_required FROM jobs
  UNION ALL SELECT row_id, 'specialization_required', specialization_required FROM jobs
), held AS (
  SELECT row_id, field, regexp_replace(regexp_replace(v, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g'), '^\[(?s:(.*?))\]?$', '\1') AS v FROM long
  WHERE v IS NOT NULL AND lower(regexp_replace(v, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')) NOT IN
    ('', 'not specified', 'not_specified', 'not available', 'n/a', 'na', 'none', 'null', '-')
), toks AS (
  SELECT row_id, field, regexp_extract_all(v, '"[^"]*(?:"|$)|\((?:[^()]|\([^()]*\))*(?:\)|$)|\s/\s|[,;|\n\r\t·•▪]|[^,;|\n\r\t·•▪"(/\s]+|(?s:.)') AS t FROM held
), glued AS (
  SELECT row_id, field, array_to_string(list_transform(t, lambda x: CASE WHEN regexp_full_match(x, '\s/\s|[,;|\n\r\t·•▪]') THEN chr(1) ELSE x END), '') AS g FROM toks
), items AS (
  SELECT row_id, field, list_filter(list_transform(list_transform(list_transform(list_transform(string_split(g, chr(1)),
      lambda x: regexp_replace(x, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')),
      lambda x: regexp_replace(x, '^(?:[-*•▪–—]+|\d{1,3}[.)])(?:[\s\x{00A0}]+|$)', '')),
      lambda x: regexp_replace(x, '^"([^"]*)"$', '\1')),
      lambda x: regexp_replace(x, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')), lambda x: x <> '') AS i FROM glued
)
SELECT row_id, field, CAST(p AS INTEGER) AS pos, i[p] AS item FROM (SELECT row_id, field, i, unnest(range(1, len(i) + 1)) AS p FROM items WHERE len(i) > 1)
"""

# The candidates' figures: the text is cut into tokens, and each candidate divides at its own tokens alone.
_P6_DELIMITERS = r"""
WITH long AS (
  SELECT {site} AS source, 'skills' AS field, skills AS v FROM jobs UNION ALL SELECT {site}, 'degree_required', degree_required FROM jobs
  UNION ALL SELECT {site}, 'specialization_required', specialization_required FROM jobs
), held AS (
  SELECT coalesce(source, '') AS source, field, row_number() OVER () AS id, regexp_replace(regexp_replace(v, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g'), '^\[(?s:(.*?))\]?$', '\1') AS v FROM long
  WHERE v IS NOT NULL AND lower(regexp_replace(v, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')) NOT IN
    ('', 'not specified', 'not_specified', 'not available', 'n/a', 'na', 'none', 'null', '-')
), toks AS (
  SELECT source, field, id, v, regexp_extract_all(v, '"[^"]*(?:"|$)|\((?:[^()]|\([^()]*\))*(?:\)|$)|\s[/&]\s|[,;|\n\r\t·•▪:]|[^,;|\n\r\t·•▪:"(/&\s]+|(?s:.)') AS t FROM held
), cand(name, mark) AS (VALUES ('comma', ','), ('semicolon', ';'), ('pipe', '\|'), ('line', '[\n\r]'), ('tab', '\t'), ('dot', '·'), ('bullet', '[•▪]'), ('colon', ':'), ('slash', '\s/\s'), ('ampersand', '\s&\s')
), cut AS (
  SELECT source, field, id, name, list_filter(list_transform(string_split(array_to_string(list_transform(t, lambda x: CASE WHEN regexp_full_match(x, mark) THEN chr(1) ELSE x END), ''), chr(1)),
    lambda x: regexp_replace(x, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')), lambda x: x <> '') AS p
  FROM toks CROSS JOIN cand WHERE len(list_filter(t, lambda x: regexp_full_match(x, mark))) > 0
), counted AS (
  SELECT source, field, id, name, len(p) AS n, len(list_filter(p, lambda x: length(x) <= 90 AND regexp_matches(x, '^[\s\x{{00A0}}•▪*"\[-]*[\p{{L}}\p{{N}}.(]'))) AS ok, max(len(p)) OVER (PARTITION BY id) AS most FROM cut
), sums AS (
  SELECT source, field, name, count(*) AS held, count(*) FILTER (WHERE n > 1 AND n = most) AS leads, sum(n) AS pieces, sum(ok) AS regular FROM counted GROUP BY 1, 2, 3
), rated AS (
  SELECT source, field, name, held AS support, (leads + 10.0 * (sum(leads) OVER w + 10.0 * belief) / (sum(held) OVER w + 10.0)) / (held + 10.0) AS consistency,
    (regular + 10.0 * (sum(regular) OVER w + 10.0 * belief) / (sum(pieces) OVER w + 10.0)) / (pieces + 10.0) AS regularity
  FROM (SELECT *, CASE WHEN name IN ('colon', 'ampersand') THEN 0.3 ELSE 0.9 END AS belief FROM sums) WINDOW w AS (PARTITION BY name)
)
SELECT *, consistency >= 0.7 AND regularity >= 0.8 AS accepted FROM rated
""".format(site=SITE)

ORACLE = {
    "p6_delimiters": _P6_DELIMITERS,
    "p2_found": f"WITH {_P2_PARTS} SELECT record_no, reason FROM named WHERE reason IS NOT NULL",
    "p2_loaded": f"WITH {_P2_PARTS} SELECT record_no, {', '.join(f'f[{i + 1}] AS {c}' for i, c in enumerate(_P2_COLUMNS))} FROM named WHERE reason IS NULL",
    "p6_found": _P6,
}
