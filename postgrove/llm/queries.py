"""Queries of the training-data operators over the test tables, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from postgrove.functions.timeparse import parse_instant
from postgrove.llm.boilerplate import main_text, page_lines
from postgrove.llm.canonical import map_places
from postgrove.llm.history import History, ad_key, word_shingles
from postgrove.contract import known, missing
from postgrove.functions.source import site
from postgrove.llm.linkage import link
from postgrove.llm.mixing import mix, mixture_report
from postgrove.llm.packing import pack
from postgrove.llm.spam import score_pages, spam_pages
from postgrove.llm.survivor import survivors
from postgrove.llm.tokens import token_count
from postgrove.session import shared_dir, spread, stored, table

_MISSING = "('', 'not specified', 'not_specified', 'not available', 'n/a', 'na', 'none', 'null', '-')"


#: The archive joins the history in so many steps, each some whole batches in the order of their times.
STEPS = 3


def _in_steps(archive: DataFrame, steps: int = STEPS) -> list[DataFrame]:
    """The archive's batches, earliest first, cut at whole batches; a batch without a time is earliest."""
    at = parse_instant(F.col("extracted_at_utc"))
    cuts = archive.agg(F.percentile_approx(F.unix_micros(at), [i / steps for i in range(1, steps)]).alias("c")).first().c or []
    edges = [None, *sorted(set(cuts)), None]
    micros = F.coalesce(F.unix_micros(at), F.lit(-(2**62)))
    return [archive.filter((micros > low if low is not None else F.lit(True)) & (micros <= high if high is not None else F.lit(True))) for low, high in zip(edges, edges[1:])]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    key = F.array(ad_key(F.col("source"), F.col("job_id"), F.col("link")))
    history = History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}")
    history.append(table(spark, d, "jobs").select("source", "job_id", "link"), key)
    order = [parse_instant(F.col("extracted_at_utc"))]
    return reduce(DataFrame.unionByName, [history.accept(batch, "archive_id", key, order) for batch in _in_steps(table(spark, d, "batch_archive"))])


def p7_near(spark: SparkSession, d: str) -> DataFrame:
    """Archive rows whose description is like an earlier one, of the jobs or the archive, by five-word shingles at 0.8."""
    history = History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", bands=20, rows=5, threshold=0.8)
    shingles = word_shingles(known(F.col("full_description")))
    history.append(spread(table(spark, d, "jobs").select("row_id", "full_description"), "row_id"), shingles)
    order = [parse_instant(F.col("extracted_at_utc"))]
    steps = _in_steps(spread(table(spark, d, "batch_archive").select("archive_id", "extracted_at_utc", "full_description"), "archive_id"), 2)
    return reduce(DataFrame.unionByName, [history.accept(batch, "archive_id", shingles, order) for batch in steps])


_AD = rf"""
CASE WHEN nl IS NOT NULL THEN site_l || ':' || nl WHEN nj IS NOT NULL THEN src || ':' || nj END AS ad FROM (SELECT *, CASE
    WHEN site_l = 'linkedin' THEN coalesce(nullif(regexp_extract(l, '/jobs/view/(?:[^?#]*?-)?(\d{{6,}})/*(?:[?#]|$)', 1), ''), nullif(regexp_extract(l, '[?&]currentjobid=(\d{{6,}})(?:[&#]|$)', 1), ''))
    WHEN site_l = 'naukri' THEN nullif(regexp_extract(l, '^[^?#]*-(\d{{6,}})/*(?:[?#]|$)', 1), '')
    WHEN site_l = 'indeed' THEN nullif(regexp_extract(l, '[?&]jk=([0-9a-f]{{12,20}})(?:[&#]|$)', 1), '') END AS nl,
  CASE WHEN src = 'indeed' THEN nullif(regexp_extract(j, '^([0-9a-f]{{12,20}})$', 1), '') ELSE nullif(regexp_extract(j, '^(\d{{6,}})$', 1), '') END AS nj
  FROM (SELECT *, CASE WHEN h LIKE '%lnkboard%' THEN 'linkedin' WHEN h LIKE '%nkrjobs%' THEN 'naukri' WHEN h LIKE '%indboard%' THEN 'indeed' END AS site_l
  FROM (SELECT *, lower(link) AS l, regexp_extract(lower(link), '^\s*https?://([^/?#]+)', 1) AS h,
    regexp_replace(lower(trim(job_id)), '^(?:(?:linkedin|naukri|indeed)[\s_:.-]*)*', '') AS j,
    regexp_extract(regexp_replace(lower(source), '[^a-z]', '', 'g'), '^(linkedin|naukri|indeed)', 1) AS src"""

def _linked(spark: SparkSession, d: str) -> DataFrame:
    f = F.col
    return link(
        spread(table(spark, d, "jobs"), "row_id"), spread(table(spark, d, "raw_postings"), "posting_id"), "row_id", "posting_id",
        {"title": f("title"), "company": f("company"), "place": f("city"), "text": f("full_description")},
        {"title": f("title"), "company": f("company"), "place": f("location"), "text": f("job_description_summary")},
        finished=True,
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).select("row_id", "posting_id")


def p1_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return page_lines(spread(table(spark, d, "jobs"), "row_id"), "row_id", "full_description", "company", "skills", ranges=None)


def p3_main_text(spark: SparkSession, d: str) -> DataFrame:
    return main_text(spread(table(spark, d, "jobs"), "row_id"), "row_id", "full_description", "company", "skills", ranges=None)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return map_places(table(spark, d, "jobs"), table(spark, d, "city_ref"), "row_id")


def _cluster_values(spark: SparkSession, d: str) -> DataFrame:
    """(cluster_id, row_id, field, value, cut, trust, at) of the clustered rows, one for each field."""
    jobs = table(spark, d, "jobs").select("row_id", site(F.col("source")).alias("site"), "collected_at", "degree_required", "skills")
    trust = table(spark, d, "source_trust").select(site(F.col("source")).alias("site"), "trust_rank")  # one row a site
    rows = table(spark, d, "job_clusters").join(jobs, "row_id").join(trust, "site", "left")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), known(F.col(f)).alias("value")) for f in ("degree_required", "skills")])
    return rows.select("cluster_id", "row_id", "trust_rank", parse_instant(F.col("collected_at")).alias("at"), F.explode(fields).alias("f")).select(
        "cluster_id", "row_id", "f.field", "f.value", "trust_rank", F.unix_micros("at").alias("at"),
        F.col("f.value").rlike(r"(?:…|\.\.\.)\s*\z").cast("int").alias("cut"),
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rank = [F.col("cut"), F.col("trust_rank"), -F.col("at")]
    return survivors(_cluster_values(spark, d), "cluster_id", "field", "value", "row_id", rank=rank).select("cluster_id", "field", "row_id")


def p5_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The survivors by summed votes: whole values count four times, trusted sources more."""
    weight = F.when(F.col("cut") == 1, 0.25).otherwise(1.0) / F.coalesce(F.col("trust_rank"), F.lit(4))
    return survivors(_cluster_values(spark, d), "cluster_id", "field", "value", "row_id", weight=weight)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages(spread(table(spark, d, "documents"), "doc_id"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return score_pages(spread(table(spark, d, "documents"), "doc_id"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every speech in containers of each capacity."""
    sized = stored(spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id").select("doc_id", token_count(F.col("text")).alias("n")), "tokens")
    out = None
    for r in table(spark, d, "pack_bins").orderBy("bin_type").collect():  # three rows, fixed
        one = pack(sized, "doc_id", F.col("n"), r.capacity_tokens).select(F.lit(r.bin_type).alias("bin_type"), "bin_id", "slot", "doc_id", "piece", "tokens")
        out = one if out is None else out.unionByName(one)
    return out


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used and the share of their room that is filled."""
    used = p8_packed(spark, d).filter("bin_id IS NOT NULL").groupBy("bin_type").agg(F.max("bin_id").alias("bins"), F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"))
    return used.join(F.broadcast(table(spark, d, "pack_bins")), "bin_type").select("bin_type", "capacity_tokens", "bins", "pieces", "tokens", (F.col("tokens") / (F.col("bins") * F.col("capacity_tokens"))).alias("filled"))


def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mix(spread(table(spark, d, "documents").select("doc_id", "source", "text"), "doc_id"), table(spark, d, "source_weights"), "doc_id", "source", token_count(F.col("text")))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixture_report(p9_mixed(spark, d), table(spark, d, "source_weights"))


QUERIES = {"p8_packed": p8_packed, "p8_fill": p8_fill, "p9_mixed": p9_mixed, "p9_report": p9_report, "p1_found": p1_found, "p1_confidence": p1_confidence, "p10_found": p10_found, "p10_scores": p10_scores, "p3_found": p3_found, "p3_main_text": p3_main_text, "p4_found": p4_found, "p5_found": p5_found, "p5_consensus": p5_consensus, "p7_found": p7_found, "p7_near": p7_near}
ORACLE = {
    "p5_found": rf"""
WITH v AS (
  SELECT c.cluster_id, j.row_id, f.field, CASE WHEN f.field = 'skills' THEN j.skills ELSE j.degree_required END AS v, t.trust_rank, j.collected_at AS c
  FROM job_clusters c JOIN jobs j USING (row_id) CROSS JOIN (VALUES ('skills'), ('degree_required')) f(field)
  LEFT JOIN source_trust t ON regexp_extract(regexp_replace(lower(j.source), '[^a-z]', '', 'g'), '^(linkedin|naukri|indeed)', 1) = lower(t.source)
), r AS (
  SELECT *, CASE WHEN regexp_full_match(c, '\d{{9,11}}') THEN to_timestamp(CAST(c AS BIGINT)) AT TIME ZONE 'UTC'
    WHEN regexp_full_match(c, '\d{{2}}-.*') THEN try_strptime(c, '%d-%m-%Y %H:%M') WHEN contains(c, '/') THEN try_strptime(c, '%Y/%m/%d %H:%M')
    WHEN contains(c, ',') THEN try_strptime(c, '%d %b %Y, %H:%M') ELSE TRY_CAST(c AS TIMESTAMP) END AS seen
  FROM v WHERE v IS NOT NULL AND lower(trim(v)) NOT IN {_MISSING}
)
SELECT cluster_id, field, row_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id, field ORDER BY
  regexp_matches(v, '(…|\.\.\.)\s*$'), trust_rank NULLS LAST, seen DESC NULLS LAST, row_id) AS n FROM r) WHERE n = 1""",
    "p7_found": f"""
WITH old AS (SELECT DISTINCT {_AD} FROM jobs)))),
new AS (SELECT archive_id, CAST(extracted_at_utc AS TIMESTAMPTZ) AS seen_at, {_AD} FROM batch_archive)))),
ranked AS (SELECT archive_id, ad, row_number() OVER (PARTITION BY ad ORDER BY seen_at, archive_id) AS r FROM new WHERE ad IS NOT NULL)
SELECT archive_id FROM ranked WHERE r > 1 OR ad IN (SELECT ad FROM old WHERE ad IS NOT NULL)""",
}
