"""Row queries over postings and keys: cleaning, parsing, search, joins, sets, quality, streams, models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postgrove.contract import ns, trimmed
from postgrove.functions.category import domain_of, slot_of
from postgrove.functions.education import normalize_education
from postgrove.functions.experience import career_tier, experience_display, experience_number, experience_problems, parse_experience, review_reason, sentence_experience
from postgrove.functions.location import polluted_city, polluted_country, polluted_state, repair_fields, split_location, strict_city
from postgrove.functions.skills import canonical_skill, catalog_skills, extract_skills, labelled_skills, skill_items
from postgrove.functions.source import site
from postgrove.functions.text import bare_url, canonical_url, clean, fallback_job_id, joined_skills, slugify, split_list, strip_html
from postgrove.functions.timeparse import ist_stamp, parse_instant, posted_instant, within_recency
from postgrove.operators import ml, pipeline, quality, search
from postgrove.operators.relevance import role_relevant
from postgrove.plans.sqltext import GARBAGE_CITY, GARBAGE_DEGREE, GARBAGE_PLACE, SITE, cleaned, experience_is_bad, found, instant, known, lost, number, trim
from postgrove.session import shared_dir, spread, table
from postgrove.sources.readers import clean_record_gate, json_ld, json_ld_skills
from postgrove.streaming import streams

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def jobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "jobs")


# Cleaning and parsing ---------------------------------------------------------------------------------------------

@query(r"SELECT doc_id, trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g')) AS text FROM documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", clean(F.col("text")).alias("text"))


@query(r"""SELECT row_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(full_description, '(?i)<\s*/?\s*(?:p|div|li|ul|ol|br|h[1-6]|tr|td|table|section|article)\b[^>]*>', ' ', 'g'),
  '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM jobs""".replace("regexp_replace(replace(replace(", "regexp_replace(replace(replace(").replace("'&amp;', '&'), '\\s+'", "'&amp;', '&'), '[\\s\\x{00A0}]+'"))
def strip_html_text(spark, d):
    return jobs(spark, d).select("row_id", strip_html(F.col("full_description")).alias("text"))


@query(f"SELECT row_id, CASE WHEN company IS NULL OR {trim('company')} = '' THEN 'Not Specified' ELSE {trim('company')} END AS company FROM jobs")
def placeholder_fill(spark, d):
    return jobs(spark, d).select("row_id", ns(F.col("company")).alias("company"))


@query(r"""SELECT row_id, 'x_' || substr(sha256(CASE WHEN length(trim(coalesce(link, ''))) > 0 THEN source || '|' || lower(regexp_replace(regexp_replace(trim(link), '[?#].*$', ''), '/+$', ''))
  ELSE lower(concat_ws('|', source, title, company, city)) END), 1, 16) AS job_key FROM jobs""")
def fallback_ids(spark, d):
    return jobs(spark, d).select("row_id", fallback_job_id(F.lit("x"), F.col("source"), F.col("link"), F.col("title"), F.col("company"), F.col("city")).alias("job_key"))


@query(r"SELECT row_id, regexp_replace(regexp_replace(link, '[?#].*$', ''), '/+$', '') || '/' AS url, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM jobs")
def url_canonical(spark, d):
    return jobs(spark, d).select("row_id", canonical_url(F.col("link")).alias("url"), slugify(F.col("title")).alias("slug"))


@query()
def skills_joined(spark, d):
    return jobs(spark, d).select("row_id", joined_skills(F.col("skills")).alias("skills"))


@query(f"SELECT row_id, {number('min_experience_years')} AS lo, {number('max_experience_years')} AS hi FROM jobs")
def experience_numbers(spark, d):
    return jobs(spark, d).select("row_id", experience_number(F.col("min_experience_years")).alias("lo"), experience_number(F.col("max_experience_years")).alias("hi"))


@query(f"""SELECT row_id, CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN CASE WHEN lo = hi THEN p(lo) || ' Yrs' ELSE p(lo) || ' - ' || p(hi) || ' Yrs' END WHEN lo IS NOT NULL THEN p(lo) || '+ Yrs' WHEN hi IS NOT NULL THEN 'Up to ' || p(hi) || ' Yrs' ELSE 'Not Specified' END AS shown
  FROM (SELECT row_id, {number('min_experience_years')} AS lo, {number('max_experience_years')} AS hi FROM jobs)""".replace("p(lo)", "regexp_replace(CAST(round(lo, 2) AS VARCHAR), '\\.0$', '')").replace("p(hi)", "regexp_replace(CAST(round(hi, 2) AS VARCHAR), '\\.0$', '')"))
def career_display(spark, d):
    lo, hi = experience_number(F.col("min_experience_years")), experience_number(F.col("max_experience_years"))
    return jobs(spark, d).select("row_id", experience_display(lo, hi).alias("shown"))


@query(r"""SELECT posting_id, CASE WHEN r1 <> '' THEN r1 WHEN p1 <> '' THEN p1 WHEN m1 <> '' THEN m1 WHEN y1 <> '' THEN y1 END AS low, CASE WHEN r1 <> '' THEN r2 WHEN p1 <> '' OR m1 <> '' OR y1 <> '' THEN 'Not Specified' END AS high FROM (
  SELECT posting_id, regexp_extract(t, '(\d+)\s*(?:-|–|—|to)\s*\d+\s*(?:years?|yrs?)', 1) AS r1, regexp_extract(t, '\d+\s*(?:-|–|—|to)\s*(\d+)\s*(?:years?|yrs?)', 1) AS r2, regexp_extract(t, '(\d+)\s*\+\s*(?:years?|yrs?)', 1) AS p1,
    regexp_extract(t, '(?:minimum|min\.?|at least)\s*(?:of\s*)?(\d+)\s*(?:years?|yrs?)', 1) AS m1, regexp_extract(t, '(\d+)\s*(?:years?|yrs?)', 1) AS y1 FROM (SELECT posting_id, lower(experience) AS t FROM raw_postings))""")
def parse_experience_text(spark, d):
    x = parse_experience(F.col("experience"))
    return table(spark, d, "raw_postings").select("posting_id", x["low"].alias("low"), x["high"].alias("high"))


@query()
def experience_reviews(spark, d):
    """What should be looked at in the figures of the second raw shape, whose texts hold them."""
    text = F.concat_ws(". ", "job_description_summary", F.concat(F.lit("Experience: "), F.col("experience")))
    low, high = F.regexp_extract("experience", r"(\d+\+?)", 1), F.regexp_extract("experience", r"\d\D+(\d+\+?)", 1)
    return table(spark, d, "raw_postings").select("posting_id", review_reason(text, low, high, F.col("url")).alias("reason")).filter("reason <> ''")


@query()
def experience_by_sentence(spark, d):
    x = sentence_experience(F.concat_ws(". ", "experience", "job_description_summary"))
    return table(spark, d, "raw_postings").select("posting_id", x["low"].alias("low"), x["high"].alias("high"))


@query()
def split_locations(spark, d):
    return table(spark, d, "raw_postings").select("posting_id", split_location(F.col("location")).alias("p")).select("posting_id", "p.*")


@query()
def repaired_places(spark, d):
    return jobs(spark, d).select("row_id", repair_fields(F.col("city"), F.col("state"), F.col("country")).alias("p")).select("row_id", "p.*")


@query("""SELECT row_id FROM jobs WHERE regexp_matches(lower(coalesce(city, '')), 'pune|pimpri') AND NOT regexp_matches(lower(city), 'bengaluru|bangalore|chennai|hyderabad|mumbai|thane|delhi|noida|gurugram|gurgaon|ghaziabad|kolkata|calcutta|coimbatore|ahmedabad|kochi|jaipur|dubai|singapore|canada|usa')""")
def strict_city_match(spark, d):
    return jobs(spark, d).filter(strict_city(F.col("city"), "Pune")).select("row_id")


@query(f"SELECT row_id, {found('city', GARBAGE_CITY)} AS city, {found('state', GARBAGE_PLACE)} AS state, {found('country', GARBAGE_PLACE)} OR ({found('country', '(?i)india')} AND lower({cleaned('country')}) <> 'india') AS country FROM jobs")
def polluted_places(spark, d):
    return jobs(spark, d).select("row_id", polluted_city(F.col("city")).alias("city"), polluted_state(F.col("state")).alias("state"), polluted_country(F.col("country")).alias("country"))


@query()
def education_normalized(spark, d):
    return jobs(spark, d).select("row_id", normalize_education(F.col("degree_required")).alias("degree"))


@query()
def skill_extract_catalog(spark, d):
    return spread(jobs(spark, d), "row_id").select("row_id", extract_skills(F.col("full_description")).alias("skills"))


@query()
def skill_evidence(spark, d):
    return jobs(spark, d).select("row_id", F.explode(catalog_skills(F.col("skills"))).alias("s")).select("row_id", "s.*")


@query()
def skills_after_label(spark, d):
    return jobs(spark, d).select("row_id", labelled_skills(F.col("full_description")).alias("skills")).filter("skills IS NOT NULL")


@query(f"SELECT row_id, {instant('collected_at')} AS seen FROM jobs")
def collected_instants(spark, d):
    return jobs(spark, d).select("row_id", parse_instant(F.col("collected_at")).cast("timestamp_ntz").alias("seen"))


_AGO = "CAST(event_id % 40 AS VARCHAR) || ' ' || CASE event_id % 4 WHEN 0 THEN 'minutes' WHEN 1 THEN 'hours' WHEN 2 THEN 'days' ELSE 'weeks' END || ' ago'"


def _posted(spark, d):
    unit = F.element_at(F.array(*[F.lit(x) for x in ("minutes", "hours", "days", "weeks")]), (F.pmod("event_id", F.lit(4)) + 1).cast("int"))
    return table(spark, d, "events").select("event_id", F.concat(F.pmod("event_id", F.lit(40)).cast("string"), F.lit(" "), unit, F.lit(" ago")).alias("said"))


@query("""SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' - to_seconds((event_id % 40) * CASE event_id % 4 WHEN 0 THEN 60 WHEN 1 THEN 3600 WHEN 2 THEN 86400 ELSE 604800 END) AS posted FROM events""")
def parse_posted_date(spark, d):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return _posted(spark, d).select("event_id", posted_instant(F.col("said"), now).cast("timestamp_ntz").alias("posted"))


@query("""SELECT event_id FROM events WHERE (event_id % 40) * CASE event_id % 4 WHEN 0 THEN 60 WHEN 1 THEN 3600 WHEN 2 THEN 86400 ELSE 604800 END <= (72 + 3) * 3600""")
def recency_strict(spark, d):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return _posted(spark, d).filter(within_recency(F.col("said"), now, 72, True)).select("event_id")


@query("SELECT event_id, strftime(ts + INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S') AS ist FROM events")
def ist_stamps(spark, d):
    return table(spark, d, "events").select("event_id", ist_stamp(F.col("ts").cast("timestamp")).alias("ist"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsonb_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query()
def json_ld_scan(spark, d):
    """JSON-LD records made of postings, scanned back out of their pages."""
    page = F.concat(F.lit("<html><script type='application/ld+json'>"), F.to_json(F.struct(F.col("title"), F.split("skills", r"\s*[,;|]\s*").alias("skills"))), F.lit("</script><script type=application/ld+json>{broken</script></html>"))
    return table(spark, d, "raw_postings").filter("skills IS NOT NULL").select("posting_id", F.explode(json_ld(page)).alias("record")).select("posting_id", F.get_json_object("record", "$.title").alias("title"), F.size(json_ld_skills(F.col("record"))).alias("skills"))


@query()
def role_relevance(spark, d):
    return spread(jobs(spark, d), "row_id").select("row_id", role_relevant(F.col("title"), F.col("search_keyword")).alias("relevant"))


_DOMAIN = "CASE WHEN coalesce(Keywords, '') = '' THEN NULL " + " ".join(
    f"WHEN regexp_matches(lower(Keywords), '{terms}') THEN {i}" for i, terms in enumerate((
        "data analyst|data scientist|data engineer|business analyst|power bi|analytics", "python developer|python backend|django|fastapi|flask|python",
        "java developer|full stack java|spring boot|core java|java", "cloud engineer|aws devops|azure engineer|kubernetes|devops|cloud|aws|gcp"))
) + " END"
_SLOT = "CASE " + " ".join(
    f"WHEN k <> '' AND len(list_filter({phrases}, lambda p: contains(k, p) OR contains(p, k))) > 0 THEN {i}" for i, phrases in enumerate((
        ["data analyst", "data scientist", "data engineer", "business analyst", "power bi"], ["python developer", "python backend", "django developer", "fastapi developer"],
        ["java developer", "full stack java", "spring boot developer", "core java"], ["cloud engineer", "aws devops", "azure engineer", "kubernetes developer"]))
) + " " + " ".join(
    f"WHEN len(list_filter(string_split_regex(k, '[\\s,/-]+'), lambda w: list_contains({words}, w))) > 0 THEN {i}" for i, words in enumerate((
        ["data", "scientist", "business", "power", "bi"], ["python", "django", "fastapi"], ["java", "spring", "boot", "core"], ["cloud", "aws", "devops", "azure", "kubernetes"]))
) + " END"


@query(f"""SELECT Batch_CSV_File, slot, CASE WHEN coalesce(Keywords, '') = '' THEN 'General Extraction' WHEN d IS NULL THEN 'Custom Extraction' ELSE ['Data & Analytics', 'Python Development', 'Java Development', 'Cloud & DevOps'][d + 1] END AS domain
  FROM (SELECT Batch_CSV_File, Keywords, CAST({_SLOT} AS INTEGER) AS slot, {_DOMAIN} AS d FROM (SELECT *, lower(trim(Keywords)) AS k FROM extraction_history))""")
def slots_and_domains(spark, d):
    return table(spark, d, "extraction_history").select("Batch_CSV_File", slot_of(F.col("Keywords")).alias("slot"), domain_of(F.col("Keywords")).alias("domain"))


# Search -----------------------------------------------------------------------------------------------------------

@query(f"""SELECT row_id, title, company, city FROM jobs WHERE title ILIKE '%engineer%' OR company ILIKE '%engineer%' OR skills ILIKE '%engineer%' OR city ILIKE '%engineer%'
  ORDER BY {instant('collected_at')} DESC NULLS LAST, row_id LIMIT 25 OFFSET 25""")
def search_page(spark, d):
    hits = jobs(spark, d).filter(search.any_like("engineer", "title", "company", "skills", "city"))
    return search.page(hits, [parse_instant(F.col("collected_at")).desc_nulls_last(), F.col("row_id")], 2).select("row_id", "title", "company", "city")


@query("SELECT count(*) AS total, CAST(ceil(count(*) / 25.0) AS BIGINT) AS pages FROM jobs WHERE city ILIKE '%pune%' AND source ILIKE '%naukri%'")
def search_count(spark, d):
    return search.page_count(jobs(spark, d).filter(search.any_like("pune", "city") & search.any_like("naukri", "source")))


@query("SELECT row_id FROM jobs WHERE contains(lower(concat_ws(' ', title, company, city, state, source, skills, search_keyword)), 'data engineer')")
def search_blob(spark, d):
    return jobs(spark, d).filter(search.in_blob("data engineer", "title", "company", "city", "state", "source", "skills", "search_keyword")).select("row_id")


@query("""SELECT row_id FROM jobs WHERE state ILIKE '%Karnataka%' OR city ILIKE '%bengaluru%' OR city ILIKE '%bangalore%' OR city ILIKE '%mysuru%' OR city ILIKE '%mysore%' OR city ILIKE '%hubli%' OR city ILIKE '%mangalore%'""")
def state_metro_expand(spark, d):
    return jobs(spark, d).filter(search.in_state("Karnataka")).select("row_id")


@query("SELECT row_id, CASE WHEN x <= '1' THEN 'freshers' WHEN x >= '1' AND x <= '3' THEN 'early' WHEN x >= '3' AND x <= '5' THEN 'mid' WHEN x >= '5' THEN 'senior' END AS bucket FROM (SELECT row_id, min_experience_years AS x FROM jobs)")
def exp_bucket_lexicographic(spark, d):
    return jobs(spark, d).select("row_id", search.text_experience_bucket(F.col("min_experience_years")).alias("bucket"))


@query(f"SELECT row_id, CASE WHEN x <= 1 THEN 'freshers' WHEN x <= 3 THEN 'early' WHEN x <= 5 THEN 'mid' ELSE 'senior' END AS bucket FROM (SELECT row_id, coalesce({number('min_experience_years')}, 0) AS x FROM jobs)")
def exp_bucket_numeric(spark, d):
    return jobs(spark, d).select("row_id", search.numeric_experience_bucket(experience_number(F.col("min_experience_years"))).alias("bucket"))


@query("SELECT event_id FROM events")
def freshness_with_fallback(spark, d):
    """Nothing is fresh by a far date, so all rows stay."""
    return search.fresh_or_all(table(spark, d, "events"), F.col("ts") >= F.lit("2030-01-01").cast("timestamp_ntz")).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'")
def timeframe_month(spark, d):
    o = table(spark, d, "orders")
    lo, hi = F.lit("1998-03-01").cast("timestamp_ntz"), F.lit("1998-04-01").cast("timestamp_ntz")
    return search.fresh_or_all(o, (F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select("o_orderkey")


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 50")
def recent_last_n(spark, d):
    return table(spark, d, "events").orderBy(F.desc("event_id")).limit(50).select("event_id", "event_type")


@query("SELECT row_id, full_description FROM jobs WHERE row_id = 7")
def point_lookup(spark, d):
    return jobs(spark, d).filter("row_id = 7").select("row_id", "full_description")


@query("""SELECT keyword, row_id FROM (SELECT search_keyword AS keyword, row_id, row_number() OVER (PARTITION BY search_keyword ORDER BY row_id) AS r FROM jobs WHERE search_keyword IS NOT NULL) WHERE r <= 5""")
def limit_per_keyword(spark, d):
    """The first five of each keyword: the limit is the feature."""
    w = Window.partitionBy("search_keyword").orderBy("row_id")
    return jobs(spark, d).filter("search_keyword IS NOT NULL").withColumn("r", F.row_number().over(w)).filter("r <= 5").select(F.col("search_keyword").alias("keyword"), "row_id")


# Keys, sets and merges --------------------------------------------------------------------------------------------

@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def fresh_left_anti(spark, d):
    o = table(spark, d, "orders")
    return pipeline.fresh(o, o.filter("o_orderstatus = 'F'"), "o_orderkey").select("o_orderkey")


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def seen_union(spark, d):
    a = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return a.union(table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")).distinct()


@query("""SELECT CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b' ELSE 'both' END AS side, count(*) AS keys FROM (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'F') a
  FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'R') b ON a.k = b.k GROUP BY 1""")
def reconcile_full_outer(spark, d):
    a = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("k"))
    return quality.reconcile(a, table(spark, d, "lineitem").filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("k")), "k")


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def reconcile_except(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").select("o_custkey"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'P'), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderpriority <> '1-URGENT')
  SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'insert' WHEN n.k IS NULL THEN 'delete' WHEN o.v <> n.v THEN 'update' ELSE 'keep' END AS action FROM o FULL JOIN n ON o.k = n.k""")
def mirror_sync_upsert_delete(spark, d):
    o = table(spark, d, "orders")
    old = o.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    new = o.filter("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v"))
    return pipeline.mirror(old, new, "k")


_LINE = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE}) AS r FROM lineitem) WHERE r = 1")
def batch_first_occurrence(spark, d):
    return pipeline.first_occurrence(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE.split(", ")]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY lower({trim("coalesce(title, '')")}), lower({trim("coalesce(company, '')")}), lower({trim("coalesce(city, '')")}) ORDER BY coalesce(collected_at, '') DESC, row_id DESC) AS r FROM jobs) WHERE r > 1""")
def dedup_losers(spark, d):
    key = [F.lower(trimmed(F.coalesce(c, F.lit("")))) for c in ("title", "company", "city")]
    return pipeline.losers(jobs(spark, d), key, [F.desc(F.coalesce("collected_at", F.lit(""))), F.desc("row_id")]).select("row_id")


@query("SELECT job_id, count(*) AS n FROM jobs GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids_having(spark, d):
    return quality.duplicate_ids(jobs(spark, d), "job_id")


@query(f"""SELECT a.row_id, CASE WHEN {known('a.company')} THEN a.company ELSE b.company END AS company FROM jobs a LEFT JOIN (SELECT archive_id, company FROM batch_archive) b ON a.row_id = b.archive_id""".replace("CASE WHEN", "CASE WHEN").replace("ELSE b.company END", "ELSE coalesce(b.company, a.company) END"))
def backfill_unset(spark, d):
    detail = table(spark, d, "batch_archive").select(F.col("archive_id").alias("row_id"), "company")
    return pipeline.fill_unset(jobs(spark, d).select("row_id", "company"), detail, "row_id", ["company"])


@query(f"SELECT coalesce({SITE}, 'unknown') AS site, count(*) AS collected, count(*) FILTER (WHERE {known('link')}) AS normalized, count(*) FILTER (WHERE NOT {known('link')}) AS skipped_invalid FROM jobs GROUP BY 1")
def run_report(spark, d):
    from postgrove.contract import missing

    rows = jobs(spark, d).select(F.coalesce(site(F.col("source")), F.lit("unknown")).alias("site"), "link")
    return pipeline.run_report(rows, "site", ~missing(F.col("link")))


@query(r"SELECT row_id, job_id, link FROM jobs WHERE length(trim(job_id)) > 0 AND NOT regexp_matches(job_id, '[:\s]') AND regexp_matches(link, '^https?://')")
def clean_record_filter(spark, d):
    return clean_record_gate(jobs(spark, d).select("row_id", "job_id", "link"))


@query()
def normalize_postings(spark, d):
    return pipeline.normalize(table(spark, d, "raw_postings"), "Portal", "2026-01-01T00:00:00+00:00")[0]


@query()
def enrich_unset(spark, d):
    return pipeline.enrich(jobs(spark, d).select("row_id", "skills", "degree_required", "full_description")).select("row_id", "skills", "degree_required")


@query()
def append_and_mirror(spark, d):
    """A keyed table written twice and read back."""
    from pyspark.sql import types as T

    from postgrove.sources.readers import KeyedTable

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    t = KeyedTable(spark, f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}", "k", schema)
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    t.append(o.filter("o_orderstatus = 'F'"), [F.col("v")])
    t.upsert(o.filter("o_orderstatus = 'O'"))
    return t.read()


ORACLE["append_and_mirror"] = "SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus IN ('F', 'O')"


# Quality ----------------------------------------------------------------------------------------------------------

_RULES = [(f"missing_{f}", lost(f)) for f in quality.REQUIRED] + [
    ("unknown_source", f"{SITE} IS NULL"), ("polluted_city", found("city", GARBAGE_CITY)), ("polluted_state", found("state", GARBAGE_PLACE)),
    ("polluted_country", f"{found('country', GARBAGE_PLACE)} OR ({found('country', '(?i)india')} AND lower({cleaned('country')}) <> 'india')"),
    ("polluted_education", found("degree_required", GARBAGE_DEGREE)), ("bad_experience", experience_is_bad("min_experience_years", "max_experience_years")),
    ("bad_link", f"NOT {lost('link')} AND NOT regexp_matches(link, '^https?://')"),
]


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, count(*) FILTER (WHERE {c}) AS broken FROM jobs" for n, c in _RULES))
def dq_audit_summary(spark, d):
    return quality.audit(jobs(spark, d)).select(F.col("check").alias("check_name"), "broken")


@query(" UNION ALL ".join(f"SELECT row_id, '{n}' AS problem FROM jobs WHERE {c}" for n, c in _RULES))
def dq_problem_rows(spark, d):
    return quality.problems(jobs(spark, d), "row_id")


@query()
def dq_experience_problems(spark, d):
    return jobs(spark, d).select("row_id", F.explode(experience_problems(F.col("min_experience_years"), F.col("max_experience_years"))).alias("problem"))


@query("SELECT city, count(*) AS n FROM jobs WHERE state ILIKE '%tamil%' OR state IN ('TN', 'Tamilnadu') GROUP BY 1 ORDER BY n DESC, city LIMIT 30")
def state_city_counts(spark, d):
    keep = F.coalesce(F.col("state").ilike("%tamil%") | F.col("state").isin("TN", "Tamilnadu"), F.lit(False))
    return jobs(spark, d).filter(keep).groupBy("city").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col("city").asc_nulls_last()).limit(30)


# Streams ----------------------------------------------------------------------------------------------------------

def _events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    copied = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    e.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "ts").write.parquet(copied)
    return streams.file_stream(spark, copied, e.withColumn("ts", F.col("ts").cast("timestamp")).schema, 4)


@query("SELECT DISTINCT user_id FROM events")
def stream_dedup(spark, d):
    s = streams.seen_dedup(_events(spark, d).select("user_id"), "user_id")
    return streams.run_to_end(s, f"{shared_dir(spark)}/ck-{uuid.uuid4().hex}")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling(spark, d):
    s = streams.tumbling(_events(spark, d), "ts", "1 hour", "40 days", ["event_type"])
    out = streams.run_to_end(s, f"{shared_dir(spark)}/ck-{uuid.uuid4().hex}", "update", keys=["start", "event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


# Models -----------------------------------------------------------------------------------------------------------

@query()
def train_lr(spark, d):
    """Precision and recall by language on a fifth held out by hash."""
    docs = table(spark, d, "documents").filter("lang IN ('en', 'de', 'fr') AND length(trim(text)) > 0").select("doc_id", "text", "lang")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = ml.train_classifier(docs.filter(~held), "text", "lang")
    return ml.confusion(ml.predict(model, docs.filter(held), "lang"), "lang", "predicted")


@query("SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def group_means(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))
