"""Further row, report and repair queries, each with its SQL where SQL can say it."""

from __future__ import annotations

import re
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postgrove.contract import QUALITY_MISSING, known, missing, trimmed
from postgrove.functions.cards import absolute_url, card_experience, clean_place, last_day, title_from_link
from postgrove.functions.degrees import explicit_degrees, text_without_degrees
from postgrove.functions.experience import clean_experience, experience_number, is_number, url_experience
from postgrove.functions.category import BODY_RULES, TITLE_RULES
from postgrove.functions.location import CITY_STATE, MAP_STATES, PLACE_GARBAGE, STATES, strict_city
from postgrove.functions.skills import CANONICAL, CATALOG, IGNORED, REPORTED, names_skill
from postgrove.functions.source import site
from postgrove.functions.text import id_from_url, parse_bool, split_list
from postgrove.operators import ml, pipeline, quality
from postgrove.operators.search import any_like
from postgrove.plans import dashboard, postings
from postgrove.plans.sqltext import GARBAGE_PLACE, SITE, cleaned, known as sql_known, lost, number, trim
from postgrove.session import spread, table

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


# Reports ----------------------------------------------------------------------------------------------------------

_STATES = ", ".join(f"('{v}')" for v in sorted(set(MAP_STATES.values())))
_PLACED = dashboard.ORACLE["state_priority_lookup"]


@query(f"WITH names(state) AS (VALUES {_STATES}), placed AS ({_PLACED}) SELECT names.state, count(placed.row_id) AS n FROM names LEFT JOIN placed ON placed.place_state = names.state GROUP BY 1")
def state_counts_zero_filled(spark, d):
    """Postings of every state of the map, those without any included."""
    names = spark.createDataFrame([(v,) for v in sorted(set(MAP_STATES.values()))], "state string")
    counts = dashboard.QUERIES["state_priority_lookup"](spark, d).groupBy(F.col("place_state").alias("state")).agg(F.count("*").alias("n"))
    return names.join(counts, "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT place_state AS state, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS share FROM ({_PLACED}) WHERE place_state IS NOT NULL GROUP BY 1")
def national_share(spark, d):
    """Each state's share of all placed postings, to one decimal."""
    counts = dashboard.QUERIES["state_priority_lookup"](spark, d).filter("place_state IS NOT NULL").groupBy(F.col("place_state").alias("state")).agg(F.count("*").alias("n"))
    return counts.select("state", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1).alias("share"))  # a row for each state


@query(f"""WITH c AS (SELECT {trim('city')} AS city, count(*) AS n FROM jobs WHERE {sql_known('city')} GROUP BY 1)
SELECT coalesce((SELECT city FROM c ORDER BY n DESC, city LIMIT 1), 'Bengaluru') AS top_city, (SELECT round(avg(x), 4) FROM (SELECT {number('min_experience_years')} AS x FROM jobs)) AS mean_experience""")
def top_city_experience(spark, d):
    """The most frequent city, with a default, and the mean of the known least years; one aggregate each."""
    cities = jobs(spark, d).filter(~missing(F.col("city"))).groupBy(trimmed(F.col("city")).alias("city")).agg(F.count("*").alias("n"))
    top = cities.agg(F.min(F.struct((-F.col("n")).alias("n"), "city")).alias("t")).select(F.coalesce("t.city", F.lit("Bengaluru")).alias("top_city"))
    mean = jobs(spark, d).agg(F.round(F.avg(experience_number(F.col("min_experience_years"))), 4).alias("mean_experience"))
    return top.join(F.broadcast(mean))  # two single rows


@query(f"""SELECT CASE WHEN upper({trim('city')}) IN ('CT', 'CT, INDIA') THEN 'Pan-India (Flexible)' ELSE {trim('city')} END AS city, count(*) AS n, CAST(round(100.0 * count(*) / (SELECT count(*) FROM jobs)) AS BIGINT) AS pct
  FROM jobs WHERE {sql_known('city')} GROUP BY 1 ORDER BY n DESC, city LIMIT 5""")
def top_five_cities(spark, d):
    c = trimmed(F.col("city"))
    city = F.when(F.upper(c).isin("CT", "CT, INDIA"), "Pan-India (Flexible)").otherwise(c)
    total = jobs(spark, d).agg(F.count("*").alias("all"))
    top = jobs(spark, d).filter(~missing(F.col("city"))).groupBy(city.alias("city")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "city").limit(5)
    return top.join(F.broadcast(total)).select("city", "n", F.round(100.0 * F.col("n") / F.col("all")).cast("bigint").alias("pct"))


_COSINE = "SELECT a.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


def _neighbours(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    return e.join(other, "vec_id").select("vec_id", (dot("x", "y") / F.sqrt(dot("x", "x") * dot("y", "y"))).alias("s"))


@query(f"""SELECT CASE WHEN s < 0.2 THEN 'below 0.2' WHEN s < 0.4 THEN '0.2 to 0.4' WHEN s < 0.6 THEN '0.4 to 0.6' ELSE '0.6 and more' END AS band, count(*) AS n, round(avg(s), 5) AS mean, round(min(s), 5) AS least, round(max(s), 5) AS most FROM ({_COSINE}) GROUP BY 1""")
def similarity_bands(spark, d):
    s = F.col("s")
    band = F.when(s < 0.2, "below 0.2").when(s < 0.4, "0.2 to 0.4").when(s < 0.6, "0.4 to 0.6").otherwise("0.6 and more")
    return _neighbours(spark, d).groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg("s"), 5).alias("mean"), F.round(F.min("s"), 5).alias("least"), F.round(F.max("s"), 5).alias("most"))


@query(f"(SELECT 'lowest' AS side, vec_id FROM ({_COSINE}) ORDER BY round(s, 9), vec_id LIMIT 10) UNION ALL (SELECT 'highest', vec_id FROM ({_COSINE}) ORDER BY round(s, 9) DESC, vec_id LIMIT 10)")
def similarity_extremes(spark, d):
    """The ten least and most similar neighbours."""
    s = _neighbours(spark, d).withColumn("r", F.round("s", 9))
    low, high = s.orderBy("r", "vec_id").limit(10), s.orderBy(F.desc("r"), "vec_id").limit(10)
    return low.select(F.lit("lowest").alias("side"), "vec_id").unionByName(high.select(F.lit("highest").alias("side"), "vec_id"))


@query(f"SELECT coalesce({SITE}, 'unknown') AS site, count(*) AS n FROM batch_archive WHERE extracted_at_utc = (SELECT max(extracted_at_utc) FROM batch_archive) GROUP BY 1")
def newest_batch_by_source(spark, d):
    rows = table(spark, d, "batch_archive")
    newest = rows.agg(F.max("extracted_at_utc").alias("extracted_at_utc"))  # one row
    return rows.join(F.broadcast(newest), "extracted_at_utc").groupBy(F.coalesce(site(F.col("source")), F.lit("unknown")).alias("site")).agg(F.count("*").alias("n"))


@query("SELECT CAST(CASE WHEN arg_max(Slot, Extraction_Time_UTC) FILTER (WHERE Slot IS NOT NULL) IS NULL THEN 6 % 4 ELSE (arg_max(Slot, Extraction_Time_UTC) FILTER (WHERE Slot IS NOT NULL) + 1) % 4 END AS INTEGER) AS next_slot FROM extraction_history")
def next_slot(spark, d):
    """The slot after the last one run; by the hour (6) where none is known."""
    last = table(spark, d, "extraction_history").filter("Slot IS NOT NULL").agg(F.max_by("Slot", "Extraction_Time_UTC").alias("s"))
    return last.select(F.coalesce((F.col("s") + 1) % 4, F.lit(6 % 4)).cast("int").alias("next_slot"))


@query("SELECT record_no, file_name FROM unified_jobs ORDER BY record_no LIMIT 25 OFFSET 25")
def file_order_page(spark, d):
    """The second page in the order of the file."""
    return table(spark, d, "unified_jobs").select("record_no", "file_name").orderBy("record_no").offset(25).limit(25)


@query(f"SELECT row_id, 'missing_link' AS problem FROM jobs WHERE {lost('link')} ORDER BY row_id LIMIT 20")
def problem_preview(spark, d):
    """The first twenty rows of one quality rule."""
    return quality.problems(jobs(spark, d), "row_id").filter("problem = 'missing_link'").orderBy("row_id").limit(20)


@query("SELECT row_id FROM jobs ORDER BY md5('42:' || row_id), row_id LIMIT 10")
def seeded_sample(spark, d):
    """Ten rows drawn by a seeded hash: the same on every run and partitioning."""
    return jobs(spark, d).select("row_id").orderBy(F.md5(F.concat(F.lit("42:"), F.col("row_id").cast("string"))), "row_id").limit(10)


# Filters ----------------------------------------------------------------------------------------------------------

@query(f"""SELECT row_id FROM jobs WHERE {SITE} IN ('linkedin', 'naukri') AND coalesce({number('min_experience_years')}, 0) BETWEEN 1 AND 6 AND degree_required ILIKE '%B.Tech%'""")
def explorer_filter(spark, d):
    """Several filters at once: sources, years (unknown counts as none), a degree that contains a text."""
    years = F.coalesce(experience_number(F.col("min_experience_years")), F.lit(0.0))
    return jobs(spark, d).filter(site(F.col("source")).isin("linkedin", "naukri") & years.between(1, 6) & F.col("degree_required").ilike("%B.Tech%")).select("row_id")


@query("""SELECT row_id FROM jobs WHERE lower(trim(state)) IN ('karnataka', 'ka') OR (regexp_matches(lower(city), 'bengaluru|bangalore|mysuru|mysore') AND NOT regexp_matches(lower(city),
  'chennai|hyderabad|pune|pimpri|mumbai|thane|delhi|noida|gurugram|gurgaon|ghaziabad|kolkata|calcutta|coimbatore|ahmedabad|kochi|jaipur'))""")
def scope_state(spark, d):
    """A state by name or id, or a strict match of one of its cities."""
    cities = ["bengaluru", "mysuru"]
    named = F.coalesce(F.lower(F.trim("state")).isin("karnataka", "ka"), F.lit(False))
    return jobs(spark, d).filter(named | F.coalesce(reduce(or_, [strict_city(F.col("city"), c) for c in cities]), F.lit(False))).select("row_id")


def _filled(c: str, v: str) -> str:
    return f"CASE WHEN {trim('coalesce(' + c + ', chr(32))')} IN ('', 'Not Specified') THEN '{v}' ELSE {c} END AS {c}"


@query(f"""SELECT row_id, 'Pune' AS city, {_filled('state', 'Maharashtra')}, {_filled('country', 'India')} FROM jobs WHERE contains(lower(coalesce(city, '')), 'pune') OR contains(lower(coalesce(link, '')), 'pune')
  OR regexp_matches(lower(coalesce(full_description, '')), 'location :pune|location: pune|in pune') OR contains(left(lower(coalesce(full_description, '')), 400), 'pune')""")
def location_relevance(spark, d):
    """Postings of one asked place, by city, link or description; the city is set to the asked one, unset state and country are filled."""
    return pipeline.located(jobs(spark, d), "Pune", CITY_STATE).select("row_id", "city", "state", "country")


@query(f"SELECT posting_id, {cleaned('coalesce(location, chr(32))')} <> '' AND NOT regexp_matches({cleaned('coalesce(location, chr(32))')}, '{GARBAGE_PLACE.split('|(telangana')[0]}') AND NOT ({cleaned('coalesce(company, chr(32))')} <> '' AND contains(lower({cleaned('coalesce(location, chr(32))')}), lower({cleaned('coalesce(company, chr(32))')})) AND length({cleaned('coalesce(location, chr(32))')}) > length({cleaned('coalesce(company, chr(32))')}) + 10) AS clean FROM raw_postings")
def clean_place_flag(spark, d):
    return table(spark, d, "raw_postings").select("posting_id", clean_place(F.col("location"), F.col("company"), "(?i)" + "|".join(PLACE_GARBAGE)).alias("clean"))


# Joins and writes -------------------------------------------------------------------------------------------------

@query("SELECT c.cluster_id, j.row_id, j.degree_required FROM job_clusters c JOIN jobs j USING (row_id)")
def prediction_truth_join(spark, d):
    """Inner join of two tables on their shared id."""
    return table(spark, d, "job_clusters").join(jobs(spark, d).select("row_id", "degree_required"), "row_id").select("cluster_id", "row_id", "degree_required")


@query("SELECT o.o_orderkey, c.c_name FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100) o LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
def newest_hundred_embed(spark, d):
    """The newest hundred, each with its one partner or none."""
    newest = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return newest.join(c, "o_custkey", "left").select("o_orderkey", "c_name")


@query(f"SELECT row_id, CASE WHEN {trim('country')} = 'Haryana, India' THEN 'Haryana' ELSE state END AS state, CASE WHEN {trim('country')} = 'Haryana, India' THEN 'India' ELSE country END AS country FROM jobs")
def targeted_repair(spark, d):
    """One known fault mended in place: a state that slipped into the country."""
    slipped = F.coalesce(trimmed(F.col("country")) == "Haryana, India", F.lit(False))
    return jobs(spark, d).select("row_id", F.when(slipped, "Haryana").otherwise(F.col("state")).alias("state"), F.when(slipped, "India").otherwise(F.col("country")).alias("country"))


@query("SELECT Batch_CSV_File, Jobs_Extracted_Now AS n FROM extraction_history UNION ALL SELECT 'run.csv', 7")
def record_run(spark, d):
    """A run appended to its history, as one more file, and the history read back."""
    held = table(spark, d, "extraction_history").select("Batch_CSV_File", F.col("Jobs_Extracted_Now").alias("n"))
    return pipeline.append_row(held, {"Batch_CSV_File": "run.csv", "n": 7}, f"history-{uuid.uuid4().hex}")


# Cards ------------------------------------------------------------------------------------------------------------

_TEXT = cleaned("concat_ws(' ', experience, job_description_summary)")


@query(rf"""SELECT posting_id, CASE WHEN regexp_matches(t, '(?i)\b(\d+)\s*(?:to|-)\s*(\d+)\s*(?:years?|yrs?)\b') THEN regexp_extract(t, '(?i)\b(\d+)\s*(?:to|-)\s*(\d+)\s*(?:years?|yrs?)\b', 1) || ' to ' || regexp_extract(t, '(?i)\b(\d+)\s*(?:to|-)\s*(\d+)\s*(?:years?|yrs?)\b', 2) || ' years'
  WHEN regexp_matches(t, '(?i)\b\d+\s*\+\s*(?:years?|yrs?)\b') THEN regexp_extract(t, '(?i)\b(\d+)\s*\+\s*(?:years?|yrs?)\b', 1) || '+ years'
  WHEN regexp_matches(t, '(?i)\b\d+\s*(?:years?|yrs?)\s*(?:of\s+)?experience\b') THEN regexp_extract(t, '(?i)\b(\d+)\s*(?:years?|yrs?)\s*(?:of\s+)?experience\b', 1) || ' years'
  WHEN regexp_matches(t, '(?i)\bexperience\s+(?:of\s+)?\d+\s*(?:years?|yrs?)\b') THEN regexp_extract(t, '(?i)\bexperience\s+(?:of\s+)?(\d+)\s*(?:years?|yrs?)\b', 1) || ' years'
  WHEN regexp_matches(t, '(?i)\bexperience\s*[:\-]\s*\d+\s*(?:years?|yrs?)\b') THEN regexp_extract(t, '(?i)\bexperience\s*[:\-]\s*(\d+)\s*(?:years?|yrs?)\b', 1) || ' years' ELSE 'Not Specified' END AS experience FROM (SELECT posting_id, {_TEXT} AS t FROM raw_postings)""")
def card_experience_text(spark, d):
    return table(spark, d, "raw_postings").select("posting_id", card_experience(F.concat_ws(" ", "experience", "job_description_summary")).alias("experience"))


_POSTED = "'Posted ' || (event_id % 12) || CASE event_id % 4 WHEN 0 THEN ' hours ago' WHEN 1 THEN ' days ago' WHEN 2 THEN ' day ago' ELSE ' weeks ago' END"


@query(rf"""SELECT event_id, regexp_matches(t, '\bposted\s+today\b|\bjust\s+now\b|\b\d+\s+hours?\s+ago\b') OR coalesce(TRY_CAST(nullif(regexp_extract(t, '\bposted\s+(\d+)\s+days?\s+ago\b', 1), '') AS INTEGER) <= 1, false) AS last_day FROM (SELECT event_id, lower({_POSTED}) AS t FROM events)""")
def last_day_flag(spark, d):
    unit = F.element_at(F.array(*map(F.lit, (" hours ago", " days ago", " day ago", " weeks ago"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", last_day(F.concat(F.lit("Posted "), F.col("event_id") % 12, unit)).alias("last_day"))


@query(f"SELECT posting_id, CASE WHEN starts_with(f, 'http') THEN f ELSE '' END AS url FROM (SELECT posting_id, CASE WHEN starts_with(t, '//') THEN 'https:' || t WHEN starts_with(t, '/') THEN 'https://portal.example' || t ELSE t END AS f FROM (SELECT posting_id, coalesce({cleaned('url')}, '') AS t FROM raw_postings))")
def absolute_links(spark, d):
    return table(spark, d, "raw_postings").select("posting_id", absolute_url(F.col("url"), "https://portal.example/").alias("url"))


@query()
def titles_from_links(spark, d):
    """Generic titles replaced by the words of the link."""
    return table(spark, d, "raw_postings").select("posting_id", title_from_link(F.col("title"), F.col("url"), F.col("company"), F.col("location")).alias("title"))


@query()
def explicit_degree_labels(spark, d):
    text = F.concat_ws("\n", "full_description", F.concat(F.lit("Education: "), known(F.col("degree_required"))))
    return spread(jobs(spark, d).select("row_id", text.alias("t")), "row_id").select("row_id", explicit_degrees(F.col("t")).alias("degrees"))


@query()
def specialization_text(spark, d):
    return spread(jobs(spark, d).select("row_id", "full_description"), "row_id").select("row_id", text_without_degrees(F.col("full_description")).alias("text"))


@query(f"SELECT row_id, CASE WHEN trim(coalesce(specialization_required, '')) <> '' THEN specialization_required ELSE title END AS text FROM jobs")
def prepared_texts(spark, d):
    """The extracted text, else the original."""
    return jobs(spark, d).select("row_id", F.when(F.trim(F.coalesce("specialization_required", F.lit(""))) != "", F.col("specialization_required")).otherwise(F.col("title")).alias("text"))


@query(f"""SELECT row_id, CASE WHEN len(s) = 0 THEN ['Technical Aptitude', 'Problem Solving'] ELSE s[1:5] END AS skills FROM (SELECT row_id, list_filter(list_transform(string_split_regex(coalesce(skills, ''), '[,|;]'), lambda x: {trim('x')}),
  lambda x: x <> '' AND lower(x) <> 'not specified') AS s FROM jobs)""")
def sample_projection(spark, d):
    """The first five skills of each posting, with a default."""
    items = F.filter(F.transform(F.split(F.coalesce("skills", F.lit("")), r"[,|;]"), trimmed), lambda x: (x != "") & (F.lower(x) != "not specified"))
    few = F.transform(F.array(items), lambda s: F.when(F.size(s) == 0, F.array(F.lit("Technical Aptitude"), F.lit("Problem Solving"))).otherwise(F.slice(s, 1, 5)))[0]
    return jobs(spark, d).select("row_id", few.alias("skills"))


@query("SELECT row_id, list_sort(list_distinct(list_filter(string_split_regex(lower(concat_ws(' ', title, company, skills)), '[^a-z0-9]+'), lambda x: x <> ''))) AS tokens FROM jobs")
def token_column(spark, d):
    """The sorted distinct tokens a text search would index."""
    words = F.filter(F.split(F.lower(F.concat_ws(" ", "title", "company", "skills")), r"[^a-z0-9]+"), lambda x: x != "")
    return jobs(spark, d).select("row_id", F.array_sort(F.array_distinct(words)).alias("tokens"))


@query(f"SELECT row_id, 'indeed_' || row_id AS job_id, CASE WHEN {sql_known('city')} THEN city ELSE 'Chennai' END AS city, CASE WHEN {sql_known('state')} THEN state ELSE 'Tamil Nadu' END AS state FROM jobs WHERE {SITE} = 'indeed'")
def collected_rows(spark, d):
    """Rows of one collector: prefixed ids, blank places filled from what was asked."""
    fill = lambda c, v: F.when(~missing(F.col(c)), F.col(c)).otherwise(v).alias(c)
    return jobs(spark, d).filter(site(F.col("source")) == "indeed").select("row_id", F.concat(F.lit("indeed_"), "row_id").alias("job_id"), fill("city", "Chennai"), fill("state", "Tamil Nadu"))


@query()
def final_status(spark, d):
    """Whether every quality rule holds."""
    return quality.audit(jobs(spark, d)).agg(F.bool_and("passed").alias("passed"), F.count("*").alias("checks"))


ORACLE["final_status"] = f"SELECT bool_and(broken = 0) AS passed, count(*) AS checks FROM ({postings.ORACLE['dq_audit_summary']})"


# SQL of the dashboard and posting queries that rest on rule lists -----------------------------------------------------

def _cases(text: str, rules: list[tuple[str, str]]) -> str:
    return " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{label}'" for label, p in rules)


_BLOB = "lower(concat_ws(' ', skills, full_description))"
_CATEGORY = f"CASE {_cases("lower(coalesce(title, ''))", TITLE_RULES)} {_cases(_BLOB, BODY_RULES)} ELSE 'Other' END"
_REPORTED = ", ".join(f"('{s}', '(^|[^a-z0-9_]){re.escape(s.lower())}($|[^a-z0-9_])')" for s in REPORTED)
_NAMED = f"SELECT j.row_id, {_CATEGORY} AS category, r.skill FROM jobs j JOIN (VALUES {_REPORTED}) r(skill, mark) ON regexp_matches({_BLOB}, r.mark)"
ORACLE["category_distribution"] = f"SELECT category, count(*) AS n, CAST(round(100.0 * count(*) / sum(count(*)) OVER ()) AS INTEGER) AS pct FROM (SELECT {_CATEGORY} AS category FROM jobs) GROUP BY 1"
ORACLE["category_top_skills"] = f"""SELECT category, skill, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, skill) AS r
  FROM (SELECT category, skill, count(*) AS n FROM ({_NAMED}) GROUP BY 1, 2)) WHERE r <= 8"""
ORACLE["skill_tier_rank"] = f"""SELECT skill, n, pct, CASE WHEN i < 3 OR pct >= 45 THEN 'core' WHEN i >= 7 THEN 'differentiator' ELSE 'growth' END AS tier FROM (
  SELECT skill, n, CAST(round(100.0 * n / (SELECT count(*) FROM jobs)) AS INTEGER) AS pct, row_number() OVER (ORDER BY n DESC, skill) - 1 AS i FROM (SELECT skill, count(*) AS n FROM ({_NAMED}) GROUP BY 1)) WHERE i < 10"""
_CODES = ", ".join(f"('{k}', '{v}')" for k, v in STATES.items())
ORACLE["top_hubs"] = f"""WITH m(k, v) AS (VALUES {_CODES}), j AS (SELECT trim(coalesce(city, '')) AS c, trim(coalesce(state, '')) AS s FROM jobs),
  t AS (SELECT c, s, trim(CASE WHEN upper(c) LIKE '%, IN' THEN left(c, length(c) - 4) WHEN upper(c) LIKE '%, INDIA' THEN left(c, length(c) - 7) ELSE c END) AS token FROM j),
  h AS (SELECT t.c, t.s, t.token, a.v AS code, coalesce(b.v, t.s) AS whole FROM t LEFT JOIN m a ON a.k = upper(t.token) LEFT JOIN m b ON b.k = upper(t.s)),
  p AS (SELECT *, concat_ws(', ', CASE WHEN token NOT IN ('', 'Not Specified') THEN token END, CASE WHEN whole NOT IN ('', 'Not Specified', 'India') AND whole <> token THEN whole END) AS pair FROM h)
SELECT hub, count(*) AS n FROM (SELECT CASE WHEN contains(lower(c), 'remote') OR contains(lower(s), 'remote') THEN 'Remote' WHEN regexp_matches(lower(c), 'bengaluru|bangalore') THEN 'Bengaluru, Karnataka'
  WHEN contains(lower(c), 'hyderabad') THEN 'Hyderabad, Telangana' WHEN contains(lower(c), 'pune') THEN 'Pune, Maharashtra' WHEN contains(lower(c), 'mumbai') THEN 'Mumbai, Maharashtra' WHEN contains(lower(c), 'chennai') THEN 'Chennai, Tamil Nadu'
  WHEN contains(lower(c), 'noida') THEN 'Noida, Delhi NCR' WHEN regexp_matches(lower(c), 'gurugram|gurgaon') THEN 'Gurugram, Delhi NCR' WHEN contains(lower(c), 'delhi') THEN 'Delhi NCR' WHEN contains(lower(c), 'kolkata') THEN 'Kolkata, West Bengal'
  WHEN upper(token) IN ('CT', 'CT, INDIA') THEN 'Pan-India (Flexible)' WHEN code = 'India' THEN 'India (Not Specified)' WHEN code IS NOT NULL THEN code WHEN pair <> '' THEN pair ELSE 'India (Not Specified)' END AS hub FROM p)
WHERE hub <> 'India (Not Specified)' GROUP BY 1 ORDER BY n DESC, hub LIMIT 8"""
_F = lambda c: f"TRY_CAST({trim(c)} AS DOUBLE)"
_LO, _HI = "min_experience_years", "max_experience_years"
ORACLE["dq_experience_problems"] = " UNION ALL ".join(f"SELECT row_id, '{text}' AS problem FROM jobs WHERE {rule}" for text, rule in (
    ("minimum is not a number", f"NOT {lost(_LO)} AND {_F(_LO)} IS NULL"), ("maximum is not a number", f"NOT {lost(_HI)} AND {_F(_HI)} IS NULL"),
    ("minimum above 100", f"{_F(_LO)} > 100"), ("maximum above 100", f"{_F(_HI)} > 100"), ("minimum exceeds maximum", f"{_F(_LO)} > {_F(_HI)}"),
))
ORACLE["skills_joined"] = f"""SELECT row_id, CASE WHEN len(s) = 0 OR s IS NULL THEN 'Not Specified' ELSE array_to_string(list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(y)), lower(x)) = i), '; ') END AS skills
  FROM (SELECT row_id, list_filter(list_transform(string_split_regex(skills, '[,;|]'), lambda x: {trim('x')}), lambda x: x <> '') AS s FROM jobs)"""
_MAP = ", ".join(f"('{k}', '{v}')" for k, v in CANONICAL.items())
_IGNORED = ", ".join(f"'{w}'" for w in IGNORED)
_SCOPED = f"""SELECT key, min(skill) AS skill, count(*) AS n FROM (SELECT row_id, lower(skill) AS key, min(skill) AS skill FROM (
  SELECT i.row_id, coalesce(m.v, upper(left(i.item, 1)) || substr(i.item, 2)) AS skill FROM (SELECT row_id, {trim('x')} AS item FROM (SELECT row_id, unnest(string_split_regex(skills, '[,;|/]')) AS x FROM jobs)) i
  LEFT JOIN (VALUES {_MAP}) m(k, v) ON m.k = lower(i.item) WHERE length(i.item) >= 2 AND lower(i.item) NOT IN ({_IGNORED})) GROUP BY 1, 2) GROUP BY 1"""
ORACLE["scope_skills_dedup"] = f"SELECT skill, n, CAST(least(100, round(100.0 * n / (SELECT count(*) FROM jobs))) AS INTEGER) AS pct FROM ({_SCOPED})"
ORACLE["skill_donut_others"] = f"""WITH s AS ({_SCOPED}), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, skill) AS i FROM s)
SELECT skill, n FROM r WHERE i <= 5 UNION ALL SELECT 'Others', CAST(sum(n) AS BIGINT) FROM r WHERE i > 5 HAVING sum(n) > 0"""


# Functions over whole columns -----------------------------------------------------------------------------------------

@query(r"""SELECT row_id, coalesce(nullif(regexp_extract(link, '[?&]jobId=(\d+)', 1), ''), nullif(regexp_extract(link, '/view/(?:[^/?#]*-)?(\d+)', 1), ''), nullif(regexp_extract(link, '-(\d{6,})(?:[/?#]|$)', 1), ''),
  nullif(regexp_extract(link, '[?&]currentJobId=(\d+)', 1), ''), regexp_extract_all(link, '\d{5,}')[-1]) AS ad FROM jobs""")
def ids_from_links(spark, d):
    return jobs(spark, d).select("row_id", id_from_url(F.col("link")).alias("ad"))


_YEARLESS = f"trim(regexp_replace({cleaned('min_experience_years')}, '(?i)\\s*(years?|yrs?)\\b\\.?', '', 'g'))"


@query(rf"SELECT row_id, CASE WHEN regexp_full_match(v, '\d+(\.\d+)?\+?') AND TRY_CAST(replace(v, '+', '') AS DOUBLE) <= 100 THEN v ELSE 'Not Specified' END AS least FROM (SELECT row_id, {_YEARLESS} AS v FROM jobs)")
def clean_experience_field(spark, d):
    return jobs(spark, d).select("row_id", clean_experience(F.col("min_experience_years")).alias("least"))


@query(r"SELECT posting_id, nullif(regexp_extract(url, '(?i)[-/](\d+)-to-(\d+)-years?(?:[-/]|$)', 1), '') AS low, nullif(regexp_extract(url, '(?i)[-/](\d+)-to-(\d+)-years?(?:[-/]|$)', 2), '') AS high FROM raw_postings")
def experience_from_links(spark, d):
    x = url_experience(F.col("url"))
    return table(spark, d, "raw_postings").select("posting_id", x["low"].alias("low"), x["high"].alias("high"))


@query(r"SELECT row_id, skill FROM jobs, (VALUES ('Python', '(?i)\bPython\b'), ('C++', '(?i)\bC\+\+\b'), ('.NET', '(?i)\b\.NET\b'), ('SQL', '(?i)\bSQL\b')) s(skill, mark) WHERE regexp_matches(coalesce(skills, '') || ' ' || coalesce(full_description, ''), mark)")
def skill_word_filter(spark, d):
    """Postings that name a skill between word ends."""
    text = F.concat_ws(" ", F.coalesce("skills", F.lit("")), F.coalesce("full_description", F.lit("")))
    held = F.array_compact(F.array(*[F.when(names_skill(text, s), F.lit(s)) for s in ("Python", "C++", ".NET", "SQL")]))
    return jobs(spark, d).select("row_id", F.explode(held).alias("skill"))


@query("SELECT row_id FROM jobs WHERE skills ILIKE '%spark%' OR title ILIKE '%spark%'")
def skill_or_title_filter(spark, d):
    return jobs(spark, d).filter(any_like("spark", "skills", "title")).select("row_id")


@query(f"SELECT Batch_CSV_File, list_filter(list_transform(string_split(Keywords, ','), lambda x: {trim('x')}), lambda x: x <> '') AS items FROM extraction_history")
def comma_items(spark, d):
    return table(spark, d, "extraction_history").select("Batch_CSV_File", split_list(F.col("Keywords")).alias("items"))


@query(f"SELECT row_id, {lost('min_experience_years')} AS missing, {lost('min_experience_years')} OR TRY_CAST({trim('min_experience_years')} AS DOUBLE) IS NOT NULL AS number FROM jobs")
def missing_and_number(spark, d):
    c = F.col("min_experience_years")
    return jobs(spark, d).select("row_id", missing(c, QUALITY_MISSING).alias("missing"), is_number(c).alias("number"))


@query(f"""SELECT hub, count(*) AS n FROM (SELECT CASE WHEN contains({trim('city')}, ',') THEN split_part({trim('city')}, ',', 1) ELSE {trim('city')} END AS hub FROM jobs WHERE city IS NOT NULL) GROUP BY 1""")
def short_labels(spark, d):
    """Places shortened to what stands before the first comma."""
    return jobs(spark, d).filter("city IS NOT NULL").groupBy(F.substring_index(trimmed(F.col("city")), ",", 1).alias("hub")).agg(F.count("*").alias("n"))


@query(f"""SELECT count(*) FILTER (WHERE r) AS by_rule, count(*) FILTER (WHERE NOT r AND c >= 0.6) AS by_model, count(*) FILTER (WHERE NOT r AND c < 0.6) AS low, round(avg(c), 9) AS mean_confidence, min(c) AS least, max(c) AS most
  FROM (SELECT {sql_known('degree_required')} AS r, (row_id % 101) / 100.0 AS c FROM jobs)""")
def prediction_mix_share(spark, d):
    """What a rule decides, what a model decides surely, and the rest."""
    rows = jobs(spark, d).select((~missing(F.col("degree_required"))).alias("r"), ((F.col("row_id") % 101) / 100.0).alias("c"))
    mix = ml.prediction_mix(rows, "r", "c")
    return mix.withColumn("mean_confidence", F.round("mean_confidence", 9))


@query(f"SELECT archive_id, lower({trim('source')}) IN ('1', 'true', 'yes', 'y', 'on') AS flag, TRY_CAST({trim('min_experience_years')} AS INTEGER) AS whole FROM (SELECT archive_id, CASE archive_id % 5 WHEN 0 THEN ' Yes' WHEN 1 THEN 'OFF' WHEN 2 THEN '1' WHEN 3 THEN 'no ' ELSE 'true' END AS source, min_experience_years FROM batch_archive)")
def flags_and_whole_numbers(spark, d):
    text = F.element_at(F.array(*map(F.lit, (" Yes", "OFF", "1", "no ", "true"))), (F.col("archive_id") % 5 + 1).cast("int"))
    n = trimmed(F.col("min_experience_years"))
    return table(spark, d, "batch_archive").select("archive_id", parse_bool(text).alias("flag"), F.when(n.rlike(r"^[-+]?\d+(?:\.\d*)?$"), F.round(n.try_cast("double"))).cast("int").alias("whole"))


# SQL over the skill catalogue -----------------------------------------------------------------------------------------

_NAMES = ", ".join(
    f"({i}, {k}, '{category}', '{skill}', '{name}', '(^|[^a-z0-9_]){re.escape(name)}($|[^a-z0-9_])')"
    for i, (category, skill, names) in enumerate((c, s, n) for c, skills in CATALOG.items() for s, n in skills.items()) for k, name in enumerate(names)
)


def _catalogued(text: str) -> str:
    """(row_id, i, category, skill, evidence): the first name found of each skill of the catalogue."""
    return f"SELECT row_id, i, category, skill, arg_min(name, k) AS evidence FROM (SELECT row_id, lower({text}) AS low FROM jobs) JOIN (VALUES {_NAMES}) n(i, k, category, skill, name, mark) ON regexp_matches(low, mark) GROUP BY ALL"


ORACLE["skill_evidence"] = f"SELECT row_id, category, skill, evidence FROM ({_catalogued('skills')})"
ORACLE["skill_extract_catalog"] = f"""SELECT j.row_id, coalesce(s.skills, 'Not Specified') AS skills FROM jobs j LEFT JOIN
  (SELECT row_id, string_agg(skill, ', ' ORDER BY i) AS skills FROM ({_catalogued('full_description')}) GROUP BY 1) s USING (row_id)"""
ORACLE["skills_after_label"] = r"""SELECT row_id, s AS skills FROM (SELECT row_id, trim(regexp_extract(full_description, '(?is)\b(?:key\s+|required\s+|technical\s+)?skills?\s*:\s*(.+?)(?:\n|\.\s+(?-i:[A-Z])|$)', 1), ' ') AS s FROM jobs) WHERE s <> ''"""
