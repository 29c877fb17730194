"""Aggregates over postings: overview, market, experience, skills, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postgrove.functions.category import job_category
from postgrove.functions.education import classify_education
from postgrove.functions.experience import career_tier, experience_number
from postgrove.functions.location import MAP_STATES, indian_hub, map_state
from postgrove.functions.skills import canonical_skill, countable, reported_skills, skill_items
from postgrove.functions.source import site
from postgrove.functions.timeparse import parse_instant
from postgrove.operators.search import missing_to_other, specified, top
from postgrove.contract import trimmed
from postgrove.plans.sqltext import SITE, instant, number, specified as sql_specified, trim
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


@query("SELECT count(*) AS total FROM jobs")
def total_jobs(spark, d):
    return jobs(spark, d).agg(F.count("*").alias("total"))


@query(f"""SELECT CASE WHEN state IS NULL OR {trim('state')} = '' THEN 'Other' ELSE {trim('state')} END AS state, {trim('city')} AS city, count(*) AS n FROM jobs
  WHERE {sql_specified('city')} GROUP BY 1, 2 ORDER BY n DESC, state, city LIMIT 100""")
def dashboard_stats_location(spark, d):
    return top(jobs(spark, d), [missing_to_other(F.col("state")).alias("state"), trimmed(F.col("city")).alias("city")], 100, specified(F.col("city")))


@query(f"""SELECT skill, count(*) AS n FROM (SELECT {trim("i")} AS skill FROM (SELECT unnest(string_split(skills, ',')) AS i FROM jobs)) WHERE length(skill) > 1 AND lower(skill) <> 'not specified'
  GROUP BY 1 ORDER BY n DESC, skill LIMIT 40""")
def dashboard_stats_skills(spark, d):
    items = jobs(spark, d).select(F.explode(F.split("skills", ",")).alias("skill")).select(trimmed(F.col("skill")).alias("skill"))
    return top(items, [F.col("skill")], 40, (F.length("skill") > 1) & (F.lower("skill") != "not specified"))


@query(f"SELECT CAST({instant('collected_at')} AS DATE) AS day, count(*) AS n FROM jobs WHERE {instant('collected_at')} IS NOT NULL GROUP BY 1 ORDER BY day DESC LIMIT 30")
def dashboard_stats_trend(spark, d):
    days = jobs(spark, d).select(F.to_date(parse_instant(F.col("collected_at"))).alias("day")).filter("day IS NOT NULL")
    return days.groupBy("day").agg(F.count("*").alias("n")).orderBy(F.desc("day")).limit(30)


@query("SELECT count(*) AS total, to_json(list({'source': source, 'n': n} ORDER BY source)) AS sources FROM (SELECT coalesce(source, '?') AS source, count(*) AS n FROM jobs GROUP BY 1)".replace("count(*) AS total", "CAST(sum(n) AS BIGINT) AS total"))
def dashboard_stats_row(spark, d):
    """One nested row, an empty list and never null where nothing is counted."""
    by = jobs(spark, d).groupBy(F.coalesce("source", F.lit("?")).alias("source")).agg(F.count("*").alias("n"))
    return by.agg(F.sum("n").alias("total"), F.to_json(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("sources"))


@query(f"SELECT coalesce({SITE}, 'unknown') AS site, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM jobs GROUP BY 1")
def platform_distribution(spark, d):
    by = jobs(spark, d).groupBy(F.coalesce(site(F.col("source")), F.lit("unknown")).alias("site")).agg(F.count("*").alias("n"))
    return by.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))  # over a few sites


@query(f"SELECT {trim('company')} AS company, count(*) AS n FROM jobs WHERE {sql_specified('company')} GROUP BY 1 ORDER BY n DESC, company LIMIT 10")
def top_companies(spark, d):
    return top(jobs(spark, d), [trimmed(F.col("company")).alias("company")], 10, specified(F.col("company")))


@query()
def top_hubs(spark, d):
    hub = jobs(spark, d).select(indian_hub(F.col("city"), F.col("state")).alias("hub"))
    return top(hub, [F.col("hub")], 8, F.col("hub") != "India (Not Specified)")


_HUB = """CASE WHEN lower(coalesce(trim(city), '')) LIKE '%remote%' OR lower(coalesce(state, '')) LIKE '%remote%' THEN 'Remote'
  WHEN regexp_matches(lower(city), 'bengaluru|bangalore') THEN 'Bengaluru, Karnataka' WHEN lower(city) LIKE '%hyderabad%' THEN 'Hyderabad, Telangana' WHEN lower(city) LIKE '%pune%' THEN 'Pune, Maharashtra'
  WHEN lower(city) LIKE '%mumbai%' THEN 'Mumbai, Maharashtra' WHEN lower(city) LIKE '%chennai%' THEN 'Chennai, Tamil Nadu' WHEN lower(city) LIKE '%noida%' THEN 'Noida, Delhi NCR'
  WHEN regexp_matches(lower(city), 'gurugram|gurgaon') THEN 'Gurugram, Delhi NCR' WHEN lower(city) LIKE '%delhi%' THEN 'Delhi NCR' WHEN lower(city) LIKE '%kolkata%' THEN 'Kolkata, West Bengal' ELSE 'elsewhere' END"""


@query(f"SELECT {_HUB} AS hub, count(*) AS n FROM jobs GROUP BY 1")
def metro_hubs(spark, d):
    named = indian_hub(F.col("city"), F.col("state"))
    metro = ["Remote", "Bengaluru, Karnataka", "Hyderabad, Telangana", "Pune, Maharashtra", "Mumbai, Maharashtra", "Chennai, Tamil Nadu", "Noida, Delhi NCR", "Gurugram, Delhi NCR", "Delhi NCR", "Kolkata, West Bengal"]
    by_name = F.lower(F.coalesce("city", F.lit(""))).rlike("bengaluru|bangalore|hyderabad|pune|mumbai|chennai|noida|gurugram|gurgaon|delhi|kolkata|remote") | F.lower(F.coalesce("state", F.lit(""))).contains("remote")
    return jobs(spark, d).groupBy(F.when(by_name & named.isin(metro), named).otherwise("elsewhere").alias("hub")).agg(F.count("*").alias("n"))


@query()
def edu_cluster_pivot(spark, d):
    c = jobs(spark, d).select(F.coalesce(site(F.col("source")), F.lit("unknown")).alias("site"), classify_education(F.col("degree_required"))["cluster"].alias("cluster"))
    bucket = F.when(F.col("cluster").contains("Doctorate"), "doctorate").when(F.col("cluster").contains("Postgraduate"), "postgraduate").when(F.col("cluster").contains("Undergraduate"), "undergraduate").otherwise("open")
    return c.groupBy("site").agg(*[F.count_if(bucket == b).alias(b) for b in ("doctorate", "postgraduate", "undergraduate", "open")])


@query()
def edu_tracks(spark, d):
    c = jobs(spark, d).select(classify_education(F.col("degree_required"))["sub"].alias("track"))
    return c.groupBy(F.substring_index("track", " (", 1).alias("track")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "track")


@query()
def degree_counts(spark, d):
    items = jobs(spark, d).select(F.explode(classify_education(F.col("degree_required"))["degrees"]).alias("degree"))
    return top(items, [F.col("degree")], 6)


def _tier_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'Not Specified' WHEN {x} <= 2 THEN 'Freshers / Entry-Level (0-2 Yrs)' WHEN {x} <= 5 THEN 'Early-Career (2-5 Yrs)' WHEN {x} <= 8 THEN 'Mid-Level (5-8 Yrs)' ELSE 'Senior / Lead (8+ Yrs)' END"


_NUM = f"SELECT row_id, skills, {number('min_experience_years')} AS lo, {number('max_experience_years')} AS hi FROM jobs"


def _years(spark, d):
    return jobs(spark, d).select("row_id", "skills", experience_number(F.col("min_experience_years")).alias("lo"), experience_number(F.col("max_experience_years")).alias("hi"))


@query(f"SELECT {_tier_sql('coalesce(lo, hi)')} AS tier, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM ({_NUM}) GROUP BY 1")
def career_tier_share(spark, d):
    by = _years(spark, d).groupBy(career_tier(F.col("lo"), F.col("hi")).alias("tier")).agg(F.count("*").alias("n"))
    return by.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))  # five tiers


@query(f"""WITH x AS ({_NUM}), m AS (SELECT lo, count(*) AS c FROM x WHERE lo IS NOT NULL GROUP BY 1 ORDER BY c DESC, lo LIMIT 1)
  SELECT round(avg(lo), 6) AS mean, quantile_cont(lo, 0.5) AS median, (SELECT lo FROM m) AS mode FROM x""")
def exp_stats(spark, d):
    return _years(spark, d).agg(F.round(F.avg("lo"), 6).alias("mean"), F.percentile("lo", F.lit(0.5)).alias("median"), F.mode("lo", True).alias("mode"))


@query(f"""WITH b AS (SELECT CAST(least(15, floor(lo)) AS BIGINT) AS years, count(*) AS c FROM ({_NUM}) WHERE lo IS NOT NULL GROUP BY 1)
  SELECT CAST(r.range AS BIGINT) AS years, coalesce(c, 0) AS n FROM range(16) r LEFT JOIN b ON b.years = r.range""")
def exp_histogram(spark, d):
    by = _years(spark, d).filter("lo IS NOT NULL").groupBy(F.least(F.lit(15), F.floor("lo")).cast("bigint").alias("years")).agg(F.count("*").alias("c"))
    return spark.range(16).withColumnRenamed("id", "years").join(F.broadcast(by), "years", "left").select("years", F.coalesce("c", F.lit(0)).alias("n"))  # 16 rows


@query(f"""WITH b AS (SELECT CASE WHEN x <= 1 THEN 0 WHEN x <= 3 THEN 1 WHEN x <= 5 THEN 2 WHEN x <= 8 THEN 3 WHEN x <= 12 THEN 4 ELSE 5 END AS k, count(*) AS c FROM (SELECT coalesce(lo, 2) AS x FROM ({_NUM})) GROUP BY 1)
  SELECT CAST(r.range AS BIGINT) AS bracket, coalesce(c, 0) AS n FROM range(6) r LEFT JOIN b ON b.k = r.range""")
def exp_curve(spark, d):
    x = F.coalesce("lo", F.lit(2.0))
    k = F.when(x <= 1, 0).when(x <= 3, 1).when(x <= 5, 2).when(x <= 8, 3).when(x <= 12, 4).otherwise(5).cast("bigint")
    by = _years(spark, d).groupBy(k.alias("bracket")).agg(F.count("*").alias("c"))
    return spark.range(6).withColumnRenamed("id", "bracket").join(F.broadcast(by), "bracket", "left").select("bracket", F.coalesce("c", F.lit(0)).alias("n"))  # 6 rows


@query(f"""SELECT count(*) FILTER (WHERE coalesce(lo, 2) <= 1) AS entry, count(*) FILTER (WHERE coalesce(lo, 2) > 1 AND coalesce(lo, 2) <= 5) AS mid, count(*) FILTER (WHERE coalesce(lo, 2) > 5) AS senior FROM ({_NUM})""")
def exp_split(spark, d):
    x = F.coalesce("lo", F.lit(2.0))
    return _years(spark, d).agg(F.count_if(x <= 1).alias("entry"), F.count_if((x > 1) & (x <= 5)).alias("mid"), F.count_if(x > 5).alias("senior"))


@query(rf"""WITH s AS (SELECT tier, {trim('i')} AS skill FROM (SELECT {_tier_sql('coalesce(lo, hi)')} AS tier, unnest(string_split_regex(skills, '[,|;]')) AS i FROM ({_NUM}))),
  c AS (SELECT tier, skill, count(*) AS n FROM s WHERE length(skill) > 1 AND lower(skill) <> 'not specified' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY n DESC, skill) AS rank FROM c)
  SELECT tier, skill, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 15""")
def tier_skills(spark, d):
    s = _years(spark, d).select(career_tier(F.col("lo"), F.col("hi")).alias("tier"), F.explode(skill_items(F.col("skills"))).alias("skill"))
    c = s.filter((F.length("skill") > 1) & (F.lower("skill") != "not specified")).groupBy("tier", "skill").agg(F.count("*").alias("n"))
    # Counts are one row for each tier and skill; the window ranks those.
    return c.withColumn("rank", F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("n"), "skill"))).filter("rank <= 15")


def _scope_skills(spark, d) -> DataFrame:
    items = jobs(spark, d).select("row_id", F.explode(skill_items(F.col("skills"), r"[,;|/]")).alias("item")).filter(countable(F.col("item")))
    one = items.select("row_id", F.lower(canonical_skill(F.col("item"))).alias("key"), canonical_skill(F.col("item")).alias("skill")).groupBy("row_id", "key").agg(F.min("skill").alias("skill"))
    return one.groupBy("key").agg(F.min("skill").alias("skill"), F.count("*").alias("n"))


@query()
def scope_skills_dedup(spark, d):
    total = jobs(spark, d).agg(F.count("*").alias("t"))
    return _scope_skills(spark, d).join(F.broadcast(total)).select("skill", "n", F.least(F.lit(100), F.round(100 * F.col("n") / F.col("t"))).cast("int").alias("pct"))  # one row broadcast


@query()
def skill_donut_others(spark, d):
    """The five commonest and the rest as one, if there are more than five."""
    s = _scope_skills(spark, d)
    five = s.orderBy(F.desc("n"), "skill").limit(5)
    rest = s.join(five.select("key"), "key", "left_anti").agg(F.sum("n").alias("n")).filter("n > 0").select(F.lit("Others").alias("skill"), "n")
    return five.select("skill", "n").unionByName(rest)


@query()
def category_distribution(spark, d):
    c = spread(jobs(spark, d), "row_id").groupBy(job_category(F.col("title"), F.col("skills"), F.col("full_description")).alias("category")).agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy())).cast("int")).orderBy(F.desc("n"), "category")  # seven rows


@query()
def skill_tier_rank(spark, d):
    """The ten commonest reported skills, in skills or description, with a label by rank or share."""
    rows = spread(jobs(spark, d), "row_id").select(F.explode(reported_skills(F.col("skills"), F.col("full_description"))).alias("skill"))
    total = jobs(spark, d).agg(F.count("*").alias("t"))
    ten = rows.groupBy("skill").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skill").limit(10).join(F.broadcast(total))
    ranked = ten.withColumn("i", F.row_number().over(Window.orderBy(F.desc("n"), "skill")) - 1).withColumn("pct", F.round(100 * F.col("n") / F.col("t")).cast("int"))  # ten rows
    return ranked.select("skill", "n", "pct", F.when((F.col("i") < 3) | (F.col("pct") >= 45), "core").when(F.col("i") >= 7, "differentiator").otherwise("growth").alias("tier"))


@query(f"""SELECT category, skill, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, skill) AS r FROM (
  SELECT category, {trim('i')} AS skill, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(lower(coalesce(title, '')), '(^|[^a-z0-9_])(qa([^a-z0-9_]|$)|tester|test\\s+engineer|sdet)') THEN 'QA' WHEN regexp_matches(lower(coalesce(title, '')), '(^|[^a-z0-9_])(data\\s+engineer)') THEN 'DE' ELSE 'rest' END AS category,
    unnest(string_split(skills, ',')) AS i FROM jobs) GROUP BY 1, 2) WHERE length(skill) > 1 AND lower(skill) <> 'not specified') WHERE r <= 8""")
def category_top_skills(spark, d):
    """The eight commonest reported skills of each category, from skills and description alike."""
    s = spread(jobs(spark, d), "row_id").select(
        job_category(F.col("title"), F.col("skills"), F.col("full_description")).alias("category"), F.explode(reported_skills(F.col("skills"), F.col("full_description"))).alias("skill")
    )
    n = s.groupBy("category", "skill").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n"), "skill"))).filter("rank <= 8")


@query("SELECT max(ts) AS latest, count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-15') AS today, round(100.0 * count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-15') / count(*), 1) AS pct FROM events")
def latest_and_today(spark, d):
    e = table(spark, d, "events")
    today = F.to_date("ts") == F.lit("2024-01-15").cast("date")
    return e.agg(F.max("ts").alias("latest"), F.count_if(today).alias("today"), F.round(100.0 * F.count_if(today) / F.count("*"), 1).alias("pct"))


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, count(*) AS n, arg_min(event_type, struct_pack(a := ts, b := event_id)) AS first_type, min(ts) AS first_ts,
  greatest(1, CAST(round(0.2 * count(*)) AS BIGINT)) AS share FROM events GROUP BY 1""")
def run_history_hourly(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH").alias("hour")).agg(
        F.count("*").alias("n"), F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.min("ts").alias("first_ts"), F.greatest(F.lit(1), F.round(0.2 * F.count("*")).cast("bigint")).alias("share")
    )


@query("""SELECT Batch_CSV_File, CAST(Extraction_Time_UTC AS TIMESTAMP) AS at_utc, round((epoch(CAST(Extraction_Time_UTC AS TIMESTAMP)) - epoch(lag(CAST(Extraction_Time_UTC AS TIMESTAMP)) OVER (ORDER BY Extraction_Time_UTC, Batch_CSV_File))) / 3600.0, 4) AS gap_hours FROM extraction_history""".replace("CAST(Extraction_Time_UTC AS TIMESTAMP)", "CAST(substr(Extraction_Time_UTC, 1, 19) AS TIMESTAMP)"))
def run_gap_hours(spark, d):
    h = table(spark, d, "extraction_history").select("Batch_CSV_File", F.to_timestamp_ntz(F.substring("Extraction_Time_UTC", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("at_utc"))
    w = Window.orderBy("at_utc", "Batch_CSV_File")  # one row a batch run
    gap = (F.unix_timestamp(F.col("at_utc").cast("timestamp")) - F.unix_timestamp(F.lag("at_utc").over(w).cast("timestamp"))) / 3600.0
    return h.withColumn("gap_hours", F.round(gap, 4))


@query("""WITH n AS (SELECT city AS node, state FROM city_ref) SELECT n.node, n.state, count(j.row_id) AS n FROM n LEFT JOIN jobs j ON lower(j.city) = lower(n.node) OR contains(lower(j.city), lower(n.node)) GROUP BY 1, 2""")
def node_contains_counts(spark, d):
    """Theta join with every place as a node: the names become one array beside each distinct city, no row is paired with all."""
    nodes = table(spark, d, "city_ref").select(F.col("city").alias("node"), "state")
    names = sorted({r.node.lower() for r in nodes.collect()})  # 128 rows, fixed; namesakes are one name
    cities = jobs(spark, d).groupBy(F.lower("city").alias("city")).agg(F.count("*").alias("rows"))
    hit = F.array_compact(F.array(*[F.when(F.col("city").contains(n), F.lit(n)) for n in names]))
    counts = cities.select(F.explode(hit).alias("name"), "rows").groupBy("name").agg(F.sum("rows").alias("c"))
    return nodes.join(counts, F.lower("node") == F.col("name"), "left").select("node", "state", F.coalesce("c", F.lit(0)).alias("n"))


_MAP_STATES = ", ".join(f"('{k}', '{v}')" for k, v in [*MAP_STATES.items(), *{v.lower(): v for v in MAP_STATES.values()}.items()])


@query(f"""WITH j AS (SELECT row_id, lower({trim('city')}) AS c, lower({trim('state')}) AS s FROM jobs), m(k, name) AS (VALUES {_MAP_STATES}),
  texts AS (SELECT c, (SELECT arg_min(r.state, r.city_id) FROM city_ref r WHERE contains(t.c, lower(r.city))) AS held FROM (SELECT DISTINCT c FROM j) t)
SELECT j.row_id, coalesce(e.state, m.name, t.held, p.state) AS place_state FROM j LEFT JOIN (SELECT lower(city) AS c, min(state) AS state FROM city_ref GROUP BY 1) e ON j.c = e.c
  LEFT JOIN m ON j.s = m.k LEFT JOIN texts t ON j.c = t.c LEFT JOIN (SELECT DISTINCT state FROM city_ref) p ON j.c = lower(p.state)""")
def state_priority_lookup(spark, d):
    """A row's state: exact city first, else the state column as a name or id, else the first place contained in the city text, else the city text is itself a state."""
    ref = table(spark, d, "city_ref")
    exact = ref.groupBy(F.lower("city").alias("c")).agg(F.min("state").alias("s1"))
    states = ref.select(F.lower("state").alias("c"), F.col("state").alias("s4")).distinct()
    places = ref.orderBy("city_id").select(F.lower("city").alias("c"), "state").collect()  # 128 fixed places, the first contained one wins
    rows = jobs(spark, d).select("row_id", F.lower(trimmed(F.col("city"))).alias("c"), map_state(F.col("state")).alias("s2"))
    contained = F.coalesce(*[F.when(F.col("c").contains(r.c), F.lit(r.state)) for r in places])
    found = rows.join(F.broadcast(exact), "c", "left").join(F.broadcast(states), "c", "left")
    return found.select("row_id", F.coalesce("s1", "s2", contained, "s4").alias("place_state"))


@query("""SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS customers, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def distinct_counts(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count_distinct("o_custkey").alias("customers"), F.round(F.sum(F.col("o_totalprice").cast("decimal(20,4)")), 2).cast("double").alias("total"))


@query("""SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct, count(*) < 20 AS rare FROM (SELECT coalesce(lang, 'none') AS label FROM documents) GROUP BY 1""")
def label_distribution(spark, d):
    by = table(spark, d, "documents").groupBy(F.coalesce("lang", F.lit("none")).alias("label")).agg(F.count("*").alias("n"))
    return by.select("label", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("pct"), (F.col("n") < 20).alias("rare"))  # a few labels


@query("""SELECT extracted_at_utc, count(*) AS rows_in_batch, CAST(count(*) FILTER (WHERE source IS NULL) AS BIGINT) AS without_source FROM batch_archive GROUP BY 1""")
def batch_counts(spark, d):
    return table(spark, d, "batch_archive").groupBy("extracted_at_utc").agg(F.count("*").alias("rows_in_batch"), F.count_if(F.col("source").isNull()).alias("without_source"))


@query("""SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def embed_left_join(spark, d):
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").select("o_orderkey", "c_name", "n_name")
