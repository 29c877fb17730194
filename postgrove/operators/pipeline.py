"""The batch pipeline: adapt, normalise, split rejects, filter, enrich, deduplicate, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.contract import CSV_FIELDS, ENRICH_MISSING, NOT_SPECIFIED, missing, ns, trimmed
from postgrove.functions.experience import experience_range
from postgrove.functions.education import degree_list, normalize_education
from postgrove.functions.location import repair_fields, split_location
from postgrove.functions.skills import extract_skills
from postgrove.functions.source import site
from postgrove.functions.text import clean, fallback_job_id, first_value, joined_skills, strip_html
from postgrove.session import shared_dir

#: The names each field goes by in raw postings, first non-blank wins.
ALIASES = {
    "title": ["title", "job_title", "position"], "company": ["company", "company_name", "employer"], "location": ["location", "Location", "job_location"],
    "link": ["link", "url", "job_url"], "full_description": ["full_description", "job_description", "description", "job_description_summary"],
    "skills": ["skills", "skill", "key_skills"], "degree_required": ["degree_required", "education", "qualification", "qualifications_education_required"],
    "posted_date": ["posted_date", "date_posted", "posted_time", "collected_at"],
}


def adapt(raw: DataFrame) -> DataFrame:
    """Alias columns become the named fields; other columns stay."""
    named = {f: first_value(*[F.col(f"`{a}`") for a in names if a in raw.columns]) if any(a in raw.columns for a in names) else F.lit(None).cast("string") for f, names in ALIASES.items()}
    return raw.withColumns(named)


def reject_reason(link: Column, title: Column) -> Column:
    return F.when(F.length(F.coalesce(clean(link), F.lit(""))) == 0, "blank link").when(F.length(F.coalesce(clean(title), F.lit(""))) == 0, "blank title")


def normalize(raw: DataFrame, source: str, collected_at: str) -> tuple[DataFrame, DataFrame]:
    """(postings in the contract's columns, rejected rows with their reason)."""
    rows = adapt(raw).withColumn("reason", reject_reason(F.col("link"), F.col("title")))
    good = rows.filter("reason IS NULL")
    place = split_location(F.col("location"))
    years = experience_range(F.col("link"), F.col("full_description"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("experience") if "experience" in raw.columns else F.lit(None).cast("string"))
    out = good.withColumn("__p", place).withColumn("__y", years).select(
        fallback_job_id(F.lit(source.lower()), F.lit(source), F.col("link"), F.col("title"), F.col("company"), F.col("location")).alias("job_id"),
        F.lit(source).alias("source"), ns(F.col("title")).alias("title"), ns(F.col("company")).alias("company"), F.col("__p.city").alias("city"), F.col("__p.state").alias("state"),
        F.col("__p.country").alias("country"), F.col("__y.low").alias("min_experience_years"), F.col("__y.high").alias("max_experience_years"), joined_skills(F.col("skills")).alias("skills"),
        normalize_education(F.col("degree_required")).alias("degree_required"), F.lit(NOT_SPECIFIED).alias("specialization_required"), F.lit(collected_at).alias("collected_at"),
        F.col("link"), ns(strip_html(F.col("full_description"))).alias("full_description"),
    )
    return out.select(*CSV_FIELDS), rows.filter("reason IS NOT NULL")


def repaired_places(df: DataFrame) -> DataFrame:
    return df.withColumn("__p", repair_fields(F.col("city"), F.col("state"), F.col("country"))).withColumns({c: F.col(f"__p.{c}") for c in ("city", "state", "country")}).drop("__p")


def enrich(df: DataFrame) -> DataFrame:
    """Unset skills and degrees are filled from the description; set values are never overwritten."""
    unset = lambda c: missing(F.col(c), ENRICH_MISSING)
    degrees = F.nullif(F.array_join(degree_list(F.col("full_description")), " / "), F.lit(""))
    return df.withColumns({
        "skills": F.when(unset("skills"), extract_skills(F.col("full_description"))).otherwise(F.col("skills")),
        "degree_required": F.when(unset("degree_required"), F.coalesce(degrees, F.lit(NOT_SPECIFIED))).otherwise(F.col("degree_required")),
    })


def first_occurrence(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in a total order; combined before the shuffle, nothing is sorted."""
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)]).agg(best.alias("__row")).select("__row.*")


def losers(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """All rows but the first of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter("__r > 1").drop("__r")


def fresh(batch: DataFrame, seen: DataFrame, key: str = "job_id") -> DataFrame:
    """The batch without what has been seen."""
    return batch.join(seen.select(key).distinct(), key, "left_anti")


def mirror(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, action) of a full mirror: insert, update, delete, keep; rows compare on all shared columns."""
    shared = [c for c in old.columns if c in new.columns and c != key]
    digest = lambda df, name: df.select(key, F.xxhash64(*[F.col(c) for c in shared]).alias(name))
    both = digest(old, "__a").join(digest(new, "__b"), key, "full")
    return both.select(key, F.when(F.col("__a").isNull(), "insert").when(F.col("__b").isNull(), "delete").when(F.col("__a") != F.col("__b"), "update").otherwise("keep").alias("action"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows and the old ones they do not replace."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def fill_unset(rows: DataFrame, detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Detail values where the row's own is unset."""
    d = detail.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = rows.join(d, key, "left")
    return out.withColumns({c: F.when(missing(F.col(c), ENRICH_MISSING), F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c)) for c in columns}).drop(*[f"__{c}" for c in columns])


def overwrite_specified(card: DataFrame, detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Detail values that are specified win over the card's."""
    d = detail.select(key, *[F.when(~missing(F.col(c)), F.col(c)).alias(f"__{c}") for c in columns])
    out = card.join(d, key, "left")
    return out.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}).drop(*[f"__{c}" for c in columns])


def run_report(collected: DataFrame, source: str, valid: Column) -> DataFrame:
    """Counters for each source."""
    return collected.groupBy(source).agg(F.count("*").alias("collected"), F.count_if(valid).alias("normalized"), F.count_if(~valid).alias("skipped_invalid"))


def by_site(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce(site(F.col("source")), F.lit("unknown")).alias("site")).agg(F.count("*").alias("n"))


#: Asked places that leave every row in.
ANYWHERE = ["", "india", "all india", "remote", "any", "not specified"]


def located(df: DataFrame, place: str, states: dict[str, str]) -> DataFrame:
    """The rows of an asked place, by city, link or description; their city becomes the asked one, an unset state and country are filled.

    A place that is none (``ANYWHERE``) leaves the rows as they are.
    """
    p = place.strip().lower()
    if p in ANYWHERE:
        return df
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    text = low("full_description")
    told = F.lit(False)
    for mark in (f"location :{p}", f"location: {p}", f"in {p}"):
        told = told | text.contains(mark)
    hit = low("city").contains(p) | low("link").contains(p) | told | F.left(text, F.lit(400)).contains(p)
    unset = lambda c: trimmed(F.coalesce(F.col(c), F.lit(""))).isin("", NOT_SPECIFIED)
    state = next((s for c, s in states.items() if c.lower() == p), None)
    out = df.filter(hit).withColumn("city", F.lit(place.strip().title()))
    if state:
        out = out.withColumn("state", F.when(unset("state"), state).otherwise(F.col("state")))
    return out.withColumn("country", F.when(unset("country"), "India").otherwise(F.col("country")))


def append_row(held: DataFrame, row: dict, name: str) -> DataFrame:
    """A table in the shared folder with one more row, appended as a file of its own, read back."""
    spark = held.sparkSession
    at = f"{shared_dir(spark)}/{name}"
    held.write.mode("append").parquet(at)
    spark.createDataFrame([tuple(row.get(f.name) for f in held.schema)], held.schema).write.mode("append").parquet(at)
    return spark.read.schema(held.schema).parquet(at)
