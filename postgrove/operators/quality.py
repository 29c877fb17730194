"""Data quality: one pass of rule counts, problem rows, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postgrove.contract import CSV_FIELDS, QUALITY_MISSING, missing
from postgrove.functions.experience import experience_problems
from postgrove.functions.location import polluted_city, polluted_country, polluted_education, polluted_state
from postgrove.functions.source import site

#: Fields every posting must have.
REQUIRED = ["job_id", "source", "title", "company", "link"]


def rules() -> dict[str, Column]:
    """Name -> whether a row breaks the rule."""
    broken = {f"missing_{f}": missing(F.col(f), QUALITY_MISSING) for f in REQUIRED}
    return broken | {
        "unknown_source": site(F.col("source")).isNull(),
        "polluted_city": polluted_city(F.col("city")), "polluted_state": polluted_state(F.col("state")), "polluted_country": polluted_country(F.col("country")),
        "polluted_education": polluted_education(F.col("degree_required")),
        "bad_experience": F.size(experience_problems(F.col("min_experience_years"), F.col("max_experience_years"))) > 0,
        "bad_link": ~missing(F.col("link"), QUALITY_MISSING) & ~F.col("link").rlike(r"^https?://"),
    }


def audit(df: DataFrame) -> DataFrame:
    """(check, broken, passed): every rule in one pass over the rows."""
    checks = rules()
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("broken")) for n in checks])).alias("r")).select("r.check", "r.broken", (F.col("r.broken") == 0).alias("passed"))


def problems(df: DataFrame, key: str) -> DataFrame:
    """(key, problem): one row for each broken rule of each row."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules().items()]))
    return df.select(F.col(key), F.explode(names).alias("problem"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, keys): distinct keys only in a, only in b, in both."""
    x = a.select(key).distinct().withColumn("__a", F.lit(1))
    y = b.select(key).distinct().withColumn("__b", F.lit(1))
    side = F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b").otherwise("both")
    return x.join(y, key, "full").groupBy(side.alias("side")).agg(F.count("*").alias("keys"))


def schema_difference(columns: list[str], contract: list[str] = CSV_FIELDS) -> tuple[list[str], list[str]]:
    """(missing, extra) columns."""
    return [c for c in contract if c not in columns], [c for c in columns if c not in contract]
