"""Search over postings: filters composed as Columns, pages, freshness with fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postgrove.contract import NOT_SPECIFIED, trimmed

#: Page bounds.
PAGE_LEAST, PAGE_MOST, PAGE_USUAL = 10, 100, 25
#: The hub cities of a state, for the state filter.
STATE_HUBS = {
    "tamil nadu": ["chennai", "coimbatore", "madurai", "tiruchirappalli", "salem"], "karnataka": ["bengaluru", "bangalore", "mysuru", "mysore", "hubli", "mangalore"],
    "maharashtra": ["mumbai", "pune", "nagpur", "nashik", "aurangabad", "thane"], "telangana": ["hyderabad", "secunderabad", "warangal"],
    "delhi": ["delhi", "new delhi", "noida", "gurgaon", "gurugram"], "west bengal": ["kolkata", "calcutta", "howrah", "durgapur", "siliguri"],
    "gujarat": ["ahmedabad", "gandhinagar", "surat", "vadodara", "rajkot"], "kerala": ["kochi", "cochin", "thiruvananthapuram", "trivandrum", "kozhikode", "calicut"],
    "rajasthan": ["jaipur", "udaipur", "jodhpur"], "uttar pradesh": ["noida", "lucknow", "kanpur", "agra"], "chandigarh": ["chandigarh", "mohali", "panchkula"],
}


def any_like(text: str, *columns: str) -> Column:
    """``ILIKE %text%`` over the columns; the text's own wildcards count."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c).ilike(f"%{text}%"), F.lit(False))
    return out


def in_blob(text: str, *columns: str) -> Column:
    """Containment in the columns joined by blanks; may match across a border."""
    return F.contains(F.lower(F.concat_ws(" ", *[F.col(c) for c in columns])), F.lit(text.lower()))


def in_state(state: str, state_column: str = "state", city_column: str = "city") -> Column:
    """The state is named, or the city is one of its hubs."""
    out = F.coalesce(F.col(state_column).ilike(f"%{state.strip()}%"), F.lit(False))
    for hub in STATE_HUBS.get(state.strip().lower(), []):
        out = out | F.coalesce(F.col(city_column).ilike(f"%{hub}%"), F.lit(False))
    return out


def text_experience_bucket(c: Column) -> Column:
    """Buckets by comparing texts, so ``10`` is early and the placeholder senior."""
    return F.when(c <= "1", "freshers").when((c >= "1") & (c <= "3"), "early").when((c >= "3") & (c <= "5"), "mid").when(c >= "5", "senior")


def numeric_experience_bucket(x: Column) -> Column:
    v = F.coalesce(x, F.lit(0.0))
    return F.when(v <= 1, "freshers").when(v <= 3, "early").when(v <= 5, "mid").otherwise("senior")


def fresh_or_all(df: DataFrame, fresh: Column) -> DataFrame:
    """The fresh rows; all rows if none is.  One aggregate row decides, no driver branch and no window over all rows."""
    marked = df.withColumn("__fresh", F.coalesce(fresh, F.lit(False)))
    any_ = marked.agg(F.coalesce(F.bool_or("__fresh"), F.lit(False)).alias("__any"))  # one row
    return marked.join(F.broadcast(any_)).filter(F.col("__fresh") | ~F.col("__any")).drop("__fresh", "__any")


def page(df: DataFrame, order: list[Column], number: int = 1, size: int = PAGE_USUAL) -> DataFrame:
    """One page in a total order; the size is clamped."""
    size = min(PAGE_MOST, max(PAGE_LEAST, size))
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def page_count(df: DataFrame, size: int = PAGE_USUAL) -> DataFrame:
    size = min(PAGE_MOST, max(PAGE_LEAST, size))
    return df.agg(F.count("*").alias("total")).withColumn("pages", F.ceil(F.col("total") / size).cast("bigint"))


def top(df: DataFrame, by: list[Column], k: int, keep: Column | None = None) -> DataFrame:
    """The k commonest values of ``by`` with their counts, ties by value."""
    rows = df if keep is None else df.filter(keep)
    grouped = rows.groupBy(*by).agg(F.count("*").alias("n"))
    return grouped.orderBy(F.desc("n"), *grouped.columns[:-1]).limit(k)


def missing_to_other(c: Column) -> Column:
    v = trimmed(c)
    return F.when(v.isNull() | (v == ""), "Other").otherwise(v)


def specified(c: Column) -> Column:
    return c.isNotNull() & (trimmed(c) != "") & (F.lower(trimmed(c)) != NOT_SPECIFIED.lower())
