"""Text cleaning, HTML, URLs and ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from postgrove.contract import NOT_SPECIFIED, trimmed

#: The entities decoded, the ampersand last.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&rsquo;", "’"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&")]
BLOCK_TAGS = r"(?i)<\s*/?\s*(?:p|div|li|ul|ol|br|h[1-6]|tr|td|table|section|article)\b[^>]*>"


def clean(c: Column) -> Column:
    """No-break spaces become spaces, runs of blanks one space, outer blanks go."""
    return F.trim(F.regexp_replace(F.translate(c, " ", " "), r"(?U)\s+", " "))


def strip_html(c: Column) -> Column:
    """Block tags become a space, other tags nothing; then entities are decoded.  Script text stays."""
    t = F.regexp_replace(F.regexp_replace(c, BLOCK_TAGS, " "), r"<[^>]*>", "")
    for name, sign in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(sign))
    return clean(t)


def first_value(*cols: Column) -> Column:
    """The first that is neither null nor blank after cleaning."""
    return F.coalesce(*[F.nullif(clean(c.cast("string")), F.lit("")) for c in cols])


def bare_url(c: Column) -> Column:
    """Without query and fragment, without closing slashes, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(clean(c), r"[?#].*$", ""), r"/+$", ""))


def fallback_job_id(prefix: Column, source: Column, link: Column, title: Column, company: Column, location: Column) -> Column:
    """``prefix_`` and 16 hex digits of the hash of source and bare link, or of the four fields without a link."""
    has = F.length(F.coalesce(clean(link), F.lit(""))) > 0
    basis = F.when(has, F.concat_ws("|", source, bare_url(link))).otherwise(F.lower(F.concat_ws("|", source, title, company, location)))
    return F.concat(prefix, F.lit("_"), F.substring(F.sha2(basis, 256), 1, 16))


def canonical_url(c: Column) -> Column:
    """Query and fragment cut, one closing slash."""
    return F.concat(F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"/+$", ""), F.lit("/"))


def id_from_url(c: Column) -> Column:
    """The ad number in a URL by ordered patterns, else its last run of five digits or more; else null."""
    got = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    runs = F.regexp_extract_all(c, F.lit(r"(\d{5,})"), 1)
    return F.coalesce(got(r"[?&]jobId=(\d+)"), got(r"/view/(?:[^/?#]*-)?(\d+)"), got(r"-(\d{6,})(?:[/?#]|$)"), got(r"[?&]currentJobId=(\d+)"), F.try_element_at(runs, F.lit(-1)))


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def split_list(c: Column, pattern: str = ",") -> Column:
    """Pieces, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, pattern), trimmed), lambda x: x != "")


def parse_bool(c: Column, invalid: Column | None = None) -> Column:
    """Text to boolean; ``invalid`` (null unless given) for what is neither."""
    v = F.lower(F.trim(c))
    return F.when(v.isin("1", "true", "yes", "y", "on"), True).when(v.isin("0", "false", "no", "n", "off"), False).otherwise(invalid if invalid is not None else F.lit(None).cast("boolean"))


def distinct_ignoring_case(items: Column) -> Column:
    """First spellings, in order."""
    low = F.transform(items, F.lower)
    return F.transform(F.filter(F.arrays_zip(items.alias("i"), F.transform(low, lambda x, k: F.array_position(low, x) == k + 1).alias("f")), lambda p: p["f"]), lambda p: p["i"])


def joined_skills(c: Column) -> Column:
    """A list text with case-insensitive repeats removed, joined by ``; ``; blank becomes the placeholder."""
    text = F.array_join(distinct_ignoring_case(split_list(c, "[,;|]")), "; ")
    return F.when(F.length(F.coalesce(text, F.lit(""))) > 0, text).otherwise(NOT_SPECIFIED)


def metadata_cut(c: Column) -> Column:
    """Without trailing site metadata: times ago, applicants, calls to look."""
    t = clean(c)
    for p in (r"(?i)\s*[·|-]?\s*\d+\s+(?:seconds?|minutes?|hours?|days?|weeks?|months?)\s+ago.*$", r"(?i)\s*[·|-]?\s*(?:over\s+)?\d+\s+applicants?.*$", r"(?i)\s*see who.*$", r"(?i)\s*.{0,80}has hired for this role.*$", r"(?i)\s*be an early applicant.*$"):
        t = F.regexp_replace(t, p, "")
    return F.trim(t)


def looks_like_metadata(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)\d+\s+(?:minutes?|hours?|days?|weeks?|months?)\s+ago|\d+\s+applicants?|see who|has hired|early applicant|actively hiring|promoted"), F.lit(False))
