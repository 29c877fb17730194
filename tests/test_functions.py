"""Golden cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from postgrove.functions.category import domain_of, job_category, slot_of
from postgrove.functions.education import classify_education, normalize_education
from postgrove.functions.experience import career_tier, experience_display, experience_number, experience_problems, experience_range, parse_experience, review_reason
from postgrove.functions.location import indian_hub, repair_fields, split_location, strict_city
from postgrove.functions.skills import catalog_skills, extract_skills, labelled_skills
from postgrove.functions.source import site
from postgrove.functions.text import clean, distinct_ignoring_case, fallback_job_id, id_from_url, joined_skills, strip_html
from postgrove.functions.timeparse import parse_instant, posted_instant, within_recency
from postgrove.operators.relevance import role_relevant

NS = "Not Specified"


def value(spark, *columns):
    """The columns over one row with no data."""
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0]
    plain = lambda v: tuple(v) if hasattr(v, "asDict") else v
    out = [plain(v) for v in row]
    return out[0] if len(out) == 1 else out


@pytest.mark.parametrize("text, want", [
    ("Bengaluru, Karnataka, India", ("Bengaluru", "Karnataka", "India")), ("Kolkata, West Bengal, India", ("Kolkata", "West Bengal", "India")), ("Tamil Nadu, India", (NS, "Tamil Nadu", "India")),
    ("Delhi, India", (NS, "Delhi", "India")), ("Hyderabad, TelanganaIndia", ("Hyderabad", "Telangana", "India")), ("TelanganaIndia", (NS, "Telangana", "India")),
    ("Mumbai Metropolitan Region 48 minutes ago", ("Mumbai Metropolitan Region", NS, "India")), ("", (NS, NS, NS)), (None, (NS, NS, NS)),
])
def test_split_location(spark, text, want):
    assert value(spark, split_location(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("fields, want", [
    ((NS, NS, "Haryana, India"), (NS, "Haryana", "India")), ((NS, "Telangana, India", NS), (NS, "Telangana", "India")), (("", "", "Karnataka, India"), (NS, "Karnataka", "India")), (("", "Haryana", "India"), (NS, "Haryana", "India")),
])
def test_repair_fields(spark, fields, want):
    assert value(spark, repair_fields(*[F.lit(x) for x in fields])) == want


@pytest.mark.parametrize("text, want", [
    (r"B\.?E\., Bachelor(?:'s)?, degree", "B.E., Bachelor's"), ("Bachelor(?:'s)?, degree", "Bachelor's"), (r"B\.?Sc\.", "B.Sc."), (r"M\.?Com\.", "M.Com."), (r"B\.?A\.", "B.A."), (r"M\.?Tech", "M.Tech"),
    ("Master", "Master's"), ("degree", NS), ("", NS),
])
def test_education(spark, text, want):
    assert value(spark, normalize_education(F.lit(text))) == want


def test_classify_education(spark):
    assert value(spark, classify_education(F.lit("B.Tech, MBA")))[:2] == ("Postgraduate / Master's", "Tech & Management (MCA, M.Tech, MBA)")
    assert value(spark, classify_education(F.lit(NS))) == ("Open / No Degree Required", NS, [NS])
    assert value(spark, classify_education(F.lit("Xyz")))[2] == ["Xyz"]


@pytest.mark.parametrize("text, want", [
    ("Experience: 2 to 5 years", ("2", "5")), ("5+ years of experience", ("5", NS)), ("Minimum 4 years of experience in data analytics.", ("4", NS)),
    ("Candidates with 6 months of experience are eligible.", ("0.5", NS)), ("Freshers are welcome to apply for this position.", ("0", "0")), ("Experience: 510 Years", None),
    ("no figure", None), (None, None),
])
def test_parse_experience(spark, text, want):
    assert value(spark, parse_experience(F.lit(text).cast("string"))) == want


def test_experience_priority_and_review(spark):
    s = lambda x: F.lit(x).cast("string")
    assert value(spark, experience_range(s("https://x/a-2-to-5-years-1"), s("2 months experience"), s(None), s(None), s(None))) == ("2", "5")
    assert value(spark, experience_range(s(None), s("5-7 years"), s("1"), s("2"), s(None))) == ("5", "7")
    assert value(spark, experience_range(s(None), s(None), s(None), s(None), s("3 Yrs"))) == ("3", "3")
    assert value(spark, experience_range(s(None), s(None), s(None), s(None), s(None))) == (NS, NS)
    assert value(spark, review_reason(s("6 months of experience"), s(None), s(None), s(None))) == "Review: experience duration has no explicit bound"
    assert value(spark, review_reason(s("2 years here, 3 years there"), s(None), s(None), s(None))) == "Review: multiple experience figures in description"


def test_experience_columns(spark):
    n = lambda x: experience_number(F.lit(x).cast("string"))
    assert value(spark, n("5+"), n("45"), n("abc 7"), n("n/a"), n(None)) == [5.0, 4.0, 7.0, None, None]
    d = lambda a, b: experience_display(F.lit(a).cast("double"), F.lit(b).cast("double"))
    assert value(spark, d(2, 2), d(2, 5), d(2, None), d(None, 4), d(None, None)) == ["2 Yrs", "2 - 5 Yrs", "2+ Yrs", "Up to 4 Yrs", NS]
    assert value(spark, career_tier(F.lit(None).cast("double"), F.lit(6.0))) == "Mid-Level (5-8 Yrs)"
    assert value(spark, experience_problems(F.lit("510"), F.lit("9"))) == ["minimum above 100", "minimum exceeds maximum"]


def test_text(spark):
    assert value(spark, strip_html(F.lit("<p>Build &amp; test</p><li>APIs</li>"))) == "Build & test APIs"
    assert value(spark, clean(F.lit("  a  b\n"))) == "a b"
    assert value(spark, joined_skills(F.lit("SQL, sql; Python|SQL")), distinct_ignoring_case(F.array(F.lit("A"), F.lit("a"), F.lit("b")))) == ["SQL; Python", ["A", "b"]]
    key = lambda t: fallback_job_id(F.lit("n"), F.lit("n"), F.lit("https://x/1?utm=2"), F.lit(t), F.lit("c"), F.lit("p"))
    a, b = value(spark, key("one"), key("two"))
    assert a == b and len(a) == 18
    assert value(spark, id_from_url(F.lit("https://x/view/some-title-123456")), id_from_url(F.lit("https://x/none"))) == ["123456", None]


def test_places(spark):
    hub = lambda c, s: indian_hub(F.lit(c), F.lit(s))
    assert value(spark, hub("Navi Mumbai", "MH"), hub("KA", ""), hub("CT", ""), hub("Indore", "MP"), hub(NS, NS), hub("Remote", "")) == [
        "Mumbai, Maharashtra", "Karnataka", "Pan-India (Flexible)", "Indore, Madhya Pradesh", "India (Not Specified)", "Remote"]
    strict = lambda c: strict_city(F.lit(c), "Chennai")
    assert value(spark, strict("Chennai, TN"), strict("Chennai / Pune"), strict("Chennai or Dubai"), strict("Salem")) == [True, False, False, False]


def test_sources_skills_categories(spark):
    assert value(spark, site(F.lit(" Linked In")), site(F.lit("naukri.com")), site(F.lit("x"))) == ["linkedin", "naukri", None]
    assert value(spark, extract_skills(F.lit("R programming, Python and C++ on AWS"))) == "Python, R, C++, AWS"
    assert value(spark, extract_skills(F.lit("Our rapid javabeans"))) == NS
    assert [x.evidence for x in value(spark, catalog_skills(F.lit("k8s and sql server")))] == ["sql", "sql server", "k8s"]
    assert value(spark, labelled_skills(F.lit("Key skills: SQL, Hive. Apply now"))) == "SQL, Hive"
    assert value(spark, job_category(F.lit("Data Engineer"), F.lit("qa"), F.lit("")), job_category(F.lit("Trainee"), F.lit("tableau"), F.lit(None).cast("string")), job_category(F.lit("Chef"), F.lit(""), F.lit(""))) == ["DE", "DA", "Other"]
    assert value(spark, *[slot_of(F.lit(x)) for x in ("data analyst", "FastAPI", "Spring Boot", "Kubernetes", "nurse")]) == [0, 1, 2, 3, None]
    assert value(spark, domain_of(F.lit("spring boot")), domain_of(F.lit(""))) == ["Java Development", "General Extraction"]


def test_times(spark):
    now = F.lit("2026-01-10 12:00:00").cast("timestamp")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    p = lambda x: show(posted_instant(F.lit(x), now))
    assert value(spark, p("posted 1 day ago"), p("3 hours ago"), p("today"), p("Yesterday"), p("2 weeks ago"), p("2026-01-05"), p("?")) == [
        "2026-01-09 12:00", "2026-01-10 09:00", "2026-01-10 06:00", "2026-01-09 12:00", "2025-12-27 12:00", "2026-01-05 00:00", None]
    fresh = lambda x, h, strict=False: within_recency(F.lit(x), now, h, strict)
    assert value(spark, fresh("posted 1 day ago", 24), fresh("posted 11 days ago", 72), fresh("?", 24), fresh("?", 24, True), fresh("2026-01-10", 12)) == [True, False, True, False, True]
    i = lambda x: show(parse_instant(F.lit(x)))
    assert value(spark, i("22-09-2025 21:57"), i("2025/09/13 13:20"), i("22 Nov 2025, 09:50"), i("1758589260"), i("2026-01-22T04:29:00.000000Z"), i("n/a")) == [
        "2025-09-22 21:57", "2025-09-13 13:20", "2025-11-22 09:50", "2025-09-23 01:01", "2026-01-22 04:29", None]


@pytest.mark.parametrize("title, query, want", [
    ("", "python", True), ("Senior Python Developer", "python developer", True), ("Sales Executive", "python developer", False), ("Data Scientist", "data analyst", False), ("Reporting Analyst", "data analyst", True),
    ("Data Scientist", "python developer", False), ("Java Developer", "python developer", False), ("Software Engineer", "python developer", True), ("React Developer", "java developer", False), ("Site Engineer", "site engineer civil", True),
])
def test_relevance(spark, title, query, want):
    assert value(spark, role_relevant(F.lit(title), F.lit(query))) is want
