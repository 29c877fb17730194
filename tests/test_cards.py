"""Golden cases of card parsing, degrees in free text, and place relevance."""

import pytest
from pyspark.sql import functions as F

from postgrove.functions.cards import absolute_url, card_experience, clean_place, last_day, title_from_link
from postgrove.functions.category import domain_of, slot_of
from postgrove.functions.degrees import EITHER, degree_text, explicit_degrees, text_without_degrees
from postgrove.functions.location import CITY_STATE, polluted_city, polluted_country, polluted_education, polluted_state, split_location
from postgrove.operators import pipeline, search


def values(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_card_experience(spark):
    cases = [("Requires 3-5 years of Python", "3 to 5 years"), ("5+ years", "5+ years"), ("minimum 4 years of experience", "4 years"), ("2 to 4 yrs", "2 to 4 years"), ("experience of 7 yrs", "7 years"),
             ("Experience: 6 years", "6 years"), ("4 years", "Not Specified"), ("", "Not Specified"), (None, "Not Specified")]
    assert values(spark, *[card_experience(F.lit(t).cast("string")) for t, _ in cases]) == [w for _, w in cases]


def test_last_day(spark):
    cases = [("Posted today", True), ("just now", True), ("Posted 3 hours ago", True), ("Posted 1 day ago", True), ("Posted 2 days ago", False), ("Posted 1 week ago", False), ("", False), (None, False)]
    assert values(spark, *[last_day(F.lit(t).cast("string")) for t, _ in cases]) == [w for _, w in cases]


@pytest.mark.parametrize("title, link, company, location, want", [
    ("Job description", "https://x.example/job-listings-senior-python-developer-acme-bengaluru-0-to-1-years-123456?src=1", "Acme", "Bengaluru", "senior python developer"),
    ("", "https://x.example/job-listings-data-engineer-navi-mumbai-2-to-5-years-1/", "Other", "Pune, Navi Mumbai", "data engineer"), (None, "https://x.example/cook", None, None, "cook"),
    ("Cook", "https://x.example/other", "Acme", "Pune", "Cook"), ("About the role", "https://x.example/acme-1-to-2-years-9", "Acme", "", "Not Specified"),
    ("Job details", "https://x.example/macmen-acmes-tester", "Acme", None, "macmen acmes tester"),
])
def test_title_from_link(spark, title, link, company, location, want):
    assert values(spark, title_from_link(*[F.lit(x).cast("string") for x in (title, link, company, location)])) == [want]


def test_links_and_places(spark):
    assert values(spark, *[absolute_url(F.lit(x).cast("string"), "https://x.example/") for x in ("//y.example/a", "/a", "http://z", "mailto:x", "", None)]) == ["https://y.example/a", "https://x.example/a", "http://z", "", "", ""]
    assert values(spark, *[clean_place(F.lit(x), F.lit(c).cast("string"), r"(?i)\d+ applicants") for x, c in (("Pune", "Acme"), ("Acme Labs Pune, Maharashtra", "Acme Labs"), ("Acme", "Acme"), ("200 applicants", None), ("", "x"))]) == [True, False, True, False, False]


def test_degrees(spark):
    text = "About us\nEducation: any stream\nB.Tech or MCA\nfull time\nSkills: SQL\nWe hire graduates.\nOther"
    assert values(spark, degree_text(F.lit(text))) == ["Education: any stream \n B.Tech or MCA \n full time"]
    cases = [(text, ["B.E/B.Tech", "MCA"]), ("Bachelor's or Master's degree", [EITHER]), ("A Bachelor's degree is needed", ["Any Bachelor's Degree"]), ("Degree: MBA\nMaster's degree", ["MBA"]), ("Nothing here", []), ("", []), (None, []), ("PhD, M.Sc. or Diploma", ["M.Sc", "PhD", "Diploma"])]
    assert values(spark, *[explicit_degrees(F.lit(t).cast("string")) for t, _ in cases]) == [w for _, w in cases]
    assert values(spark, text_without_degrees(F.lit("You build APIs. A degree is needed! You test.\nMajor in maths"))) == ["You build APIs. You test."]


def test_place_values(spark):
    cases = [("Ranchi, JH", ("Ranchi", "Jharkhand", "India")), ("Delhi, DL, India", ("Delhi", "Delhi", "India")), ("Leh, Ladakh", ("Leh", "Ladakh", "India")), ("Visakhapatnam", ("Visakhapatnam", "Andhra Pradesh", "India")),
             ("Faridabad", ("Faridabad", "Haryana", "India")), ("Kochi", ("Kochi", "Not Specified", "India")), ("Dehradun, UK", ("Dehradun", "Uttarakhand", "India")), ("Bhilai, CG, India", ("Bhilai", "Chhattisgarh", "India"))]
    assert [tuple(x) for x in values(spark, *[split_location(F.lit(t)) for t, _ in cases])] == [w for _, w in cases]
    assert values(spark, *[polluted_city(F.lit(x).cast("string")) for x in ("Pune 3 days ago", "StateStreet  Pune", "Pune 411001", "TelanganaIndia", "n/a", None)]) == [True, True, False, True, False, False]
    assert values(spark, polluted_state(F.lit("tamil nadu India")), polluted_state(F.lit("tamil naduindia")), polluted_country(F.lit("Haryana, India")), polluted_country(F.lit("india")), polluted_education(F.lit(r"B\.?Tech")), polluted_education(F.lit("B.Tech"))) == [False, True, True, False, True, False]


def test_slots_and_domains(spark):
    slots = [("Power BI developer", 0), ("Django Backend", 1), ("Spring Boot Engineer", 2), ("AWS DevOps", 3), ("nurse", None), ("", None), (None, None)]
    assert values(spark, *[slot_of(F.lit(t).cast("string")) for t, _ in slots]) == [w for _, w in slots]
    domains = [("spring boot", "Java Development"), ("", "General Extraction"), (None, "General Extraction"), ("nurse", "Custom Extraction"), ("Data Analytics", "Data & Analytics"), ("gcp", "Cloud & DevOps")]
    assert values(spark, *[domain_of(F.lit(t).cast("string")) for t, _ in domains]) == [w for _, w in domains]


def test_located_and_state_hubs(spark):
    rows = [(1, "Pune, Mumbai", None, None, "u", ""), (2, "Delhi", "Delhi", "India", "https://x/pune-job", ""), (3, "Delhi", "x", "y", "u", "We sit in Pune."), (4, None, None, None, "u", "a" * 395 + " pune"), (5, "", "", "", None, "a" * 401 + " pune"), (6, "Hubli", "KA", "", "", None)]
    df = spark.createDataFrame(rows, "id int, city string, state string, country string, link string, full_description string")
    got = {r.id: (r.city, r.state, r.country) for r in pipeline.located(df, "pune", CITY_STATE).collect()}
    assert got == {1: ("Pune", "Maharashtra", "India"), 2: ("Pune", "Delhi", "India"), 3: ("Pune", "x", "y"), 4: ("Pune", "Maharashtra", "India")}
    assert pipeline.located(df, " All India ", CITY_STATE).count() == len(rows)
    assert [r.id for r in df.filter(search.in_state(" KARNATAKA ")).collect()] == [6]


def test_review_messages(spark):
    from postgrove.functions.experience import REVIEW, review_reason

    cases = [("2 years of SQL and 3 years of Java", "2", "3", "u", "many"), ("needs 4 years", None, None, "u", "unbound"), ("no figure", "5", "3", "u", "order"), ("no figure", "5+", "7", "u", "malformed"),
             ("2 to 5 years", None, None, "https://x/a-3-to-6-years-1", "link"), ("2 to 5 years", "3", "5", "u", "fields"), ("2 to 5 years", "2", "5", "https://x/a-2-to-5-years-1", None), ("", "9", "1", "u", None), (None, None, None, None, None)]
    got = values(spark, *[review_reason(*[F.lit(x).cast("string") for x in c[:4]]) for c in cases])
    assert got == [REVIEW[c[4]] if c[4] else "" for c in cases]
