"""Queries over their whole input: brute force on small fixtures."""

import re
from collections import Counter

import pytest

from postgrove.functions.category import BODY_RULES, TITLE_RULES
from postgrove.functions.skills import REPORTED
from postgrove.plans.registry import QUERIES

POSTINGS = [
    ("QA Tester", "Selenium; Java|SQL", "We test with Python."), ("Data Engineer", "Spark\nETL", None), ("Data Engineer", None, "Python, SQL and Spark on AWS"), ("Java Developer", "Java", "Git and Docker"),
    ("Data Scientist", "Machine Learning, Python", "SQL"), ("Data Analyst", "Excel/SQL", "Tableau"), ("DevOps Lead", "AWS", "Kubernetes; Docker"), ("Chef", None, "Excel at cooking"), ("Trainee", "tableau", None),
    (None, None, None), ("Cook", "Not Specified", "No figures"), ("Backend Developer", "node.js", "Java or C#, with Git"),
]


def tables(spark, at, **named):
    """A folder of tables from rows and a schema each."""
    for name, (rows, schema) in named.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return str(at)


@pytest.fixture(scope="module")
def postings(spark, tmp_path_factory):
    rows = [(i, *p) for i, p in enumerate(POSTINGS)]
    return tables(spark, tmp_path_factory.mktemp("postings"), jobs=(rows, "row_id long, title string, skills string, full_description string"))


def category(title, skills, text):
    body = " ".join(x for x in (skills, text) if x is not None).lower()
    return next((c for c, p in TITLE_RULES if re.search(p, (title or "").lower())), None) or next((c for c, p in BODY_RULES if re.search(p, body)), "Other")


def named(skills, text):
    body = " ".join(x for x in (skills, text) if x is not None).lower()
    return [s for s in REPORTED if re.search(rf"(?<![a-z0-9_]){re.escape(s.lower())}(?![a-z0-9_])", body)]


def test_category_top_skills_ranks_every_category_from_skills_and_description(spark, postings):
    counts = Counter((category(*p), s) for p in POSTINGS for s in named(*p[1:]))
    want = set()
    for c in {c for c, _ in counts}:
        ranked = sorted(((-n, s) for (k, s), n in counts.items() if k == c))[:8]
        want |= {(c, s, -n, i + 1) for i, (n, s) in enumerate(ranked)}
    assert {c for c, *_ in want} == {"QA", "DE", "SE", "AI", "DA", "Cloud", "Other"}
    assert {tuple(r) for r in QUERIES["category_top_skills"](spark, postings).collect()} == want


def test_skill_tier_rank_counts_skills_named_only_in_the_description(spark, postings):
    counts = Counter(s for p in POSTINGS for s in named(*p[1:]))
    ranked = sorted((-n, s) for s, n in counts.items())[:10]
    want = {(s, -n, int(-100 * n / len(POSTINGS) + 0.5)) for n, s in ranked}
    got = QUERIES["skill_tier_rank"](spark, postings).collect()
    assert {(r.skill, r.n, r.pct) for r in got} == want


PLACES = [(1, "Bengaluru", "Karnataka"), (2, "Pune", "Maharashtra"), (3, "Noida", "Uttar Pradesh"), *[(i, f"Place{i}x", "Kerala") for i in range(4, 21)], (21, "Udhebhakota", "Haryana"), (22, "Udhebhakota", "Bihar")]
PLACE_SCHEMA = "city_id long, city string, state string"


@pytest.mark.parametrize("city, state, want", [
    ("Pune", "Karnataka", "Maharashtra"), (" PUNE ", "Karnataka", "Maharashtra"), ("Some village", "Karnataka", "Karnataka"), ("Some village", " mh ", "Maharashtra"), ("Some village", "JH", "Jharkhand"),
    (None, "Goa", "Goa"), ("Pune, Maharashtra", None, "Maharashtra"), ("Noida or Pune", "n/a", "Maharashtra"), ("Old Place20x", "", "Kerala"), ("Pune East", "Kerala", "Kerala"), ("Kerala", None, "Kerala"),
    ("Udhebhakota road", None, "Haryana"), ("Some village", "India", None), (None, None, None),
])
def test_state_priority_lookup_tiers(spark, tmp_path, city, state, want):
    d = tables(spark, tmp_path, city_ref=(PLACES, PLACE_SCHEMA), jobs=([(1, city, state)], "row_id long, city string, state string"))
    assert QUERIES["state_priority_lookup"](spark, d).first().place_state == want


def test_node_contains_counts_has_every_place(spark, tmp_path):
    cities = ["Pune", "pune, Maharashtra", "Noida or Pune", "Place20x", "Old place20X", "Udhebhakota", None, "", "elsewhere"]
    d = tables(spark, tmp_path, city_ref=(PLACES, PLACE_SCHEMA), jobs=(list(enumerate(cities)), "row_id long, city string"))
    want = {(n, s, sum(n.lower() in (c or "").lower() for c in cities)) for _, n, s in PLACES}
    assert ("Place20x", "Kerala", 2) in want and ("Udhebhakota", "Bihar", 1) in want
    got = [tuple(r) for r in QUERIES["node_contains_counts"](spark, d).collect()]
    assert len(got) == len(PLACES) and set(got) == want


def test_embed_left_join_keeps_orders_of_all_dates(spark, tmp_path):
    d = tables(
        spark, tmp_path, orders=([(1, 7, "1995-03-01 00:00:00"), (2, 7, "2001-03-01 00:00:00"), (3, 8, "1999-12-31 00:00:00"), (4, 9, None), (5, None, "2000-01-01 00:00:00")], "o_orderkey long, o_custkey long, o_orderdate string"),
        customer=([(7, "Ann", 1), (8, "Bo", 99)], "c_custkey long, c_name string, c_nationkey long"), nation=([(1, "INDIA")], "n_nationkey long, n_name string"),
    )
    assert {tuple(r) for r in QUERIES["embed_left_join"](spark, d).collect()} == {(1, "Ann", "INDIA"), (2, "Ann", "INDIA"), (3, "Bo", None), (4, None, None), (5, None, None)}


def test_dq_queries_report_bad_experience(spark, tmp_path):
    sound = ("1", "Naukri", "Cook", "Acme", "https://x.example/1", "Pune", "Maharashtra", "India")
    rows = [(1, *sound, "2", "5"), (2, *sound, "9", "5"), (3, *sound, "510", None), (4, *sound, None, None), (5, *sound[:4], "ftp://x", *sound[5:], "9", "5")]
    rows = [(*r, r"B\.?Tech" if r[0] == 4 else "B.Tech") for r in rows]
    d = tables(spark, tmp_path, jobs=(rows, "row_id long, job_id string, source string, title string, company string, link string, city string, state string, country string, min_experience_years string, max_experience_years string, degree_required string"))
    assert {tuple(r) for r in QUERIES["dq_problem_rows"](spark, d).collect()} == {(2, "bad_experience"), (3, "bad_experience"), (5, "bad_experience"), (5, "bad_link"), (4, "polluted_education")}
    counts = {r.check_name: r.broken for r in QUERIES["dq_audit_summary"](spark, d).collect()}
    assert len(counts) == 12 and {k: n for k, n in counts.items() if n} == {"bad_experience": 3, "bad_link": 1, "polluted_education": 1}
