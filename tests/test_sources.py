"""Readers, keyed tables, the archive, the batch pipeline and streams."""

import json
import uuid

from pyspark.sql import functions as F, types as T

from postgrove.contract import CSV_FIELDS
from postgrove.operators import pipeline, search
from postgrove.session import cut, shared_dir, stored
from postgrove.sources.readers import KeyedTable, age_bucket, archive_batch, clean_record_gate, json_ld, json_ld_skills, read_csv, read_csv_lines, read_json_state, search_url, write_csv

NS = "Not Specified"


def at(spark):
    return f"{shared_dir(spark)}/s-{uuid.uuid4().hex}"


def test_csv_round_trip(spark, tmp_path):
    row = ["a_1", "s", 'say "hi", twice', "c", "two\nlines", "st", "co", "1", "2", "x,y", "", "sp", "t", "https://x", "end"]
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in CSV_FIELDS))
    write_csv(df, f"file://{tmp_path}/out", quote_all=True)
    got = read_csv(spark, f"file://{tmp_path}/out").collect()
    assert [x or "" for x in got[0]] == row and len(got) == 1
    (tmp_path / "l.csv").write_text("a,b\n1,\n2,x\n3\n")
    lines = read_csv_lines(spark, f"file://{tmp_path}/l.csv", T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])).collect()
    assert sorted(tuple(r) for r in lines) == [("1", NS), ("2", "x")]


def test_json_state(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps(["a", " ", "b", "a"]))
    (tmp_path / "bad.json").write_text("[broken")
    read = lambda n: sorted(r.value for r in read_json_state(spark, f"file://{tmp_path}/{n}").collect())
    assert read("ok.json") == ["a", "b"] and read("bad.json") == [] and read("none.json") == []


def test_json_ld(spark):
    html = "<script type='application/ld+json'>{\"@graph\": [{\"skills\": [\"SQL\", \"SQL\", \"R\"]}, {\"skills\": \"a; b\"}]}</script><script type=application/ld+json>[{\"x\": 1}]</script><script type=application/ld+json>{bad</script>"
    df = spark.createDataFrame([(html,), ("no page",), (None,)], "h string").select(F.explode_outer(json_ld(F.col("h"))).alias("r")).filter("r IS NOT NULL")
    assert sorted((r.s or [] for r in df.select(json_ld_skills(F.col("r")).alias("s")).collect()), key=str) == sorted([["SQL", "R"], ["a", "b"], []], key=str)


def test_keyed_table(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    t = KeyedTable(spark, at(spark), "k", schema)
    make = lambda rows: spark.createDataFrame(rows, schema)
    held = lambda: sorted(tuple(r) for r in t.read().collect())
    assert held() == [] and t.append(make([]), [F.col("v")]) == 0 and held() == []
    assert t.append(make([("a", 2), ("a", 1), (" ", 3), (None, 4), ("b", 5)]), [F.col("v")]) == 2 and held() == [("a", 1), ("b", 5)]
    t.upsert(make([("a", 9), ("c", 7)]))
    assert held() == [("a", 9), ("b", 5), ("c", 7)]
    assert t.mirror(make([("a", 9), ("b", 6), ("d", 1)])) == {"keep": 1, "update": 1, "delete": 1, "insert": 1} and held() == [("a", 9), ("b", 6), ("d", 1)]
    before = t.folders()
    assert t.append(make([("z", 1)]), [F.col("v")]) == 1 and t.folders()[: len(before)] != [] and set(before) < set(t.folders())  # an append rewrites nothing
    t.reset()
    assert held() == []


def test_archive_keeps_each_job_once_a_day(spark):
    path, when = at(spark), F.lit("2026-01-10 20:00:00").cast("timestamp")
    for ids in (["1", "2"], ["2", "3"]):
        archive_batch(spark.createDataFrame([(i,) for i in ids], "job_id string"), path, when, "General Extraction")
    got = spark.read.parquet(path).collect()
    assert sorted(r.job_id for r in got) == ["1", "2", "3"] and {str(r.date_ist) for r in got} == {"2026-01-11"}


def test_gate_urls_and_buckets(spark):
    df = spark.createDataFrame([("a", "https://x", None), ("a b", "https://x", "t"), ("a:b", "https://x", "t"), ("c", "ftp://x", "t"), (None, "https://x", "t")], "job_id string, link string, title string")
    assert [tuple(r) for r in clean_record_gate(df).collect()] == [("a", "https://x", NS)]
    one = spark.range(1).select(search_url("https://b.example", F.lit("C++ Dev"), F.lit("New Delhi"), F.lit(2)).alias("u"), age_bucket(F.lit(50)).alias("b")).first()
    assert one.u == "https://b.example/c-dev-jobs-in-new-delhi-2?k=C%2B%2B+Dev" and one.b == 3


def test_normalize_enrich_and_dedup(spark):
    raw = spark.createDataFrame(
        [("Python Dev", "Acme", "Pune, Maharashtra, India", "2-5 Yrs", "https://x/1", "<p>Python &amp; SQL</p> B.Tech"), ("Lost", "Acme", None, None, " ", "x"), (None, None, None, None, None, None)],
        "job_title string, company_name string, location string, experience string, url string, description string",
    )
    good, bad = pipeline.normalize(raw, "Naukri", "now")
    r = good.collect()[0]
    assert good.columns == CSV_FIELDS and (r.city, r.state, r.min_experience_years, r.max_experience_years, r.full_description) == ("Pune", "Maharashtra", "2", "5", "Python & SQL B.Tech")
    assert sorted(x.reason for x in bad.collect()) == ["blank link", "blank link"]
    e = pipeline.enrich(good).collect()[0]
    assert e.skills == "Python, SQL" and e.degree_required == "B.Tech"
    seen = spark.createDataFrame([("k1",)], "job_id string")
    batch = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 1)], "job_id string, at int")
    one = pipeline.first_occurrence(batch, ["job_id"], [F.col("at")])
    assert sorted(map(tuple, one.collect())) == [("k1", 1), ("k2", 1)] and [r.job_id for r in pipeline.fresh(one, seen).collect()] == ["k2"]
    card = spark.createDataFrame([("k", "x", NS)], "job_id string, a string, b string")
    detail = spark.createDataFrame([("k", NS, "new")], "job_id string, a string, b string")
    assert tuple(pipeline.overwrite_specified(card, detail, "job_id", ["a", "b"]).first()) == ("k", "x", "new")


def test_pages_are_disjoint_and_fallback(spark):
    df = spark.range(60)
    first, second = ({r.id for r in search.page(df, [F.col("id")], n, 25).collect()} for n in (1, 2))
    assert len(first) == len(second) == 25 and not first & second
    assert search.fresh_or_all(df, F.col("id") > 57).count() == 2 and search.fresh_or_all(df, F.col("id") > 100).count() == 60 and search.fresh_or_all(df.filter("false"), F.lit(True)).count() == 0


def test_shared_folder(spark):
    df = spark.range(10)
    assert cut(df).count() == 10 and stored(df, "t").count() == 10
