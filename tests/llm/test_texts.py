"""Main text, packing, mixing and spam against brute force and invariants."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postgrove.llm.boilerplate import best_ranges, main_text, page_lines, structure_labels
from postgrove.llm.mixing import mix, mixture_report
from postgrove.llm.packing import pack, pack_histogram
from postgrove.llm.queries import ORACLE, QUERIES
from postgrove.llm.spam import ALONE, curves, score_pages, spam_pages
from postgrove.llm.tokens import VOCABULARY, Sizes, token_count


def total(scores, kept, opening):
    opens = sum(k and (i == 0 or not kept[i - 1]) for i, k in enumerate(kept))
    return sum(s for s, k in zip(scores, kept) if k) - opening * opens


def test_best_ranges_against_all_choices():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.choice([-3, -1, -0.5, 0.5, 1, 2]) for _ in range(rng.randrange(0, 9))]
        best = max((total(s, k, 1.0) for k in itertools.product([False, True], repeat=len(s))), default=0)
        assert abs(total(s, best_ranges(s, None), 1.0) - best) < 1e-9
        one = max([0.0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])
        kept = best_ranges(s)
        assert abs(sum(x for x, k in zip(s, kept) if k) - one) < 1e-9


def test_page_lines(spark, sf):
    jobs = spark.read.parquet(f"{sf}/jobs.parquet").select("row_id", "company", "full_description")
    page = "Menu  Close  Search\nWe use cookies to measure visits. Accept all\nAcme Labs is a privately held group with teams in several states.\nRequirements\n- You will extend the home page and the search menu of Orax for vendors.\nSet alert\n- Travel to 9 sites by year end to meet auditors.\n\n© 2024 HireField. All rights reserved."
    more = spark.createDataFrame([(-1, "Acme Labs", page), (-2, None, None), (-3, "x", ""), (-4, "x", "Not Specified"), (-1, "Acme Labs", page)], "row_id bigint, company string, full_description string")
    out = page_lines(jobs.unionByName(more), "row_id", "full_description", "company", ranges=None).filter("row_id < 0").collect()
    assert sorted((r.row_id, r.line_no) for r in out) == [(-1, n) for n in (1, 1, 2, 2, 6, 6, 9, 9)]
    assert page_lines(jobs.filter("false"), "row_id", "full_description", "company").count() == 0
    text = {r.row_id: r.main_text for r in main_text(jobs.unionByName(more.limit(4)), "row_id", "full_description", "company", ranges=None).filter("row_id < 0").collect()}
    assert text[-1].startswith("Acme Labs is") and "cookies" not in text[-1] and text[-2] is None


def test_structure_labels():
    full = "you will plan the spring work here."
    page = ["menu close", "\x01 is a group", full, "the team", full, full, "skills: sql, r", "set alert", "never pay anyone for a new job."]
    assert structure_labels(page, ["sql"]) == [True, False, True, False, False, False, False, None, True]
    assert structure_labels(["menu", "close"], []) == [None, None] and structure_labels(["", full], []) == [None, None] and structure_labels([], []) == []


def test_page_lines_from_labelled_pages_of_another_language(spark):
    text = "\n".join(["Accueil » Emplois", "Nous cherchons une personne pour tenir les comptes du groupe.", "Missions", "Vous suivez les achats et les ventes chaque semaine.", "Mentions utiles »"])
    pages = spark.createDataFrame([(i, text) for i in range(20)] + [(99, None)], "id bigint, t string")
    labels = spark.createDataFrame([(i, n, n in (1, 5)) for i in range(10) for n in range(1, 6)], "id bigint, line_no int, is_page boolean")
    for ranges in (1, None):
        got = {(r.id, r.line_no) for r in page_lines(pages, "id", "t", labels=labels, ranges=ranges).collect()}
        assert got == {(i, n) for i in range(20) for n in (1, 5)}


def test_pack_histogram_fits_and_places_all():
    rng = random.Random(2)
    for _ in range(200):
        cap = rng.randrange(1, 40)
        h = {x: rng.randrange(1, 30) for x in rng.sample(range(1, cap + 1), rng.randrange(1, min(cap, 12) + 1))}
        packs = pack_histogram(h, cap)
        placed = {}
        for pattern, n in packs:
            assert n > 0 and sum(pattern) <= cap
            for x in pattern:
                placed[x] = placed.get(x, 0) + n
        assert placed == h
        need = -(-sum(x * n for x, n in h.items()) // cap)
        assert need <= sum(n for _, n in packs) <= 2 * need + 1


def test_pack_rows(spark):
    rng = random.Random(3)
    items = [(i, 7 if i % 3 == 0 else rng.choice([0, 1, 5, 20, 99, 100, 101, 350])) for i in range(400)] + [(900, None)]
    df = spark.createDataFrame(items, "id int, n int")
    out = pack(df, "id", F.col("n"), 100).collect()
    by_item, by_bin = {}, {}
    for r in out:
        by_item[r.id] = by_item.get(r.id, 0) + r.tokens
        if r.bin_id is not None:
            by_bin.setdefault(r.bin_id, []).append(r)
    assert by_item == {i: n or 0 for i, n in items}
    assert all(sum(x.tokens for x in b) <= 100 and sorted(x.slot for x in b) == list(range(1, len(b) + 1)) for b in by_bin.values())
    assert set(by_bin) == set(range(1, len(by_bin) + 1))
    assert all(sum(1 for r in out if r.id == i) == max(1, -(-(n or 0) // 100)) for i, n in items)
    assert pack(df.filter("false"), "id", F.col("n"), 100).count() == 0
    with pytest.raises(ValueError):
        pack(df, "id", F.col("n"), 0)


def test_mix(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "a", "a", "B ", "c", "d", None]), rng.randrange(0, 900)) for i in range(6000)]
    df = spark.createDataFrame(docs, "id int, source string, n int")
    weights = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 3), ("c", 0.3, 4), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mix(df, weights, "id", "source", F.col("n")).cache()
    assert mixed.count() == len(docs)
    report = {r.source: r for r in mixture_report(mixed, weights).collect()}
    for s, share in (("a", 0.4), ("b", 0.3), ("c", 0.3)):
        assert abs(report[s].actual_share - share) < 0.02 and report[s].most_copies <= report[s].max_repeats
    assert report["none"].documents == 0 and report["d"].copies == 0 and report[None].copies == 0
    assert mix(df.filter("false"), weights, "id", "source", F.col("n")).count() == 0


def test_curves_against_least_squares():
    rng = np.random.default_rng(5)
    f = [rng.integers(1, 50, size=k) for k in (1, 2, 7, 40)]
    row = np.repeat(np.arange(4), [len(x) for x in f])
    slope, residual = curves(np.concatenate(f).astype(np.int64), row.astype(np.int64), 5)
    for i, x in enumerate(f[1:], 1):
        y, r = np.log(np.sort(x)[::-1].astype(float)), np.log(np.arange(1, len(x) + 1))
        b, a = np.polyfit(r, y, 1)
        assert np.isclose(slope[i], -b) and np.isclose(residual[i], np.sqrt(np.mean((y - a - b * r) ** 2)), atol=1e-6)
    assert slope[0] == residual[0] == slope[4] == 0


def test_spam(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    stuffed = "cheap blue widgets online, best blue widgets, blue widgets near me, buy blue widgets, " * 30
    linked = " ".join(f"[gadget deal {i % 7}](https://shop{i}.example/item/{i})" for i in range(80))
    more = spark.createDataFrame([(-1, stuffed, "en"), (-2, linked, None), (-3, "", "en"), (-4, None, "de"), (-5, "short words here", "en"), (-6, stuffed * 40, "fr"),
            (-7, "cheap widgets cheap widgets buy widgets cheap widgets shop widgets", "en"), (-8, "the " * 300 + "of and to in", "en"), (-7, "cheap widgets cheap widgets buy widgets cheap widgets shop widgets", "en")], "doc_id bigint, text string, lang string")
    both = docs.unionByName(more)
    assert {r.doc_id for r in spam_pages(both).filter("doc_id < 0").collect()} == {-1, -2, -6, -7, -8}
    scores = {r.doc_id: r for r in score_pages(both).filter("doc_id < 0").collect()}
    assert scores[-8].odd < 1 and max(scores[-8].steep, scores[-8].rough) > ALONE  # the curve alone
    # Without any declared language nothing is prose, so nothing diverges from it.
    assert spam_pages(more.filter("doc_id in (-1, -2)").withColumn("lang", F.lit(None).cast("string"))).count() == 0
    share = score_pages(both).filter("doc_id > 0").agg(F.avg(F.col("spam").cast("int"))).first()[0]
    assert share < 0.15
    assert spam_pages(docs.filter("false")).count() == 0


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_token_count(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    texts = ["Madam Speaker, thank you.", "", None, "<|endoftext|>", "é" * 5000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", token_count(F.col("x")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(texts)}


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_sizes_by_word_are_those_of_the_whole_text():
    sizes, rng = Sizes(VOCABULARY), random.Random(6)
    assert sizes.by_word
    letters = " \n\t\u00a0ab'sé1²½.,-<|endoftext|>\u2028"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        assert sizes.text(text) == sizes.whole(text), repr(text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_matches_sql(spark, sf, name):
    import sys

    import duckdb

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
    from compare import rows_of

    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name in ORACLE:
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for f in os.listdir(sf):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
        cur = con.execute(ORACLE[name])
        assert got == rows_of([x[0] for x in cur.description], cur.fetchall())
