"""Strict load with rejects, and packed fields, against plain readers of the same rules."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F, types as T

from postgrove.operators.packed import infer_delimiters, long_form, split_packed
from postgrove.operators.rejects import rejects, strict_load

GOOD = ["a_1", "s", "t", "c", "ci", "st", "co", "1", "2", "sk", "d", "sp", "2026-01-01", "https://x.example/1", "text"]


def line(values, quoted=()):
    return ",".join('"' + v.replace('"', '""') + '"' if i in quoted or any(c in v for c in ',"\n') else v for i, v in enumerate(values))


def reason(raw):
    """The rule, read by hand: a small state machine over the characters."""
    if raw is None:
        return "column_count"
    raw = raw.removeprefix("﻿")
    fields, i, n = [], 0, len(raw)
    while True:
        if i < n and raw[i] == '"':
            i, value = i + 1, ""
            while True:
                if i >= n:
                    return "quoting"
                if raw[i] == '"':
                    if raw[i + 1:i + 2] == '"':
                        value, i = value + '"', i + 2
                        continue
                    i += 1
                    break
                value, i = value + raw[i], i + 1
            if i < n and raw[i] != ",":
                return "quoting"
        else:
            j = raw.find(",", i)
            j = n if j < 0 else j
            value = raw[i:j]
            if '"' in value:
                return "quoting"
            i = j
        fields.append(value)
        if i >= n:
            break
        i += 1
    if not raw or len(fields) != 15:
        return "column_count"
    bad = any(c == "�" or (ord(c) < 32 and c not in "\t\n\r") or 127 <= ord(c) < 160 for c in fields[14])
    if not fields[0] or any(c.isspace() or c == ":" for c in fields[0]) or not fields[13].startswith(("http://", "https://")) or bad:
        return "invalid_value"
    return None


def make(rng):
    v = list(GOOD)
    kind = rng.randrange(12)
    if kind == 0:
        v.pop(rng.randrange(15))
    if kind == 1:
        v.insert(3, "more")
    if kind == 2:
        v[0] = rng.choice(["", "a b", "a:b"])
    if kind == 3:
        v[13] = rng.choice(["", "ftp://x", "Https://x"])
    if kind == 4:
        v[14] = "bad " + rng.choice(["�", "\x00", "\x07", "\x9f"])
    v[9] = rng.choice(["x", "a,b", 'say "hi"', "two\nlines", ""]) if len(v) > 9 else ""
    raw = line(v, {rng.randrange(15)})
    if kind == 5:
        raw = raw.replace(",", ',"', 1)
    if kind == 6:
        raw = raw.replace("text", 'te"xt')
    if kind == 7:
        raw = "﻿" + raw
    if kind == 8:
        raw += '"'
    return raw


def test_rejects_match_the_rule(spark):
    rng = random.Random(5)
    rows = [(i, make(rng)) for i in range(400)] + [(900, None), (901, ""), (902, "," * 14), (903, '""' + "," * 14), (904, line(GOOD, range(15)))]
    df = spark.createDataFrame(rows, "record_no bigint, raw_record string")
    got = {r.record_no: r.reason for r in rejects(df).collect()}
    assert got == {i: reason(raw) for i, raw in rows if reason(raw)}
    loaded = {r.record_no: r for r in strict_load(df).collect()}
    assert set(loaded) == {i for i, raw in rows if not reason(raw)}
    for i, r in loaded.items():
        want = next(csv.reader(io.StringIO(dict(rows)[i].removeprefix("﻿"), newline="")))
        assert list(r)[1:] == want


def test_rejects_long_records_clashing_names_and_empty(spark):
    long = line([*GOOD[:14], '"' * 200_000 + "x" * 2_000_000])
    df = spark.createDataFrame([(1, long, "keep"), (2, long + '"', "keep"), (2, long + '"', "keep")], "record_no bigint, raw_record string, source string")
    out = strict_load(df)
    assert "raw_source" in out.columns and out.collect()[0].raw_source == "keep"
    assert [(r.record_no, r.reason) for r in rejects(df).collect()] == [(2, "quoting")] * 2
    none = df.filter("false")
    assert rejects(none).count() == 0 and strict_load(none).count() == 0
    lost = spark.createDataFrame([(None, line(GOOD)), (None, "x")], "record_no bigint, raw_record string")
    assert [r.reason for r in rejects(lost).collect()] == ["column_count"]


@pytest.mark.parametrize("text, items", [
    ("a, b,, c ,", ["a", "b", "c"]),
    ('x; "y; z" ;w', ["x", "y; z", "w"]),
    ("Java (11, 17) | DNS/DHCP / R & D", ["Java (11, 17)", "DNS/DHCP", "R & D"]),
    ("1. SQL\n2) Hive\n- dbt", ["SQL", "Hive", "dbt"]),
    ("• one • two", ["one", "two"]),
    ('["p", "q, r", "s"]', ["p", "q, r", "s"]),
    ("a, b, Acc …", ["a", "b", "Acc …"]),
    ('a, "open, to the end', ["a", '"open, to the end']),
    ("tab\tline\r\nend", ["tab", "line", "end"]),
    ("a, a, a", ["a", "a", "a"]),
])
def test_packed_values(spark, text, items):
    df = spark.createDataFrame([(1, text)], "id bigint, skills string")
    assert [r.item for r in split_packed(df, "id", ["skills"]).orderBy("pos").collect()] == items


def test_packed_single_missing_empty_and_inference(spark):
    df = spark.createDataFrame([(1, "one"), (2, None), (3, " Not Specified "), (4, "")], "id bigint, skills string")
    assert split_packed(df, "id", ["skills"]).count() == 0
    assert split_packed(df.filter("false"), "id", ["skills"]).count() == 0
    # A source whose dots stand inside values: the dot is refused there, and the comma still divides.
    rows = [(i, "odd", f"v{i} ·—, w, u") for i in range(40)] + [(100 + i, "plain", "a · b") for i in range(40)]
    odd = spark.createDataFrame(rows, "id bigint, src string, skills string")
    got = split_packed(odd, "id", ["skills"], F.col("src")).groupBy("id").agg(F.max("pos").alias("n")).collect()
    assert {r.n for r in got if r.id >= 100} == {2} and {r.n for r in got if r.id < 100} == {3}


def test_a_delimiter_must_earn_its_place(spark):
    rows = [(i, "a", f"Alpha{i % 7} & Beta; Gamma{i % 5}; Delta & Rho; Tau") for i in range(60)]  # the ampersand stands inside names
    rows += [(1000 + i, "b", f"Alpha{i % 7} & Beta & Gamma") for i in range(60)]  # here it divides
    rows += [(2000 + i, "c", f"Smith, John{i % 9}; Doe; Roe; Poe") for i in range(60)]  # semicolons divide, commas are part of a name
    rows += [(3000 + i, "d", "One, two; " + "x" * 200 + "; " + "y" * 200) for i in range(3)] + [(4000, "a", "Alpha & Beta"), (4001, "e", "(a; b)"), (4002, None, "One; Two")]
    df = spark.createDataFrame(rows, "id int, src string, v string")
    texts = long_form(df, "id", F.coalesce("src", F.lit("")), ["v"])
    told = {(r["__source"], r["name"]): r.accepted for r in infer_delimiters(texts).collect()}
    assert told["a", "semicolon"] and not told["a", "ampersand"] and told["b", "ampersand"] and not told["c", "comma"] and told["c", "semicolon"]
    assert ("e", "semicolon") not in told and ("a", "tab") not in told and told["", "semicolon"]
    got = {}
    for r in sorted(split_packed(df, "id", ["v"], F.col("src")).collect(), key=lambda r: r.pos):
        got.setdefault(r.id, []).append(r.item)
    assert got[0] == ["Alpha0 & Beta", "Gamma0", "Delta & Rho", "Tau"] and got[1000] == ["Alpha0", "Beta", "Gamma"] and got[2000] == ["Smith, John0", "Doe", "Roe", "Poe"]
    assert 4000 not in got and 4001 not in got and got[4002] == ["One", "Two"]


def test_a_repeated_or_missing_offset_hides_nothing(spark):
    good, bad = line(GOOD), line(["a:1", *GOOD[1:]])
    df = spark.createDataFrame([(1, good), (1, bad), (1, good), (None, good), (None, bad), (2, "x,y"), (2, None)], "record_no int, raw_record string")
    got = sorted(((r.record_no, r.reason) for r in rejects(df).collect()), key=str)
    assert got == sorted([(1, "invalid_value"), (None, "invalid_value"), (2, "column_count"), (2, "column_count")], key=str)
