"""Several values packed in one field: infer the delimiters of each source, then split and explode with position.

Every candidate is scored per source and field over all texts that hold it outside quotes and parentheses:
*piece-count consistency* is the share of these texts that it cuts into at least two values and at least as many as any
other candidate does, so a mark inside names (``Routing & Switching``) or a rare stray falls behind the texts' real
delimiter; *type regularity* is the share of its pieces that begin like a value and are no longer than one.  Both are
drawn towards the figures of all sources by ``PRIOR`` texts' worth, and these towards a prior belief, so a source with few
texts leans on the others and no least number of texts decides.  A candidate that does not earn both bounds is not split at for that source and field.

What stands inside double quotes or parentheses is never divided; a slash divides only between blanks.

Defined cases: missing texts and texts of fewer than two values give no row; empty values take no position;
repeats are kept; a quote or parenthesis that never closes runs to the end of the text; list marks, outer blanks,
wrapping quotes and the brackets of a JSON-like list are removed; a cut-off last value stays as printed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postgrove.contract import known, trimmed
from postgrove.session import stored

#: name -> member of a character class.
DELIMITERS = {"comma": ",", "semicolon": ";", "pipe": "|", "line": r"\n\r", "tab": r"\t", "dot": "·", "bullet": "•▪", "colon": ":"}
#: Candidates that divide only between blanks.
SPACED = {"slash": "/", "ampersand": "&"}
CANDIDATES = [*DELIMITERS, *SPACED]
MIN_CONSISTENCY = 0.7
MIN_REGULARITY = 0.8
PRIOR = 10.0
#: What is thought of a candidate before any text: a colon or an ampersand mostly stands inside one value.
BELIEF, DOUBT, DOUBTED = 0.9, 0.3, ["colon", "ampersand"]

_RUNS = r'"[^"]*+(?:"|\z)|\((?:[^()]++|\([^()]*+\))*+(?:\)|\z)'
#: A regular piece begins like a value, after blanks, list marks or an opening quote, and has at most REGULAR_LENGTH characters.
_REGULAR = r'\A[\s •▪*"\[-]*+[\p{L}\p{N}.(]'
REGULAR_LENGTH = 90


def _pattern(chars: Column, spaced: Column) -> Column:
    """What one value may consist of: runs in quotes or parentheses, spaced marks where no blank stands on a side, other characters."""
    marks = "".join(SPACED.values())
    return F.concat(F.lit(rf"(?s)(?:{_RUNS}|"), spaced, F.lit("|[^"), chars, F.lit(rf'{marks}"(])++'))


def piece_pattern(names: list[str]) -> str:
    """The pattern of one value when the named delimiters divide."""
    chars = "".join(DELIMITERS[n] for n in names if n in DELIMITERS)
    spaced = "|".join(_spaced(c, n in names) for n, c in SPACED.items())
    return rf'(?s)(?:{_RUNS}|{spaced}|[^{chars}{"".join(SPACED.values())}"(])++'


def _spaced(c: str, divides: bool) -> str:
    return rf"{c}(?!\s)|(?<!\s){c}" if divides else c


def _outer(v: Column) -> Column:
    """Without outer blanks and the brackets of a JSON-like list."""
    return F.regexp_replace(trimmed(v), r"(?s)\A\[(.*?)\]?\z", "$1")


_OUTER = " \t\n\r\u00a0•▪"


def _items(pieces: Column) -> Column:
    """The values of the pieces: regular expressions run only where a first character calls for one."""

    mark = lambda x: F.when(
        x.rlike(r"\A[-*–—\d]"), F.btrim(F.regexp_replace(x, r"\A(?:[-*–—]+|\d{1,3}[.)])(?:[\s ]+|\z)", ""), F.lit(_OUTER))
    ).otherwise(x)
    unquoted = lambda x: F.when(x.rlike(r'\A"[^"]*"\z'), F.btrim(x, F.lit(_OUTER + '"'))).otherwise(x)
    # One transform a step: a lambda's argument is evaluated once, a nested expression as often as it is named.
    steps = F.transform(F.transform(F.transform(pieces, lambda x: F.btrim(x, F.lit(_OUTER))), mark), unquoted)
    return F.filter(steps, lambda x: F.length(x) > 0)


def long_form(df: DataFrame, key: str, source: Column, fields: list[str]) -> DataFrame:
    """(key, __source, field, __v): one row per known text."""
    texts = F.array(*[F.struct(F.lit(f).alias("field"), known(F.col(f).cast("string")).alias("v")) for f in fields])
    return (
        df.select(F.col(key), source.alias("__source"), F.explode(texts).alias("__x"))
        .select(F.col(key), "__source", F.col("__x.field").alias("field"), _outer(F.col("__x.v")).alias("__v"))
        .filter(F.col("__v").isNotNull())
    )


def infer_delimiters(texts: DataFrame) -> DataFrame:
    """(__source, field, name, support, consistency, regularity, accepted) of every candidate found; as many rows as sources x fields x candidates."""

    def stat(name: str) -> Column:
        # Only texts that hold the mark are cut, and count if it stands outside quotes and parentheses; the others give null.
        c = SPACED.get(name)
        held = F.col("__v").rlike(rf"\s{c}\s" if c else f"[{DELIMITERS[name]}]")
        pieces = F.regexp_extract_all(F.col("__v"), F.lit(piece_pattern([name])), 0)
        regular = lambda x: (F.length(x) <= REGULAR_LENGTH) & x.rlike(_REGULAR)
        # Each step is bound once inside a lambda: the pieces; the full ones where something was left out; [full, regular].
        cut = lambda p: F.when(F.length(F.array_join(p, "")) < F.length("__v"), F.filter(F.transform(p, trimmed), lambda x: F.length(x) > 0))
        score = lambda p: F.when(p.isNotNull(), F.array(F.size(p), F.size(F.filter(p, regular))))
        return F.when(held, F.transform(F.transform(F.array(pieces), cut), score)[0])

    per = texts.select("__source", "field", *[stat(n).alias(n) for n in CANDIDATES])
    most = F.greatest(*[F.coalesce(F.col(n)[0], F.lit(0)) for n in CANDIDATES])
    sums = [
        x
        for n in CANDIDATES
        for x in (
            F.count(F.col(n)).alias(f"{n}_held"), F.count_if((F.col(n)[0] > 1) & (F.col(n)[0] >= most)).alias(f"{n}_leads"),
            F.coalesce(F.sum(F.col(n)[0]), F.lit(0)).alias(f"{n}_pieces"), F.coalesce(F.sum(F.col(n)[1]), F.lit(0)).alias(f"{n}_regular"),
        )
    ]
    by = per.groupBy("__source", "field").agg(*sums)
    parts = ("held", "leads", "pieces", "regular")
    rows = by.select(
        "__source", "field", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), *[F.col(f"{n}_{k}").alias(k) for k in parts]) for n in CANDIDATES])).alias("s"),
    ).select("__source", "field", "s.*").filter("held > 0")
    from pyspark.sql import Window

    w = Window.partitionBy("name")  # over the aggregated rows only
    belief = F.when(F.col("name").isin(DOUBTED), DOUBT).otherwise(BELIEF)
    rate = lambda a, b: (F.col(a) + PRIOR * (F.sum(a).over(w) + PRIOR * belief) / (F.sum(b).over(w) + PRIOR)) / (F.col(b) + PRIOR)
    return rows.select("__source", "field", "name", F.col("held").alias("support"), rate("leads", "held").alias("consistency"), rate("regular", "pieces").alias("regularity")).withColumn(
        "accepted", (F.col("consistency") >= MIN_CONSISTENCY) & (F.col("regularity") >= MIN_REGULARITY)
    )


def split_packed(df: DataFrame, key: str, fields: list[str], source: Column | None = None) -> DataFrame:
    """(key, field, pos, item) of every text that holds two values or more.

    The inference is a job of its own over all rows; its result, a pattern for each source and field, is stored, so the
    planner knows its size and broadcasts it or joins it by key.
    """
    texts = long_form(df, key, F.coalesce(source, F.lit("")) if source is not None else F.lit(""), fields)
    accepted = infer_delimiters(texts).groupBy("__source", "field").agg(F.collect_set(F.when(F.col("accepted"), F.col("name"))).alias("__yes"))
    yes = lambda n: F.array_contains("__yes", n)
    chars = F.concat(*[F.when(yes(n), c).otherwise("") for n, c in DELIMITERS.items()])
    spaced = F.concat_ws("|", *[F.when(yes(n), _spaced(c, True)).otherwise(_spaced(c, False)) for n, c in SPACED.items()])
    patterns = stored(accepted.select("__source", "field", _pattern(chars, spaced).alias("__pattern")), "patterns")
    # A text without any candidate is one value and needs no pattern; equal patterns in a row are compiled once.
    pieces = F.regexp_extract_all(F.col("__v"), F.col("__pattern"), 0)
    # Bound once inside a lambda, so that the test of its size does not compute it again.
    many = F.transform(F.array(_items(pieces)), lambda i: F.when(F.size(i) > 1, i))[0]
    return (
        texts.join(patterns, ["__source", "field"]).select(F.col(key), "field", F.posexplode(many).alias("__p", "item"))
        .select(F.col(key), "field", (F.col("__p") + 1).cast("int").alias("pos"), "item")
    )
