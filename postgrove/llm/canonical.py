"""Mapping free-entered values to a canonical list.

``similarity_join`` is a prefix-filter set-similarity join: the tokens of both sides are put in one order, rare ones
first over all rows of both sides; two sets of Jaccard ``t`` or more must share a token within their first
``n - ceil(t n) + 1`` tokens, so only these are joined; the length and positional filters drop most candidates and the
exact Jaccard decides.  ``map_places`` looks up places with it: the sets are the bigrams of a word in a plain spelling,
the candidates are verified by edit distance, and the best is kept.

Only distinct texts take part, so a value that fills a third of the rows costs as much as a rare one.  The token
counts and the list are stored once and broadcast only if their bytes are few; a longer list is joined by key.

Defined cases: missing values give no row; a value equal to an entry in city and state gives none either; a value
with nothing close gives id 0; ties go to the entry whose state agrees, then to the more similar, then to the smaller id;
words longer than any entry could be are passed over; rows keep their multiplicity by ``key``; an empty list maps all to 0.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postgrove.contract import known
from postgrove.session import bounded, stored

THRESHOLD = 0.25

#: Postal abbreviations of the states.
STATE_CODES = {
    "andhra pradesh": "ap", "bihar": "br", "gujarat": "gj", "haryana": "hr", "jharkhand": "jh", "karnataka": "ka",
    "kerala": "kl", "madhya pradesh": "mp", "maharashtra": "mh", "odisha": "od", "punjab": "pb", "rajasthan": "rj",
    "tamil nadu": "tn", "telangana": "tg", "uttar pradesh": "up", "west bengal": "wb",
}
#: Letters with marks and the plain letters they stand for.
MARKED = "āáàâäãåăąçćčďēéèêëěęğīíìîïłñńňōóòôöõőøŕřśšşťţūúùûüůűýÿžźż"
PLAIN = "aaaaaaaaacccdeeeeeeegiiiiilnnnoooooooorrsssttuuuuuuuyyzzz"


def plain_words(c: Column) -> Column:
    """Lower-case text of letters and blanks: marks, zero-width characters and glued capitals undone."""
    t = F.regexp_replace(c, r"[\x{200B}-\x{200F}\x{2060}\x{FEFF}\x{00AD}\p{Mn}]", "")
    t = F.regexp_replace(t, r"(\p{Ll})(\p{Lu}\p{Ll})", "$1 $2")
    t = F.translate(F.lower(t), MARKED, PLAIN)
    t = F.regexp_replace(t, r"(?<=\p{L})[-'’](?=\p{L})", "")
    t = F.regexp_replace(t, r"[^\p{L}]+", " ")
    # A name spelt letter by letter.
    return F.trim(F.when(t.rlike(r"^\s*(?:\p{L} ){2,}\p{L}\s*$"), F.replace(t, F.lit(" "), F.lit(""))).otherwise(t))


def squeezed(c: Column) -> Column:
    """One spelling for long vowels and doubled letters."""
    t = F.replace(F.replace(c, F.lit("ee"), F.lit("i")), F.lit("oo"), F.lit("u"))
    return F.regexp_replace(t, r"(\p{L})\1+", "$1")


def bigrams(c: Column) -> Column:
    t = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substr(t, i, F.lit(2))))


def similarity_join(left: DataFrame, right: DataFrame, key: str, other: str, tokens: str, threshold: float) -> DataFrame:
    """(key, other, jaccard) of all pairs of the sets in ``tokens`` with Jaccard of ``threshold`` or more.

    Keys must be distinct; empty sets match nothing.
    """
    counts = left.select(F.explode(tokens).alias("__t")).unionAll(right.select(F.explode(tokens).alias("__t"))).groupBy("__t").agg(F.count("*").alias("__f"))
    counts = bounded(counts)

    def prefixed(df: DataFrame, k: str, tag: str) -> DataFrame:
        each = df.select(F.col(k), F.explode(tokens).alias("__t")).join(counts, "__t")
        order = each.groupBy(k).agg(F.sort_array(F.collect_list(F.struct("__f", "__t"))).alias("__s"))
        sets = order.select(k, F.col("__s.__t").alias(f"__{tag}s"), F.size("__s").alias(f"__{tag}n"))
        length = F.col(f"__{tag}n") - F.ceil(F.col(f"__{tag}n") * threshold).cast("int") + 1
        return sets.select("*", F.posexplode(F.slice(f"__{tag}s", F.lit(1), length)).alias(f"__{tag}i", "__t"))

    a, b = prefixed(left, key, "a"), prefixed(right, other, "b")
    need = F.ceil((F.col("__an") + F.col("__bn")) * (threshold / (1 + threshold)) - 1e-9)
    rest = 1 + F.least(F.col("__an") - F.col("__ai") - 1, F.col("__bn") - F.col("__bi") - 1)
    lengths = (F.col("__an") >= F.col("__bn") * threshold - 1e-9) & (F.col("__bn") >= F.col("__an") * threshold - 1e-9)
    # A pair is met first at the first token both prefixes share; only there does the positional bound hold.
    met = a.join(bounded(b), "__t").filter(lengths & (rest >= need))
    pairs = met.groupBy(key, other).agg(F.first("__as").alias("__as"), F.first("__bs").alias("__bs"))
    same = F.size(F.array_intersect("__as", "__bs"))
    return pairs.withColumn("jaccard", same / (F.size("__as") + F.size("__bs") - same)).filter(F.col("jaccard") >= threshold).select(key, other, "jaccard")


def edits(a: str, b: str, most: int = 4) -> int:
    """Edit distance in which a swap of neighbours is one step; ``most + 1`` if it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        before, above = above, row
    return min(above[-1], most + 1)


def allowed(length: int) -> int:
    """The edits a name of this length may be away."""
    return 1 if length <= 5 else 2 if length < 10 else 3


def _state_fit(state: str, given: str, text: str) -> int:
    """0 if the words given for the state name this one, 1 if none is given, 2 if they name another."""
    words = [w for w in (given or "").split() if w != "india"]
    code = STATE_CODES.get(state, "")
    for source in (words, (text or "").split()):
        joined = "".join(source)
        if not joined:
            continue
        bare = state.replace(" ", "")
        if code in source or joined == bare or edits(joined.replace("india", ""), bare) <= 2 or bare in joined:
            return 0
        if source is words:
            return 2
    return 1


@F.pandas_udf(T.StructType([T.StructField("far", T.IntegerType()), T.StructField("fit", T.IntegerType())]))
def _judge(word: pd.Series, name: pd.Series, state: pd.Series, given: pd.Series, text: pd.Series) -> pd.DataFrame:
    out, seen = [], {}
    for w, n, s, g, t in zip(word, name, state, given, text):
        far = seen.get((w, n))
        if far is None:
            sw, sn = _squeeze(w), _squeeze(n)
            far = min(edits(w, n), edits(sw, sn))
            if len(w) >= 5 and n.startswith(w) and 2 * len(w) >= len(n):
                far = min(far, 1)  # cut short
            if far > allowed(len(n)):
                far = 99
            seen[(w, n)] = far
        out.append((far, _state_fit(s, g, t) if far < 99 else 9))
    return pd.DataFrame(out, columns=["far", "fit"])


def _squeeze(text: str) -> str:
    text, out = text.replace("ee", "i").replace("oo", "u"), []
    for c in text:
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


def map_places(rows: DataFrame, places: DataFrame, key: str, city: str = "city", state: str = "state") -> DataFrame:
    """(key, city_id) of every row whose city is known and whose (city, state) is not literally an entry's."""
    entries = places.select("city_id", F.col("city").alias("__c"), F.col("state").alias("__s"), "other_names")
    literal = entries.select("__c", "__s").distinct()
    asked = rows.select(F.col(key), F.col(city).alias("__city"), F.col(state).alias("__state")).filter(known(F.col("__city")).isNotNull())
    asked = asked.join(literal, (F.col("__city") == F.col("__c")) & (F.col("__state") == F.col("__s")), "left_anti")
    texts = asked.groupBy("__city", F.coalesce("__state", F.lit("")).alias("__given")).agg(F.lit(1).alias("__one")).drop("__one")

    spelt = entries.select("city_id", F.lower("__s").alias("__s"), F.explode(F.array_compact(F.array("__c", "other_names"))).alias("__n"))
    spelt = spelt.select("city_id", "__s", F.replace(plain_words(F.col("__n")), F.lit(" "), F.lit("")).alias("__name")).filter(F.length("__name") > 0).distinct()
    names = spelt.select("__name").distinct().select("__name", bigrams(squeezed(F.col("__name"))).alias("__b"))
    longest = (names.agg(F.max(F.length("__name"))).first()[0] or 0) + 4

    # Words that spell a state of the list are no place name ("West Bengal" is not a cut-off Bengaluru).
    states = sorted(r[0] for r in entries.select(F.lower("__s")).distinct().collect() if r[0])  # of the list, which has many places a state
    plain = plain_words(F.col("__city"))
    if states:
        spelt_states = "|".join(sorted({x for n in [*states, *STATE_CODES] for x in (re.escape(n), re.escape(n.replace(" ", "")))}))
        bare = F.trim(F.regexp_replace(plain, rf"\b(?:{spelt_states})(?: ?india)?\b", " "))
    else:
        bare = plain
    # Runs of as many words as the longest name has, and of two for a name typed in pieces.
    most = max(2, entries.select(F.explode(F.array_compact(F.array("__c", "other_names"))).alias("n")).agg(F.max(F.size(F.split(plain_words(F.col("n")), " ")))).first()[0] or 0)
    run = lambda ws, k: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(ws) - k + 1)), lambda i: F.array_join(F.slice(ws, i, k), ""))
    windows = lambda ws: F.flatten(F.array(*[run(ws, k) for k in range(1, most + 1)]))
    words = texts.select("__city", "__given", plain.alias("__plain"), bare.alias("__bare")).select(
        "__city", "__given", "__plain", F.explode(F.array_distinct(windows(F.split("__bare", r" +")))).alias("__w")
    ).filter((F.length("__w") > 0) & (F.length("__w") <= longest))
    words = stored(words, "asked-words")
    asked_words = words.select("__w").distinct().select("__w", bigrams(squeezed(F.col("__w"))).alias("__b"))
    close = similarity_join(asked_words, names, "__w", "__name", "__b", THRESHOLD)
    near = words.join(close, "__w").join(bounded(spelt), "__name")
    given = plain_words(F.coalesce(known(F.col("__given")), F.lit("")))
    # What the city text says beside the word itself may name a state.
    beside = F.trim(F.regexp_replace(F.concat(F.lit(" "), F.col("__plain"), F.lit(" ")), F.concat(F.lit(" "), F.col("__w"), F.lit(" ")), " "))
    judged = near.withColumn("__j", _judge("__w", "__name", "__s", given, beside)).filter(F.col("__j.far") < 99)
    best = judged.groupBy("__city", "__given").agg(F.min(F.struct("__j.far", "__j.fit", (-F.col("jaccard")).alias("j"), "city_id")).alias("__best"))
    return (
        asked.select(F.col(key), "__city", F.coalesce("__state", F.lit("")).alias("__given"))
        .join(best, ["__city", "__given"], "left").select(F.col(key), F.coalesce("__best.city_id", F.lit(0)).alias("city_id"))
    )
