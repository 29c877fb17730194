"""Keyword-stuffed and link-list pages, by their rank-frequency curves.

For every page the words are ranked by frequency and a line is fitted to log frequency over log rank: its slope and
residual describe how the page repeats itself.  The curve's *divergence* from prose is the share of its mass on words
that the prose of the page's own language does not use.  All three are judged as distances from prose of the same
language and a comparable length (doubling buckets of the word count, ``expected``), the page itself left out.

Prose and its vocabulary are found in the data: words in ``COMMON`` or more of a language's pages are common; pages of
which ``PROSE`` or more is common words are prose; their words of enough pages are the language's vocabulary.  The
language of a page is the one whose common words cover most of it, since the declared one is often wrong.

A page is spam if its divergence, slope or residual alone is extreme, or if its divergence is high while its slope or
residual is: lists of names diverge but do not repeat themselves, insistent speeches repeat themselves in the words of
prose.  A genuine passage in a spam page lowers the divergence only by its share.  In a short page a few words decide the
share, so the distance is measured in units that widen as the page gets shorter; pages of any length are judged.

Each text is read once: a page's counts, slope and residual come from one pass over Arrow batches, where the page's own
counts are sorted (a window over all words of all pages would shuffle each of them), and stay with the page as one array
of hashed words and one of counts.  Every later step is an aggregate over these arrays.  Common words are at most
(mean distinct words of a page) / COMMON, the vocabulary at most that over VOCABULARY_SHARE, by counting.

Defined cases: null and blank texts and those without a word are never spam; a language without prose has no vocabulary,
so nothing diverges from it; ties in rank change nothing, as their frequencies are equal; repeated rows of an id are judged
each, and the id is named once if one is spam; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from postgrove.session import stored

COMMON = 0.05
PROSE = 0.6
PROSE_WORDS = 20
VOCABULARY_SHARE = 0.0002
#: Distances beyond which a page is spam: of the divergence alone or beside a curve unlike prose, and of the curve alone.
EXTREME, MIXED = 6.0, 2.5
STEEP, ROUGH = 0.5, 3.0
ALONE = 12.0
#: The least units of the distances.
SLOPE_UNIT, RESIDUAL_UNIT, DIVERGENCE_UNIT = 0.05, 0.02, 0.1
#: How much less prose counts in the statistics of a length for each doubling it is away.
FAR = 0.1

CURVE = ["slope", "residual", "divergence"]

#: Spellings of the three languages.
LANGUAGES = {"en": "en", "eng": "en", "de": "de", "ger": "de", "deu": "de", "fr": "fr", "fre": "fr", "fra": "fr"}
NAMES = sorted(set(LANGUAGES.values()))
WORD_BITS = 40

_WORD = re.compile(r"[^\W\d_]+|\d+")


def language(c: Column) -> Column:
    v = F.lower(F.trim(c))
    out = F.lit(None).cast("string")
    for code, name in LANGUAGES.items():
        out = F.when(v == code, name).otherwise(out)
    return out


class Numbers(dict):
    """A piece of a text -> the 40-bit numbers of its words; every number is one word."""

    def __missing__(self, piece: str) -> list[int]:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        plain = piece if piece.isascii() else unicodedata.normalize("NFC", piece)
        self[piece] = out = [xxhash.xxh64_intdigest("#" if w.isdigit() else w) & (2**WORD_BITS - 1) for w in _WORD.findall(plain)]
        return out


def curves(f: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(slope, residual) of each row's counts; a positive slope is steep, and a flat or single-word curve has 0."""
    held = np.sort((row << 32) | (2**32 - 1 - f))  # by row, the most frequent first
    row, f = held >> 32, 2**32 - 1 - (held & 0xFFFFFFFF)
    start = np.searchsorted(row, np.arange(rows))
    x, y = np.log(np.arange(len(row)) - start[row] + 1.0), np.log(f.astype(float))
    total = lambda v: np.bincount(row, weights=v, minlength=rows)
    n = np.maximum(total(np.ones(len(row))), 1.0)
    xx, xy, yy = total(x * x) - total(x) ** 2 / n, total(x * y) - total(x) * total(y) / n, total(y * y) - total(y) ** 2 / n
    steep = np.where(xx > 1e-12, -xy / np.maximum(xx, 1e-12), 0.0)
    rest = np.where(xx > 1e-12, yy - xy * xy / np.maximum(xx, 1e-12), 0.0) / n
    return steep + 0.0, np.sqrt(np.maximum(rest, 0.0))


def page_counts(pages: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, lg, n, v, slope, residual, words, counts) of every page that has a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                words, size = [], []
                for t in batch.column("__t").to_pylist():
                    before = len(words)
                    for piece in t.lower().split():
                        words += numbers[piece]
                    size.append(len(words) - before)
                size = np.array(size, dtype=np.int64)
                each = np.sort((np.repeat(np.arange(len(size)), size) << WORD_BITS) | np.array(words, dtype=np.int64))
                new = np.flatnonzero(np.append(True, each[1:] != each[:-1])) if len(each) else np.zeros(0, dtype=np.int64)
                f, row = np.diff(np.append(new, len(each))), each[new] >> WORD_BITS
                slope, residual = curves(f, row, len(size))
                distinct = np.bincount(row, minlength=len(size))
                offsets = pa.array(np.append(0, np.cumsum(distinct)), pa.int32())
                columns = {
                    key: batch.column(key), "lg": batch.column("lg"), "n": pa.array(size), "v": pa.array(distinct.astype(np.int64)), "slope": pa.array(slope), "residual": pa.array(residual),
                    "words": pa.ListArray.from_arrays(offsets, pa.array(each[new] & (2**WORD_BITS - 1), pa.int64())), "counts": pa.ListArray.from_arrays(offsets, pa.array(f, pa.int32())),
                }
                yield pa.RecordBatch.from_pydict(columns).filter(pa.array(size > 0))

    kind = dict(pages.dtypes)[key]
    known = pages.select(F.col(key), language(F.col(lang)).alias("lg"), F.col(text).alias("__t")).filter("__t IS NOT NULL")
    return known.mapInArrow(count, f"`{key}` {kind}, lg string, n bigint, v bigint, slope double, residual double, words array<bigint>, counts array<int>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, count, row) of all words of a batch."""
    words = batch.column("words")
    row = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy(zero_copy_only=False)))
    return words.flatten().to_numpy(zero_copy_only=False), batch.column("counts").flatten().to_numpy(zero_copy_only=False), row


def _tally(codes: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """(lc, word, d): how often each word stands beside each language's number."""
    each = np.sort((codes << WORD_BITS) | words)
    new = np.flatnonzero(np.append(True, each[1:] != each[:-1])) if len(each) else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_pydict({"lc": pa.array(each[new] >> WORD_BITS, pa.int64()), "word": pa.array(each[new] & (2**WORD_BITS - 1), pa.int64()), "d": pa.array(np.diff(np.append(new, len(each))), pa.int64())})


def _has(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each word stands in a sorted table."""
    return table[np.minimum(np.searchsorted(table, words), len(table) - 1)] == words if len(table) else np.zeros(len(words), dtype=bool)


def _spoken(batch: pa.RecordBatch, common: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(language's number, whether it is prose) of each page."""
    words, f, row = _flat(batch)
    n = batch.column("n").to_numpy(zero_copy_only=False)
    covered = np.stack([np.bincount(row, weights=np.where(_has(c, words), f, 0), minlength=len(n)) for c in common])
    return covered.argmax(axis=0), (covered.max(axis=0) >= PROSE * n) & (n >= PROSE_WORDS)


def expected(fitted: DataFrame) -> DataFrame:
    """(lang, bucket, w, and the weighed sums a_, q_ of slope, residual, divergence and their squares): prose of each language and length.

    A bucket's sums are those of all buckets, weighed by ``FAR`` for each doubling between, so lengths with little prose
    lean on their neighbours.  Languages x buckets: some sixty rows, whatever the input.
    """
    own = fitted.filter("prose").groupBy("lang", "bucket").agg(
        F.count("*").alias("c"), *[F.sum(x).alias(f"a_{x}") for x in CURVE], *[F.sum(F.col(x) * F.col(x)).alias(f"q_{x}") for x in CURVE]
    )
    asked = fitted.groupBy("lang", F.col("bucket").alias("b")).agg(F.lit(1).alias("one")).drop("one")
    near = asked.join(F.broadcast(own), "lang").withColumn("w", F.pow(F.lit(FAR), F.abs(F.col("b") - F.col("bucket"))))
    return near.groupBy("lang", F.col("b").alias("bucket")).agg(F.sum(F.col("w") * F.col("c")).alias("w"), *[F.sum(F.col("w") * F.col(f"{k}_{x}")).alias(f"{k}_{x}") for k in "aq" for x in CURVE])


def _distance(x: str, unit: Column, by_length: bool = True) -> Column:
    """How many units the page lies above the other prose; 0 where there is no other.

    The unit is the spread of that prose; for what changes ``by_length`` it is wider where little prose is near.
    """
    own = F.col("prose").cast("int")
    w = F.col("w") - own
    mean = (F.col(f"a_{x}") - own * F.col(x)) / w
    spread_ = F.sqrt(F.greatest(F.lit(0.0), (F.col(f"q_{x}") - own * F.col(x) * F.col(x)) / w - mean * mean))
    return F.when(w > 1e-9, (F.col(x) - mean) / (F.greatest(spread_, unit) * ((1 + 1 / F.sqrt(w)) if by_length else F.lit(1.0)))).otherwise(0.0)


def score_pages(pages: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, lang, n, v, slope, residual, divergence, steep, rough, odd, spam) of every page that has a word."""
    counts = stored(page_counts(pages, key, text, lang), "page-counts")
    declared = counts.filter("lg IS NOT NULL")
    in_lang = {r.lg: r["n"] for r in declared.groupBy("lg").agg(F.count("*").alias("n")).collect()}  # a row for each language

    def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, row = _flat(batch)
            yield _tally(np.array([NAMES.index(x) for x in batch.column("lg").to_pylist()], dtype=np.int64)[row], words)

    tallied = lambda df, f: df.mapInArrow(f, "lc bigint, word bigint, d bigint").groupBy("lc", "word").agg(F.sum("d").alias("d"))
    least = lambda by, share, few: F.element_at(F.array(*[F.lit(max(few, share * by.get(i, 0))) for i in range(len(NAMES))]), (F.col("lc") + 1).cast("int"))
    sets = lambda rows: [np.array(sorted(r.word for r in rows if r.lc == i), dtype=np.int64) for i in range(len(NAMES))]
    named = {NAMES.index(k): n for k, n in in_lang.items()}
    common = sets(tallied(declared.select("lg", "words", "counts"), by_language).filter(F.col("d") >= least(named, COMMON, 3.0)).collect())

    def of_prose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, prose = _spoken(batch, common)
            words, _, row = _flat(batch)
            mine = prose[row]
            # Word 0 counts the pages.
            yield _tally(np.append(code[row[mine]], code[prose]), np.append(words[mine], np.zeros(prose.sum(), dtype=np.int64)))

    prose_words = stored(tallied(counts.select("n", "words", "counts"), of_prose), "prose-words")
    in_prose = {r.lc: r.d for r in prose_words.filter("word = 0").collect()}
    vocabulary = sets(prose_words.filter((F.col("word") != 0) & (F.col("d") >= least(in_prose, VOCABULARY_SHARE, 2.0))).collect())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, prose = _spoken(batch, common)
            words, f, row = _flat(batch)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            known = np.zeros(len(words), dtype=bool)
            for i, table in enumerate(vocabulary):
                mine = code[row] == i
                known[mine] = _has(table, words[mine]) if len(table) else True
            strange = np.bincount(row, weights=np.where(known, 0, f), minlength=len(n)) / np.maximum(n, 1)
            columns = {x: batch.column(x) for x in (key, "n", "v", "slope", "residual")}
            yield pa.RecordBatch.from_pydict(columns | {"lang": pa.array([NAMES[i] for i in code], pa.string()), "prose": pa.array(prose), "divergence": pa.array(strange)})

    kind = dict(pages.dtypes)[key]
    fitted = counts.drop("lg").mapInArrow(judge, f"`{key}` {kind}, n bigint, v bigint, slope double, residual double, lang string, prose boolean, divergence double")
    fitted = stored(fitted.withColumn("bucket", F.floor(F.log2("n")).cast("int")), "page-curves")
    out = fitted.join(F.broadcast(expected(fitted)), ["lang", "bucket"], "left")
    out = out.withColumn("steep", _distance("slope", F.lit(SLOPE_UNIT))).withColumn("rough", _distance("residual", F.lit(RESIDUAL_UNIT)))
    out = out.withColumn("odd", _distance("divergence", F.greatest(F.lit(DIVERGENCE_UNIT), 0.6 / F.sqrt("n")), by_length=False))
    out = out.na.fill(0.0, ["steep", "rough", "odd"])
    spam = (F.col("odd") > EXTREME) | (F.greatest("steep", "rough") > ALONE) | ((F.col("odd") > MIXED) & ((F.col("steep") > STEEP) | (F.col("rough") > ROUGH)))
    return out.select(key, "lang", "n", "v", "slope", "residual", "divergence", "steep", "rough", "odd", spam.alias("spam"))


def spam_pages(pages: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    return score_pages(pages, key, text, lang).filter("spam").select(key).distinct()
