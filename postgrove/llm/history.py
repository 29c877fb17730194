"""Deduplicating new batches against all history.

A record is a set of tokens (its ad key, or the word shingles of a text).  Minwise signatures are cut into bands, and a
band's hash is its key.  ``History`` keeps two tables in the shared folder: (bucket, band key, set key), partitioned by
bucket, and, where similarity short of equality counts, (bucket, set key, token set), partitioned by the set key's bucket.
``accept`` takes one batch: it collects the numbers of the buckets the batch falls into (at most ``buckets`` of them),
reads only these through a literal filter on the partition, verifies the candidates by the exact Jaccard similarity, and
appends the keys of the accepted records as new files.  Nothing of the history is read outside those buckets, and nothing
is rewritten.

Records with equal token sets are one *set row*, kept with the order of its earliest record, before any join.  So a hot
ad costs one row on either side however often it was seen, and no two records of one set are ever paired.

With ``threshold=1`` (the ad keys) equality of the sets is what counts; one band over the whole signature finds it.
Near-duplicates of texts use five-word shingles, 0.8 or more and 20 bands of 5 rows, which miss a pair of similarity 0.8
with a probability of 0.0004.

Defined cases: a record without tokens (null or empty) matches nothing and is never a duplicate, nor is it kept; a null
order value is earliest; ties in order go by id; repeated rows of one id are one record; an empty history or batch gives an
empty result; other columns of the inputs are ignored.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.contract import known
from postgrove.functions.source import site
from postgrove.session import stored

#: The host names of the three sites in the test tables.
HOSTS = {"lnkboard": "linkedin", "nkrjobs": "naukri", "indboard": "indeed"}


def ad_key(source: Column, job_id: Column, link: Column) -> Column:
    """``site:number`` of the ad, from the link if it holds one, else from the job id; null where neither does.

    The link comes first: a job id may be the scraper's substitute, which is a hash of the link.
    """
    url = F.lower(known(link))
    host = F.regexp_extract(url, r"^\s*https?://([^/?#]+)", 1)
    at = F.lit(None).cast("string")
    for name, where in HOSTS.items():
        at = F.when(host.contains(name), where).otherwise(at)
    number = (
        F.when(at == "linkedin", F.coalesce(_got(url, r"/jobs/view/(?:[^?#]*?-)?(\d{6,})/*(?:[?#]|$)"), _got(url, r"[?&]currentjobid=(\d{6,})(?:[&#]|$)")))
        .when(at == "naukri", _got(url, r"^[^?#]*-(\d{6,})/*(?:[?#]|$)"))
        .when(at == "indeed", _got(url, r"[?&]jk=([0-9a-f]{12,20})(?:[&#]|$)"))
    )
    from_link = F.when(number.isNotNull(), F.concat(at, F.lit(":"), number))
    bare = F.lower(known(job_id))
    named = _got(bare, r"(linkedin|naukri|indeed)")
    where = F.coalesce(site(source), named)
    bare = F.regexp_replace(bare, r"^\s*(?:(?:linkedin|naukri|indeed)[\s_:.-]*)*|\s+$", "")
    own = F.when(where == "indeed", _got(bare, r"^([0-9a-f]{12,20})$")).otherwise(_got(bare, r"^(\d{6,})$"))
    return F.coalesce(from_link, F.when(own.isNotNull(), F.concat(where, F.lit(":"), own)))


def _got(c: Column, pattern: str) -> Column:
    x = F.regexp_extract(c, pattern, 1)
    return F.when(x != "", x)


_WORD = re.compile(r"[^\W_]+")


class _Numbers(dict):
    """A piece of a text between blanks -> the numbers of its words."""

    def __missing__(self, piece: str) -> list[int]:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        self[piece] = out = [xxhash.xxh64_intdigest(w) for w in _WORD.findall(piece)]
        return out


def word_shingles(text: Column, words: int = 5) -> Column:
    """Distinct runs of five words, as sorted 32-bit numbers; a shorter text is one shingle, one without words has none."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def shingles(texts: pd.Series) -> pd.Series:
        numbers, out = _Numbers(), []
        for text_ in texts:
            held: list[int] = []
            for piece in text_.lower().split() if text_ else ():
                held += numbers[piece]
            each = np.array(held, dtype=np.uint64)
            size = min(words, len(each))
            mixed = np.zeros(max(0, len(each) - size + 1) if size else 0, dtype=np.uint64)
            for k in range(size):
                mixed = (mixed ^ each[k:k + len(mixed)]) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(31)
            mixed = np.sort((mixed >> np.uint64(32)).astype(np.uint32).view(np.int32))
            out.append(mixed[np.append(True, mixed[1:] != mixed[:-1])] if len(mixed) else mixed)
        return pd.Series(out)

    return shingles(text)


def band_keys(tokens: Column, bands: int, rows: int) -> Column:
    """array<bigint>: for each band the hash of its ``rows`` minwise values."""
    rng = np.random.default_rng(20_251)
    factor, shift = (rng.integers(1, 2**63, size=bands * rows, dtype=np.uint64) | np.uint64(1) for _ in range(2))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(sets: pd.Series) -> pd.Series:
        out = []
        for held in sets:
            x = np.asarray(held).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            least = np.full(bands * rows, np.uint64(2**64 - 1))
            for at in range(0, len(x), 4096):  # so that a very long text is not held as a wide table at once
                h = x[at:at + 4096, None] * factor + shift
                least = np.minimum(least, (h ^ (h >> np.uint64(29))).min(axis=0))
            mixed = np.arange(bands, dtype=np.uint64)
            for r in range(rows):
                mixed = (mixed ^ least.reshape(bands, rows)[:, r]) * np.uint64(0x94D049BB133111EB)
                mixed ^= mixed >> np.uint64(31)
            out.append(mixed.view(np.int64))
        return pd.Series(out)

    return keys(tokens)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_intersect(a, b))
    return n / (F.size(a) + F.size(b) - n)


_BANDS, _SETS = "set_key bigint, band bigint", "set_key bigint, tokens array<int>"


class History:
    """The accepted records' band keys and sets, in tables under ``path`` partitioned by bucket."""

    def __init__(self, spark: SparkSession, path: str, bands: int = 1, rows: int = 1, threshold: float = 1.0, buckets: int = 64):
        self.spark, self.path, self.bands, self.rows, self.threshold, self.buckets = spark, path, bands, rows, threshold, buckets
        self.exact = threshold >= 1

    def _bucket(self, c: str) -> Column:
        return F.pmod(F.col(c), F.lit(self.buckets)).cast("int")

    def _banded(self, sets: DataFrame) -> DataFrame:
        """(set_key, band, bucket): equal sets have one band, their own key; else the bands of the signature."""
        keys = F.array("set_key") if self.exact else band_keys(F.col("tokens"), self.bands, self.rows)
        return sets.select("set_key", F.explode(keys).alias("band")).withColumn("bucket", self._bucket("band"))

    def prepared(self, records: DataFrame, tokens: Column, key: str | None = None, order: list[Column] | None = None) -> DataFrame:
        """(key, at, set_key, tokens) of the records that have tokens; tokens are hashed and sorted."""
        short = (lambda t: F.xxhash64(t)) if self.exact else (lambda t: F.hash(t))  # 32 bits do for sets that are compared
        ready = not self.exact and records.select(tokens.alias("t")).dtypes[0][1] == "array<int>"  # as ``word_shingles`` makes them
        hashed = tokens if ready else F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: t.isNotNull()), short)))
        columns = [F.col(key), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order or [])], F.col(key).alias("k")).alias("at")] if key else []
        rows = records.select(*columns, hashed.alias("tokens")).filter(F.size("tokens") > 0)
        return rows.withColumn("set_key", F.xxhash64("tokens"))

    def _write(self, df: DataFrame, name: str, part: str) -> None:
        # Rebalanced by size, so a large bucket is written by several tasks and small ones share a task.
        df.withColumn("part", F.lit(part)).hint("rebalance", "bucket").write.mode("append").partitionBy("part", "bucket").parquet(f"{self.path}/{name}")

    def _keep(self, sets: DataFrame) -> None:
        """Append the sets and their bands as one part; the bands are made of the written sets, so these are made once."""
        part = uuid.uuid4().hex
        if not self.exact:
            self._write(sets.select("set_key", "tokens").withColumn("bucket", self._bucket("set_key")), "sets", part)
            sets = self._table("sets", _SETS).filter(F.col("part") == part)
        self._write(self._banded(sets), "bands", part)

    def append(self, records: DataFrame, tokens: Column) -> None:
        """Add the keys of accepted records."""
        self._keep(self.prepared(records, tokens).dropDuplicates(["set_key"]))

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema + ", part string, bucket int").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str, asked: DataFrame) -> DataFrame:
        """The table's rows in the buckets of ``asked``."""
        try:
            held = self._table(name, schema).drop("part")
        except Exception as error:  # nothing accepted yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema + ", bucket int")
        hit = sorted(r.bucket for r in asked.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        return held.filter(F.col("bucket").isin(hit)) if hit else held.limit(0)

    def bands_of(self, asked: DataFrame) -> DataFrame:
        return self._read("bands", _BANDS, asked)

    def _first(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The batch's sets, and (set_key, first, old): the earliest like record of the batch, and whether the history holds one."""
        sets = rows.groupBy("set_key").agg(F.min("at").alias("at"))
        if self.exact:
            sets = stored(sets, "batch-sets")
        else:  # the tokens stay in the stored batch; the row of the earliest order holds them
            sets = rows.join(stored(sets, "batch-sets"), ["set_key", "at"]).dropDuplicates(["set_key"]).select("set_key", "at", "tokens")
        mine = self._banded(sets) if self.exact else stored(self._banded(sets), "batch-bands")
        held = self.bands_of(mine)
        first = sets.select("set_key", F.col("at").alias("first"))
        if self.exact:
            old = mine.join(held, ["bucket", "band"], "left_semi").select("set_key", F.lit(True).alias("old"))
            return sets, first.join(old, "set_key", "left")
        tokens = sets.select(F.col("set_key").alias("a"), F.col("tokens").alias("ta"))
        like = lambda pairs, others: pairs.join(tokens, "a").join(others, "b").filter(jaccard(F.col("ta"), F.col("tb")) >= self.threshold)
        met = mine.select(F.col("set_key").alias("a"), "bucket", "band").join(held.select(F.col("set_key").alias("b"), "bucket", "band"), ["bucket", "band"]).select("a", "b").distinct()
        met = stored(met, "met-history")
        theirs = self._read("sets", _SETS, met.select(F.pmod("b", F.lit(self.buckets)).cast("int").alias("bucket")))
        old = like(met, theirs.select(F.col("set_key").alias("b"), F.col("tokens").alias("tb")).dropDuplicates(["b"])).select(F.col("a").alias("set_key"), F.lit(True).alias("old")).distinct()
        pairs = mine.select(F.col("set_key").alias("a"), "band").join(mine.select(F.col("set_key").alias("b"), "band"), "band").filter("a <> b").select("a", "b").distinct()
        near = like(pairs, sets.select(F.col("set_key").alias("b"), F.col("tokens").alias("tb"), F.col("at").alias("near"))).groupBy(F.col("a").alias("set_key")).agg(F.min("near").alias("near"))
        first = first.join(near, "set_key", "left").select("set_key", F.least("first", F.coalesce("near", "first")).alias("first"))
        return sets, first.join(old, "set_key", "left")

    def _seen(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        sets, first = self._first(rows)
        first = stored(first, "batch-first")
        seen = rows.join(first, "set_key").filter(F.coalesce("old", F.lit(False)) | (F.col("at") > F.col("first"))).select(key).distinct()
        fresh = sets.join(first, "set_key").filter(~F.coalesce("old", F.lit(False)) & (F.col("at") == F.col("first")))
        return seen, fresh

    def seen(self, batch: DataFrame, key: str, tokens: Column, order: list[Column]) -> DataFrame:
        """The keys of the batch's records that match the history or an earlier record of the batch."""
        return self._seen(stored(self.prepared(batch, tokens, key, order), "batch"), key)[0]

    def accept(self, batch: DataFrame, key: str, tokens: Column, order: list[Column]) -> DataFrame:
        """As ``seen``; the keys of the records that match nothing are added to the history."""
        seen, fresh = self._seen(stored(self.prepared(batch, tokens, key, order), "batch"), key)
        seen = stored(seen, "seen")
        self._keep(fresh)
        return seen
