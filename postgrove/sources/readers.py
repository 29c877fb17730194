"""Readers and writers: CSV contracts, JSON-LD in pages, JSON state, URLs to search, keyed tables on Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postgrove.contract import CSV_FIELDS, ns

CONTRACT = T.StructType([T.StructField(n, T.StringType()) for n in CSV_FIELDS])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CONTRACT) -> DataFrame:
    """RFC 4180 with a header, quoted line breaks, a byte-order mark; the schema is given, never inferred."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema=schema, enforceSchema=True, encoding="UTF-8")


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType = CONTRACT) -> DataFrame:
    """Line by line: short rows are dropped, empty cells become the placeholder."""
    df = spark.read.csv(path, header=True, schema=schema, mode="DROPMALFORMED")
    return df.select(*[ns(F.col(c)).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=quote_all, lineSep="\r\n" if not quote_all else "\n")


def read_json_state(spark: SparkSession, path: str) -> DataFrame:
    """(value): the strings of a JSON array file; a corrupt or missing file gives none."""
    try:
        text = spark.read.text(path, wholetext=True)
        return text.select(F.explode(F.from_json("value", "array<string>")).alias("value")).filter("value IS NOT NULL AND trim(value) <> ''").distinct()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "value string")


def json_ld(html: Column) -> Column:
    """array<string> of the JSON-LD records of a page; arrays and @graph are flattened, broken JSON is skipped."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    sound = F.filter(F.transform(scripts, lambda x: F.trim(x)), lambda x: F.try_parse_json(x).isNotNull())
    items = lambda x: F.when(x.startswith("["), F.from_json(x, "array<string>")).when(F.get_json_object(x, "$['@graph']").isNotNull(), F.from_json(F.get_json_object(x, "$['@graph']"), "array<string>")).otherwise(F.array(x))
    return F.flatten(F.transform(sound, items))


def json_ld_skills(record: Column, most: int = 30) -> Column:
    """Skills of a record: an array or a delimited text, repeats dropped, ``most`` at the utmost."""
    raw = F.get_json_object(record, "$.skills")
    parts = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.split(raw, r"[,;|]"))
    return F.slice(F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")), 1, most)


def json_ld_years(record: Column) -> Column:
    """Years of a record's monthsOfExperience; more than a hundred are refused."""
    months = F.coalesce(F.get_json_object(record, "$.experienceRequirements.monthsOfExperience"), F.get_json_object(record, "$.monthsOfExperience")).try_cast("double")
    return F.when(months / 12 <= 100, F.round(months / 12, 2))


def card_field(html: Column, *patterns: str) -> Column:
    """The first non-empty capture over ordered patterns."""
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns])


def search_url(base: str, keyword: Column, place: Column, page: Column) -> Column:
    slug = lambda c: F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.concat(F.lit(base.rstrip("/") + "/"), slug(keyword), F.lit("-jobs-in-"), slug(place), F.when(page > 1, F.concat(F.lit("-"), page.cast("string"))).otherwise(""), F.lit("?k="), F.url_encode(keyword))


def age_bucket(hours: Column) -> Column:
    """The site's age filter for a window in hours."""
    return F.when(hours <= 24, 1).when(hours <= 72, 3).when(hours <= 168, 7).when(hours <= 360, 15).otherwise(30)


class KeyedTable:
    """A Parquet table by key: append, upsert, mirror.

    Every write adds a folder of files; a manifest for each version names the folders that make it up.  So an append
    writes only its own rows, and a reader sees the version whose manifest is there, never half of a write.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType = CONTRACT):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema

    def _fs(self):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _version(self) -> int:
        fs, path = self._fs()
        at = path(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n[1:]) for n in names if n[:1] == "m"), default=0)

    def folders(self) -> list[str]:
        """The folders of the present version."""
        v = self._version()
        return sorted(r.value for r in self.spark.read.text(f"{self.path}/m{v}").collect()) if v else []

    def read(self) -> DataFrame:
        held = self.folders()
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in held]) if held else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame, beside: list[str]) -> None:
        """The rows as one more folder, and a version of it and the folders ``beside``."""
        fs, path = self._fs()
        folder, v = f"rows-{uuid.uuid4().hex}", self._version() + 1
        df.select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        draft = path(f"{self.path}/.m{v}-{folder}")
        out = fs.create(draft)
        out.writeBytes("\n".join([*beside, folder]) + "\n")
        out.close()
        if not fs.rename(draft, path(f"{self.path}/m{v}")):
            raise RuntimeError(f"another writer made version {v}")

    def append(self, rows: DataFrame, order: list[Column]) -> int:
        """Rows with a key, the first of each key in the batch; earlier versions are not looked at.  Returns rows added."""
        from postgrove.operators.pipeline import first_occurrence

        kept = first_occurrence(rows.filter(F.length(F.trim(F.col(self.key))) > 0), [self.key], order)
        n = kept.count()
        if n:
            self._write(kept, self.folders())
        return n

    def upsert(self, rows: DataFrame) -> None:
        from postgrove.operators.pipeline import upsert

        self._write(upsert(self.read(), rows.select(*self.schema.names), self.key), [])

    def mirror(self, rows: DataFrame) -> dict[str, int]:
        """The table becomes the rows; returns how many were inserted, updated, deleted, kept."""
        from postgrove.operators.pipeline import mirror

        counts = {r.action: r.n for r in mirror(self.read(), rows, self.key).groupBy("action").agg(F.count("*").alias("n")).collect()}
        self._write(rows, [])
        return counts

    def reset(self) -> None:
        fs, path = self._fs()
        fs.delete(path(self.path), True)


def clean_record_gate(df: DataFrame) -> DataFrame:
    """Records fit to be stored: an id without colon or blank, an absolute link; nulls become the placeholder."""
    ok = (F.length(F.trim("job_id")) > 0) & ~F.col("job_id").rlike(r"[:\s]") & F.col("link").rlike(r"^https?://")
    return df.filter(ok).select(*[ns(F.col(c)).alias(c) if dict(df.dtypes)[c] == "string" else F.col(c) for c in df.columns])


def archive_batch(df: DataFrame, path: str, at_utc: Column, domain: str) -> None:
    """A batch into its day's folder (India's date), behind what that day already holds; repeats of a job are left out."""
    from postgrove.functions.timeparse import ist_stamp

    stamped = df.withColumns({"extracted_at_utc": at_utc, "extracted_at_ist": ist_stamp(at_utc), "domain": F.lit(domain)}).withColumn("date_ist", F.to_date("extracted_at_ist"))
    spark = df.sparkSession
    try:
        held = spark.read.parquet(path).select("job_id", "date_ist").distinct()
        stamped = stamped.join(held, ["job_id", "date_ist"], "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    stamped.dropDuplicates(["job_id"]).write.mode("append").partitionBy("date_ist").parquet(path)
