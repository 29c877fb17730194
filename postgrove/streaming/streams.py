"""Structured Streaming forms: deduplication against all that was seen, tumbling windows, late data, a work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def file_stream(spark: SparkSession, path: str, schema, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def seen_dedup(stream: DataFrame, key: str, at: str | None = None, within: str | None = None) -> DataFrame:
    """Each key once; with a bound in time the state is dropped behind the watermark."""
    if at and within:
        return stream.withWatermark(at, within).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def tumbling(stream: DataFrame, at: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts for each window; rows later than ``late`` behind the newest are not counted."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def run_to_end(stream: DataFrame, checkpoint: str, mode: str = "append", sink: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """All that is there now, then stop; the result as a table.

    In ``update`` mode every batch gives the rows it changed, and the last row of each of the ``keys`` is the result, so the
    watermark may drop state behind it and no batch gives the whole table again.
    """
    import uuid

    spark = stream.sparkSession
    if sink:
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(sink)
    names, out = list(stream.columns), f"{checkpoint}/out-{uuid.uuid4().hex}"
    schema = T.StructType([*stream.schema.fields, T.StructField("__n", T.LongType())])

    def keep(batch: DataFrame, n: int) -> None:
        batch.withColumn("__n", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{out}/{n}")

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(schema).parquet(f"{out}/*")
    if mode == "update":
        last = F.max_by(F.struct(*names), "__n").alias("r")
        return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys or []]).agg(last).select("r.*")
    return rows.select(*names)
