"""Session helpers: where checkpoints go and how tables are opened."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a machine-local temporary folder is made on a single machine (master ``local``), as in tests; on a
    cluster that would lose data silently, so it is an error there.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="postgrove-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (survives the loss of executors)."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of Parquet up to which a stored table may be broadcast.
BROADCAST_BYTES = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """The frame stored, so it is computed once, with a broadcast hint if its files are at most ``BROADCAST_BYTES``; a larger one is joined by key."""
    held = stored(df, "bounded")
    size = int(str(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(held) if size <= BROADCAST_BYTES else held


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: cuts lineage, survives the loss of executors.

    The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(at)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan of few files divided by its key, so that work heavy on CPU uses all cores.

    A scan that already has a partition for every other core, as any large input does, stays as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < max(2, cores // 2) else df
