"""The session the engine expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Duplicate tag keys keep the last value; adaptive execution splits hot keys and picks joins by measured sizes.
CONFS = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configured(spark: SparkSession) -> SparkSession:
    for key, value in CONFS.items():
        spark.conf.set(key, value)
    return spark


def session(name: str = "seqsluice", **confs: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in (CONFS | confs).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def numbered(df: DataFrame, order: list[str], number: str = "ordinal") -> DataFrame:
    """df with numbers from 0 in an order. Rows are dealt by ranges of it and numbered inside a range; only the ranges' counts meet in one task."""
    order = [F.col(c) for c in order]
    dealt = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)).cast("long") - 1
    return dealt.withColumn("_i", inside).join(F.broadcast(starts), "_range").withColumn(number, F.col("_start") + F.col("_i")).drop("_range", "_i", "_start")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors share: below the session's checkpoint folder, or on this machine where there is no cluster."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="work-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Ordinals that a task sums up one by one.
STRETCH = 1 << 16


def running(df: DataFrame, by: list[str], ordinal: str, size: str, start: str) -> DataFrame:
    """df with start: the sum of size over the rows of the same `by` with smaller ordinals.

    Ordinals are cut into stretches: a stretch's own rows are in order in one task, and of the stretches only their sums are, so a hot key is many tasks' work."""
    own = df.withColumn("_s", F.floor(F.col(ordinal) / STRETCH))
    before = Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1) if by else Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy(*by, "_s").agg(F.sum(size).alias("_sum"))
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_s").alias("_s2"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_s").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    same = F.col("_s") == F.col("_s2")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return own.join(sums, same).withColumn(start, F.col("_before") + F.col("_inside")).drop("_s", "_s2", "_before", "_inside", *[f"_{c}" for c in by])


def settled(df: DataFrame) -> DataFrame:
    """df computed once, for loops whose plan else doubles each round: a checkpoint in the shared folder if the session names one, else a cache."""
    sc = df.sparkSession.sparkContext
    return df.checkpoint() if sc.getCheckpointDir() else df.persist()
