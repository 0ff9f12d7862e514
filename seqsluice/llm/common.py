"""What the training-data operators share: tables, shared work folders, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to a Python worker at once. The JVM holds a batch in vectors and as a message, both grown by doubling, and the worker holds it again.
BATCH_BYTES = 4 << 20

#: Bytes of UTF-8 text to bytes of normalised text: A-Z lower-cased, digits, a-z and all of 0x80-0xFF kept, the rest blank.
WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors share. Where that is unset, a session on this machine alone (as in tests) gets a folder of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors, and lets the shuffle files behind it go."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def small(df: DataFrame, made: DataFrame | None = None, most: int = 4 << 20, rows: int = 200_000) -> DataFrame:
    """df, which comes by rows from what materialise() wrote (`made`, or itself), marked for a broadcast if that has `most` bytes of files and `rows` rows at most; beyond that it joins by a shuffle."""
    made = df if made is None else made
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(made._work_path)
    store = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return F.broadcast(df) if store.getContentSummary(path).getLength() <= most and made.count() <= rows else df


def discard(df: DataFrame) -> None:
    """Deletes what materialise() wrote; df must not be read any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._work_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that Spark has written, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///") if uri.startswith("file:/") else f"file://{uri}")


def bounded(spark: SparkSession) -> None:
    """From here on the session's batches for Python end at BATCH_BYTES, or before if it says so; Spark's own bound is 64 MB for each task."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH)) > BATCH_BYTES:
        spark.conf.set(BATCH, BATCH_BYTES)


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def words_of(data: bytes) -> list[bytes]:
    """Words: runs of digits, letters a-z after lower-casing A-Z, and non-ASCII characters."""
    return data.translate(WORD_BYTES).split()


def key() -> tuple[Column, Column]:
    """_d and _t, by which results are joined back to rows: the id as a long (null as the least one) and a hash of the text. Rows that share both are alike in every decision."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")).alias("_d"), F.xxhash64("text").alias("_t")


def packed(docs: DataFrame, results: tuple[str, ...] = ()) -> DataFrame:
    """(row, _d, _t, text): each row of docs in one struct, but for columns with the names of results, so that no name of docs meets one of an operator's own."""
    taken = {r.lower() for r in results}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    return docs.select(row.alias("row"), *key(), "text")


def keyed(docs: DataFrame, *cols: str) -> DataFrame:
    """_d, _t and the named columns of docs."""
    return docs.select(*key(), *cols)


def in_learning_fold(doc_id: str = "doc_id") -> Column:
    """Whether crc32(doc_id as text) mod 5 is not 0; a null id counts as the empty text, of the held-out remainder 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 != 0


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of one value of the first column, by which they are sorted, stay together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
        if last or held and held[-1].column(0)[-1].as_py() != key[0]:
            yield pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks().to_batches()[0]
            held = []
        held.append(b.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
