"""Token counts: documents in flat token files, found by a scan for the end-of-document identifier."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, store_of, work_dir

#: A shard that the encoder writes ends at the first document past so many bytes.
SHARD_BYTES = 64 << 20
#: Tokens of a block that a scan reads at once.
BLOCK_TOKENS = 1 << 20
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256


def encoder(vocabulary: str, pattern: str | None = None):
    """A function from texts to lists of identifiers. The driver reads the file; what is sent to the tasks is that one public vocabulary. pattern cuts texts into what is merged; without one it is that of the module public_tokenizers, which comes with the vocabularies."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern

    with open(vocabulary, "rb") as f:
        lines = f.read()

    def make():
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    return make


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, eod: int = END_OF_DOCUMENT, pattern: str | None = None) -> DataFrame:
    """Encodes every whole text and writes flat little-endian uint16 files below `folder`, each document followed by eod: (shard, ordinal, doc_id), the manifest.

    A task writes under names of its own and the manifest that Spark commits names the files of the attempts that
    succeeded, so files of lost or repeated attempts are never read. Null and empty texts are a lone eod."""
    make = encoder(vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, name, n, size = make(), None, "", 0, 0
        try:
            for big in batches:
                for at in range(0, big.num_rows, 1000):
                    b = big.slice(at, 1000)
                    shards, ordinals = [], []
                    for text in b.column(1).to_pylist():
                        if out is None or size >= SHARD_BYTES:
                            if out is not None:
                                out.close()
                            name, n, size = f"{folder}/{uuid.uuid4().hex}.u16", 0, 0
                            store, path = store_of(name)
                            store.create_dir(path.rpartition("/")[0], recursive=True)
                            out = store.open_output_stream(path)
                        data = np.array([*(encode(text) if text else ()), eod], "<u2").tobytes()
                        out.write(data)
                        shards.append(name)
                        ordinals.append(n)
                        n, size = n + 1, size + len(data)
                    yield pa.RecordBatch.from_arrays([pa.array(shards, pa.string()), pa.array(ordinals, pa.int64()), b.column(0)], names=["shard", "ordinal", "doc_id"])
        finally:
            if out is not None:
                out.close()

    return materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "shard string, ordinal long, doc_id long"), "token-manifest")


def _ends(eod: int, width: str):
    """Vectorised search of blocks for eod: their places in the file, and the tokens read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.dtype(width).itemsize
        for b in batches:
            for shard, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, path = store_of(shard)
                with store.open_input_file(path) as f:
                    f.seek(block * BLOCK_TOKENS * size)
                    data = f.read(BLOCK_TOKENS * size)
                ids = np.frombuffer(data[: len(data) // size * size], width)
                at = np.flatnonzero(ids == eod).astype(np.int64) + block * BLOCK_TOKENS
                yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([block], pa.int64()), pa.array([at], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64())], names=["shard", "block", "ends", "tokens"])

    return run


def scan(spark: SparkSession, shards: DataFrame, eod: int = END_OF_DOCUMENT, width: str = "<u2") -> DataFrame:
    """(shard, ordinal, first_token, n_tokens) of each document of flat files that have no index. shards: (shard, bytes).

    Blocks are read by offset, independently of each other. An exclusive prefix scan over a file's blocks carries the
    documents ended so far and the last end, which stitches a document that spans blocks; it sees one row a block.
    Tokens after a file's last eod are a document too; a file that ends with eod, or is empty, has no such rest. Odd bytes at a file's end are no token."""
    size = np.dtype(width).itemsize
    tokens = F.floor(F.col("bytes") / size)
    blocks = shards.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((tokens - 1) / BLOCK_TOKENS), F.lit(0)).cast("long"))).alias("block"))
    found = materialise(blocks.repartition("shard", "block").mapInArrow(_ends(eod, width), "shard string, block long, ends array<long>, tokens long"), "token-ends")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    whole = found.withColumn("docs", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))).withColumn("open", F.coalesce(F.max(last).over(before), F.lit(-1)))
    inside = whole.select("shard", "docs", "open", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.get("ends", F.col("i") - 1)) + 1
    inside = inside.select("shard", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("first_token"), (F.col("end") - start).alias("n_tokens"))
    tails = found.groupBy("shard").agg(F.sum("tokens").alias("tokens"), F.sum(F.size("ends")).cast("long").alias("ordinal"), (F.coalesce(F.max(last), F.lit(-1)) + 1).alias("first_token"))
    tails = tails.where(F.col("first_token") < F.col("tokens")).select("shard", "ordinal", "first_token", (F.col("tokens") - F.col("first_token")).alias("n_tokens"))
    return inside.unionByName(tails)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, shard, first_token) for every document: encoded to flat files, then counted by the scan alone.

    Rows that share a doc_id return a row each; a null doc_id stays null; null and empty texts have no tokens; an empty table gives no rows."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, work_dir(spark, "token-files"), vocabulary, pattern=pattern)
    sizes = manifest.select("shard").distinct().mapInArrow(_sizes, "shard string, bytes long")
    found = scan(spark, sizes)
    name = F.substring_index("shard", "/", -1).alias("shard")
    return manifest.join(found, ["shard", "ordinal"]).select("doc_id", "n_tokens", name, "first_token")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = [store.get_file_info(path).size for store, path in map(store_of, b.column(0).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["shard", "bytes"])
