"""The corpus pipeline: documents in, a mix of clean documents out.

Each stage works on all that its predecessor kept. In every stage null texts, empty texts and null ids pass (they are
clean); a text that a stage has cut has its n_chars counted anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqsluice.llm import decontaminate, jaccard_join, line_dedup, mixing, toxicity
from seqsluice.llm.common import bounded, discard, materialise, table


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """docs with `text` as its text; n_chars follows where the text has changed."""
    changed = ~F.col(text).eqNullSafe(F.col("text"))
    return docs.withColumns({"n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars")), "text": F.col(text)})


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is at least 0.5 go."""
    bounded(spark)
    index = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, index).where("score < 0.5").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; a document goes if nothing but blanks is left of it."""
    found = line_dedup.dedup_lines(docs)
    empty = (F.col("n_removed") > 0) & (F.trim(F.translate("kept", "\n\t\r", "   ")) == "")
    return _with_text(found.where(~F.coalesce(empty, F.lit(False))), "kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays, the least by id and text; of rows equal in both, the least by a hash of the whole row."""
    bounded(spark)
    found = jaccard_join.join(docs)
    row = F.struct(*docs.columns)
    first = found.where("n_links > 0 AND is_first").groupBy("class_key").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
    return found.where("n_links = 0").select(*docs.columns).unionByName(first.select("row.*"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that lie in a benchmark item's window go; a document goes if that is half of its words or more."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _with_text(found.where(~F.col("over_limit")), "cleaned").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken: (doc_id, source, size, source_size, target, copies, taken)."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Votes of nearest neighbours and edit joins of whole texts are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        new = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            discard(docs)
        docs = new
    return docs
