"""Ingest of reads as they arrive. The engine's streams have no event time: watermarks are an extra, for the dedup of late repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.hits import consensus
from ..schemas import SEQUENCE
from ..sources.files import fasta_records


def sequence_stream(spark: SparkSession, folder: str, files: int = 100) -> DataFrame:
    """Records that land in a folder as Parquet."""
    return spark.readStream.schema(SEQUENCE).option("maxFilesPerTrigger", files).parquet(folder)


def fasta_stream(spark: SparkSession, folder: str) -> DataFrame:
    text = spark.readStream.option("lineSep", "\n>").text(folder).select(F.input_file_name().alias("source"), F.lit(0).cast("long").alias("ordinal"), "value")
    return fasta_records(text.where(F.rlike("value", F.lit(r"\S"))))


def fan_out(stream: DataFrame, branches: list[Callable[[DataFrame], None]], checkpoint: str) -> StreamingQuery:
    """Every branch gets every micro-batch, read once. No branch is an error."""
    if not branches:
        raise ValueError("no branch")

    def each(df: DataFrame, _: int) -> None:
        df.persist()
        try:
            for branch in branches:
                branch(df)
        finally:
            df.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def only_sequences(stream: DataFrame) -> DataFrame:
    """Records that have a sequence; others are dropped."""
    return stream.where("id IS NOT NULL AND seq IS NOT NULL")


def read_calls(stream: DataFrame, order: list[str], time: str, gap: str = "1 minute", late: str = "10 minutes", mode: str = "reference") -> DataFrame:
    """(qname, level, taxid, species, genus, family, n_hits) of a stream of resolved hits: a read's hits are a session that ends when none has come for `gap`, and its call is given once, when the watermark has passed. State is what the aggregates of open reads hold."""
    calls = consensus(stream.withWatermark(time, late), order, mode, by=(F.session_window(time, gap).alias("w"), "qname"))
    return calls.drop("w")


class Progress(StreamingQueryListener):
    """Rows and speed of a stream's micro-batches, and a warning where `quiet` of them in a row were empty."""

    def __init__(self, say: Callable[[str], None] = print, quiet: int = 10):
        self.say, self.quiet = say, quiet
        self.rows: dict[str, int] = {}
        self.empty: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows[str(event.id)] = self.empty[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        name = str(p.id)
        self.rows[name] = self.rows.get(name, 0) + p.numInputRows
        self.empty[name] = 0 if p.numInputRows else self.empty.get(name, 0) + 1
        self.say(f"{p.name or name}: {self.rows[name]} rows, {p.processedRowsPerSecond or 0:.0f} a second")
        if self.empty[name] == self.quiet:
            self.say(f"{p.name or name}: no rows in {self.quiet} batches")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.say(f"{event.id}: ended" + (f", {event.exception}" if event.exception else ""))


def cluster_counts(stream: DataFrame, length: int = 70) -> DataFrame:
    """Sizes of the clusters of reads with one prefix, kept up to date; state is a row a distinct prefix."""
    return stream.groupBy(F.substring("seq", 1, length).alias("prefix")).agg(F.count("*").alias("size"))


def windowed_counts(events: DataFrame, time: str = "ts", width: str = "5 minutes", late: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """Counts and sums by tumbling window, closed by a watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def distinct_events(events: DataFrame, key: str, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
