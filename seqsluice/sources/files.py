"""Sequence files: FASTA by Spark's text reader, FASTQ in stretches of a file."""

from __future__ import annotations

import contextlib
import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.headers import header_desc, header_id
from ..schemas import SEQUENCE
from ..session import running, settled
from .bam import read_bam  # noqa: F401  beside the other readers

ROWS = 10_000
#: Bytes of short stretches or files that one task reads, where there are more of them than cores.
TASK = 64 << 20
#: Fixed value: what is outside the alphabet of proteins.
OTHER = r"[^ACDEFGHIKLMNPQRSTVWYXBZJUO*.\-]"


def read_fasta(spark: SparkSession, paths: str | list[str], until_blank: bool = False) -> DataFrame:
    """(source, ordinal, id, desc, seq, qual) of FASTA records; sequences of many lines are joined, ordinal numbers a file's records from 0. Files are split at record starts, so a large one is read by many tasks; a first pass counts the records of each split. until_blank: a blank line ends a file, as it does a stream."""
    text = spark.read.text(paths, lineSep="\n>").select(F.input_file_name().alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    text = text.where(F.rlike("value", F.lit(r"\S")))
    starts = text.groupBy("source", "block").agg(F.count("*").alias("rows"), F.min("n").alias("first"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("source", "block", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    text = text.join(F.broadcast(starts), ["source", "block"]).select("source", (F.col("before") + F.col("n") - F.col("first")).alias("ordinal"), "value")
    if until_blank:
        ends = text.where(F.rlike("value", F.lit(BLANK_LINE))).groupBy("source").agg(F.min("ordinal").alias("last"))
        text = text.join(ends, "source", "left").where(F.col("last").isNull() | (F.col("ordinal") <= F.col("last")))
        text = text.select("source", "ordinal", F.when(F.col("ordinal") == F.col("last"), F.regexp_replace("value", r"(?s)\r?\n[ \t]*\r?\n.*$", "")).otherwise(F.col("value")).alias("value"))
    return fasta_records(text)


#: A blank line that something follows or that ends the text.
BLANK_LINE = r"\n[ \t]*\r?\n"


def too_small(spark: SparkSession, path: str, least: int) -> bool:
    """Whether a file or folder is missing or has fewer bytes, so that later steps are left out."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return not store.exists(p) or store.getContentSummary(p).getLength() < least


def whole_headers(records: DataFrame) -> DataFrame:
    """records whose id is the whole header, with no description."""
    return records.withColumns({"id": F.concat_ws(" ", "id", "desc"), "desc": F.lit(None).cast("string")})


def fasta_records(text: DataFrame) -> DataFrame:
    """Records of texts that hold one each, with or without the > at the start."""
    header = F.regexp_replace(F.substring_index("value", "\n", 1), r"\r$", "")
    body = F.when(F.contains("value", F.lit("\n")), F.regexp_replace("value", r"^[^\n]*\n", "")).otherwise("")
    seq = F.regexp_replace(body, r"\s", "")
    return text.select("source", "ordinal", header_id(header, ">").alias("id"), header_desc(header).alias("desc"), seq.alias("seq"), F.lit(None).cast("string").alias("qual"))


def _open(uri: str) -> io.BufferedReader:
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")
    raw = store.open_input_stream(path, compression=None)
    data = io.BufferedReader(raw, 1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=data), 1 << 20) if data.peek(2)[:2] == b"\x1f\x8b" else data


def _paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")


def record_of(lines: list[bytes]) -> tuple | None:
    """(id, desc, seq, qual) of four lines: @id, bases, a lone +, as many qualities; None if they are none."""
    head, seq, plus, qual = (x.rstrip(b"\r\n") for x in lines)
    if not head.startswith(b"@") or plus != b"+" or not seq or len(seq) != len(qual):
        return None
    name, _, desc = head.lstrip(b"@").partition(b" ")
    return name.decode(), desc.decode() or None, seq.decode(), qual.decode()


def _stretch(path: str, start: int, end: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place, four lines) of the records that begin in [start, end) of a file; of a gzipped one, all if start is 0 and none else.

    @ may begin a line of qualities, but only at a record's first line is the line after next a lone + and are the two between and after it as long as each other."""
    store, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    with store.open_input_file(name) as f:
        if f.read(2) == b"\x1f\x8b":
            if start == 0:
                lines = iter(_open(path))
                while four := [x for _, x in zip(range(4), lines)]:
                    yield end - sum(map(len, four)), four + [b""] * (4 - len(four))  # places have no meaning; the last record ends where the file does
            return
        f.seek(max(0, start - 1))
        stream = io.BufferedReader(f, min(1 << 20, max(1 << 13, end - start)))
        at = start - 1 + len(stream.readline()) if start else 0
        if start and at >= end:
            return
        window = [stream.readline() for _ in range(4)]
        while start and at < end and window[3] and (record_of(window) is None):
            at += len(window[0])
            window = [*window[1:], stream.readline()]
        if start and record_of(window) is None:
            return  # the rest of a record that began before, or of one that the count of bytes will miss
        while window[0] and at < end:
            yield at, window
            at += sum(map(len, window))
            window = [stream.readline() for _ in range(4)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, end, first, n, next, bad) of stretches: where the first record begins, how many there are, where the next one would begin, and whether one is malformed."""
    for b in batches:
        rows = []
        for path, start, end in zip(*(c.to_pylist() for c in b.columns)):
            first, n, after, bad = None, 0, None, False
            for at, four in _stretch(path, start, end):
                first = at if first is None else first
                if record_of(four) is None:
                    bad = True
                    break
                n, after = n + 1, at + sum(map(len, four))
            rows.append((path, start, end, first, n, after, bad))
        kinds = (pa.string(), *[pa.int64()] * 5, pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["path", "start", "end", "first", "n", "next", "bad"])


def _fastq(strict: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for path, start, end, base in zip(*(c.to_pylist() for c in b.columns)):
                for i, (_, four) in enumerate(_stretch(path, start, end)):
                    row = record_of(four)
                    if row is None:
                        if strict:
                            raise ValueError(f"malformed FASTQ record: {four[0][:80]!r}")
                        break
                    rows.append((path, base + i, *row))
                    held += len(four[1]) + len(four[3])
                    if len(rows) == ROWS or held >= TASK:
                        yield _sequences(rows)
                        rows, held = [], 0
        yield _sequences(rows)

    return run


def _sequences(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), *[pa.string()] * 4)
    names = ("source", "ordinal", "id", "desc", "seq", "qual")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def _zipped(store, path) -> bool:
    """Whether a file begins as a gzip does, whatever its name."""
    with contextlib.closing(store.open(path)) as f:
        return f.read() == 0x1F and f.read() == 0x8B


def read_fastq(spark: SparkSession, paths: list[str], strict: bool = False, split: int = 64 << 20) -> DataFrame:
    """(source, ordinal, id, desc, seq, qual) of FASTQ files, plain or gzipped; ordinal numbers a file's records from 0. The first record that is malformed ends its file, or is an error if strict.

    A plain file is read in stretches of `split` bytes, each a task, or several where they are short: records that begin in a stretch are its own. A first pass counts
    them, so that ordinals go on from stretch to stretch; where a stretch doesn't begin with the record that the one before left
    off at, something between is malformed. A gzip can't be entered in its middle, so it is one task's."""
    jvm = spark._jvm
    rows = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size = store.getFileStatus(path).getLen()
        step = split if size > split and not _zipped(store, path) else max(size, 1)
        rows += [(p, at, min(size, at + step)) for at in range(0, max(size, 1), step)]
    n_tasks = max(1, min(len(rows), max(spark.sparkContext.defaultParallelism, sum(end - at for _, at, end in rows) // TASK + 1)))
    stretches = spark.createDataFrame(rows, "path string, start long, end long").repartition(n_tasks)
    if len(rows) == len(paths):
        return stretches.select("path", "start", "end", F.lit(0).cast("long").alias("base")).mapInArrow(_fastq(strict), SEQUENCE)
    counted = settled(stretches.mapInArrow(_counted, "path string, start long, end long, first long, n long, next long, bad boolean"))
    by = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    left_off = F.max("next").over(by)
    apart = F.col("first").isNotNull() & (F.col("start") > 0) & (F.coalesce(left_off, F.lit(0)) != F.col("first"))
    rows = counted.withColumns({"base": F.coalesce(F.sum("n").over(by), F.lit(0)), "apart": apart, "over": F.coalesce(F.max("bad").over(by), F.lit(False))})
    ended = F.max("apart").over(by.rowsBetween(Window.unboundedPreceding, 0)) | F.col("over")
    rows = rows.withColumn("ended", ended)
    if strict:
        whole = Window.partitionBy("path")
        missed = (F.coalesce(F.max("next").over(whole), F.lit(0)) < F.max("end").over(whole)) & ~F.max("bad").over(whole)
        broken = F.raise_error(F.concat(F.lit("malformed FASTQ record: "), "path", F.lit(" after byte "), F.coalesce(left_off, F.lit(0)).cast("string"))).cast("long")
        rows = rows.withColumn("base", F.when((F.col("apart") & ~F.col("over")) | missed, broken).otherwise(F.col("base")))
    else:
        rows = rows.where(~F.col("ended"))
    return rows.select("path", "start", "end", "base").repartition(n_tasks).mapInArrow(_fastq(strict), SEQUENCE)


def read_pairs(spark: SparkSession, first: list[str], second: list[str]) -> DataFrame:
    """Mates of the files that go together, by their ordinal: a struct r1 and a struct r2, one of them null where a file is longer."""
    files = spark.createDataFrame(list(zip(first, second)), "s1 string, s2 string")
    a, b = read_fastq(spark, first), read_fastq(spark, second)
    a = a.join(F.broadcast(files), F.col("source") == F.col("s1")).select("s1", "ordinal", F.struct("id", "desc", "seq", "qual").alias("r1"))
    b = b.join(F.broadcast(files), F.col("source") == F.col("s2")).select("s1", "ordinal", F.struct("id", "desc", "seq", "qual").alias("r2"))
    return a.join(b, ["s1", "ordinal"], "full").withColumnRenamed("s1", "source")


def synthetic_reads(spark: SparkSession, n: int, length: int, mean: float = 30.0, sd: float = 5.0, seed: int = 42) -> DataFrame:
    """n reads of uniform ACGT with qualities drawn from Normal(mean, sd), held to 0..40 by drawing again (ten times at most, then the mean's)."""
    base = lambda i: F.substring(F.lit("ACGT"), (F.pmod(F.xxhash64("ordinal", i, F.lit(seed)), F.lit(4)) + 1).cast("int"), F.lit(1))

    def unit(i: Column, k: int, salt: int) -> Column:
        return (F.pmod(F.xxhash64("ordinal", i, F.lit(k), F.lit(salt), F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)

    def quality(i: Column) -> Column:
        out = F.lit(float(min(40, max(0, round(mean)))))
        for k in reversed(range(10)):
            q = F.round(F.lit(mean) + F.lit(sd) * F.sqrt(-2 * F.log(unit(i, k, 1))) * F.cos(6.283185307179586 * unit(i, k, 2)))
            out = F.when(q.between(0, 40), q).otherwise(out)
        return F.char((out + 33).cast("int"))

    places = F.sequence(F.lit(1), F.lit(length)) if length > 0 else F.array().cast("array<int>")
    rows = spark.range(n).withColumnRenamed("id", "ordinal")
    return rows.select(F.lit("synthetic").alias("source"), "ordinal", F.concat(F.lit("read"), "ordinal").alias("id"), F.lit(None).cast("string").alias("desc"), F.array_join(F.transform(places, base), "").alias("seq"), F.array_join(F.transform(places, quality), "").alias("qual"))


def clean_proteins(records: DataFrame) -> DataFrame:
    """Protein records upper-cased, each character outside the alphabet an X; fixed counts those."""
    upper = F.upper("seq")
    clean = F.regexp_replace(upper, OTHER, "X")
    return records.withColumns({"seq": clean, "fixed": F.char_length(upper) - F.char_length(F.regexp_replace(upper, OTHER, ""))})


def accession_offsets(records: DataFrame, size: Column) -> DataFrame:
    """(accession, offset) of the first record of each accession: where it would start in a file of records in order of `ordinal`, within each source."""
    at = records.select(F.substring_index("id", ".", 1).alias("accession"), size.cast("long").alias("n"), "source", "ordinal")
    at = running(at, ["source"], "ordinal", "n", "offset")
    return at.groupBy("accession").agg(F.min_by("offset", F.struct("source", "ordinal")).alias("offset"))


def find_files(spark: SparkSession, folder: str, extensions: tuple[str, ...]) -> list[str]:
    """Files of a folder by extension (of the name without .gz), case aside, the largest first; none is an error."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = [(f.getLen(), f.getPath().toString()) for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if f.isFile()]
    keep = sorted(((-n, p) for n, p in found if p.lower().removesuffix(".gz").rpartition(".")[2] in extensions))
    if not keep:
        raise FileNotFoundError(f"no {', '.join(extensions)} in {folder}")
    return [p for _, p in keep]
