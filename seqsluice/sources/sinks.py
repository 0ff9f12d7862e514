"""Reports and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reads import fasta_text, fastq_text

#: Positions of a hit summary's columns among the 28 of its wide text form.
WIDE = {0: "read_id", 1: "level", 2: "taxid", 3: "accession", 8: "species", 9: "genus", 10: "family", 13: "contig_id", 14: "contig_accession", 15: "contig_species", 16: "contig_genus", 17: "contig_family"}


def write_fasta(records: DataFrame, path: str) -> None:
    fasta_text(records).write.mode("overwrite").text(path)


def write_fastq(records: DataFrame, path: str) -> None:
    fastq_text(records).write.mode("overwrite").text(path)


def write_table(rows: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    rows.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def write_json(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A row a line; `by` makes a folder of each value, such as an accession."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).json(path)


def write_dictionary(rows: DataFrame, path: str, key: str, parts: int = 32) -> None:
    """A dictionary sorted by key, so that lookups of a key read few row groups."""
    rows.repartitionByRange(parts, key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def narrow_lines(summary: DataFrame) -> DataFrame:
    """Six columns: read, accession, species, genus, family, level."""
    return summary.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("read_id", "accession", "species", "genus", "family", "level")]).alias("value"))


def parse_narrow(lines: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    rows = lines.select(f.alias("f")).where(F.size("f") == 6)
    return rows.select(F.col("f")[0].alias("read_id"), F.col("f")[1].alias("accession"), *[F.col("f")[i].try_cast("int").alias(n) for i, n in ((2, "species"), (3, "genus"), (4, "family"), (5, "level"))])


def wide_lines(summary: DataFrame) -> DataFrame:
    """28 columns, with blanks where a hit summary has nothing."""
    parts = [F.coalesce(F.col(WIDE[i]).cast("string"), F.lit("")) if i in WIDE else F.lit("") for i in range(28)]
    parts[25] = F.when(F.col("from_assembly"), "from_assembly").otherwise("")
    parts[26] = F.lit("1")
    parts[27] = F.coalesce("source", F.lit(""))
    return summary.select(F.concat_ws("\t", *parts).alias("value"))


def parse_wide(lines: DataFrame) -> DataFrame:
    """Rows of exactly 28 columns; blanks are null."""
    at = lambda i, kind="string": F.nullif(F.col("f")[i], F.lit("")).try_cast(kind)
    ints = {"level", "taxid", "species", "genus", "family", "contig_species", "contig_genus", "contig_family"}
    rows = lines.select(F.split("value", "\t").alias("f")).where(F.size("f") == 28)
    return rows.select(*[at(i, "int" if n in ints else "string").alias(n) for i, n in WIDE.items()], at(25).isNotNull().alias("from_assembly"), at(27).alias("source"))


def coverage_csv(stats: DataFrame) -> DataFrame:
    """The assembly coverage table with six decimals; a row that says No Contigs if there are none."""
    names = ("avg", "min", "max", "p25", "p50", "p75", "avg2xcnt", "cnt0", "cnt1", "cnt2")
    six = [F.format_string("%.6f", F.col(c).cast("double")).alias(c) for c in names]
    rows = stats.select(F.col("ref").cast("string").alias("contig_name"), *six)
    none = stats.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("No Contigs").alias("contig_name"), *[F.lit("").alias(c) for c in names])
    return rows.unionByName(none)


def insert_size_report(stats: DataFrame, hist: DataFrame) -> DataFrame:
    """Lines of a METRICS and a HISTOGRAM block, numbered in `n`."""
    head = stats.select(F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit("## METRICS").alias("value")), F.struct(F.lit(1).alias("n"), F.lit("MEDIAN\tMEAN\tSTDDEV\tPAIRS").alias("value")), F.struct(F.lit(2).alias("n"), F.format_string("%d\t%.2f\t%.2f\t%d", "median", "mean", "stddev", F.col("n")).alias("value")), F.struct(F.lit(3).alias("n"), F.lit("## HISTOGRAM").alias("value")))).alias("x")).select("x.*")
    return head.unionByName(hist.select((F.col("size") + 10).cast("int").alias("n"), F.format_string("%d\t%d", "size", "count").alias("value"))).orderBy("n")


def to_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def depth_plot(hist: list[tuple[float, float]], path: str, log_axis: bool = True) -> bool:
    """A plot of aggregated points, 800 x 600, where matplotlib is there."""
    try:
        import matplotlib
    except ImportError:
        return False
    matplotlib.use("Agg")
    from matplotlib import pyplot

    figure, axes = pyplot.subplots(figsize=(8, 6), dpi=100)
    axes.plot(*zip(*hist))
    axes.set_yscale("log" if log_axis else "linear")
    figure.savefig(path)
    pyplot.close(figure)
    return True


def fixed(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", x.cast("double"))
