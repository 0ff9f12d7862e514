"""Text formats as DataFrames: each takes lines in `value` and gives typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import M8, PAF, columns


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines without blanks at their ends, blank ones left out."""
    return trimmed(spark.read.text(paths).select("value"))


#: What counts as blank at a line's end.
BLANKS = " \t\n\x0b\x0c\r"


def trimmed(text: DataFrame) -> DataFrame:
    return text.select(F.rtrim("value", F.lit(BLANKS)).alias("value")).where("value <> ''")


def _fields(text: DataFrame, by: str = "\t") -> DataFrame:
    """text with its fields as an array f. It passes a generator so that filters on fields stay above the split, which else is done for each of them."""
    return text.withColumn("f", F.explode(F.array(F.split("value", by))))


def _at(i: int) -> Column:
    return F.get("f", F.lit(i))


DIGITS = "0123456789"


def _typed(kinds: list[str], strand: int | None = None) -> Column:
    """Whether a row's first fields are of these types: lengths and counts have no sign and up to 18 digits, nothing is trimmed inside, a strand is + or -. Digits are told from others over all fields at once."""
    longs = [_at(i) for i, k in enumerate(kinds) if k == "long"]
    ok = (F.size("f") >= len(kinds)) & (F.translate(F.concat(*longs), DIGITS, "") == "")
    for c in longs:
        ok &= F.char_length(c).between(1, 18)
    for i, k in enumerate(kinds):
        if k == "double":
            ok &= _at(i).try_cast("double").isNotNull() & (F.trim(_at(i), F.lit(BLANKS)) == _at(i))
    if strand is not None:
        ok &= _at(strand).isin("+", "-")
    return F.coalesce(ok, F.lit(False))


def parse_m8(text: DataFrame, wide: bool = True, strict: bool = False) -> DataFrame:
    """Rows of tabular alignments (14 columns, or 12 with lengths of 0). A row with a missing or malformed number is left out, or an error if strict; further columns are ignored; the accession loses its version. Lines are split once."""
    fields = columns(M8)[: 14 if wide else 12]
    rows = _fields(trimmed(text))
    ok = _typed([k for _, k in fields])
    if strict:
        rows = rows.withColumn("f", F.when(ok, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("malformed row: "), "value")).cast("array<string>")))
    rows = rows.where(ok)
    out = {n: _at(i) if k == "string" else _at(i).cast(k) for i, (n, k) in enumerate(fields)}
    out["tname"] = F.substring_index(out["tname"], ".", 1)
    if not wide:
        out |= {"qlen": F.lit(0).cast("long"), "slen": F.lit(0).cast("long")}
    return rows.select(*[c.alias(n) for n, c in out.items()])


def hit_lines(text: DataFrame) -> DataFrame:
    """Lines of a hits file, without blank and # ones."""
    return trimmed(text).where(~F.startswith("value", F.lit("#")))


def read_accession(text: DataFrame) -> DataFrame:
    """(read_id, accession) of lines with both; lines without a tab are left out."""
    rows = _fields(trimmed(text)).where(F.size("f") > 1)
    return rows.select(_at(0).alias("read_id"), _at(1).alias("accession")).where("read_id <> '' AND accession <> ''")


def tag_map(three: Column) -> Column:
    """key -> value of an array of arrays [key, type, value]; the last of a key wins. Only rows that repeat a key pay for looking for it."""
    entries = lambda x: F.map_from_entries(F.transform(x, lambda t: F.struct(t[0].alias("key"), t[2].alias("value"))))
    last = F.filter(three, lambda x, i: ~F.exists(F.slice(three, i + 2, F.size(three)), lambda y: y[0] == x[0]))
    distinct = F.size(F.array_distinct(F.transform(three, lambda t: t[0]))) == F.size(three)
    return F.when(distinct, entries(three)).otherwise(entries(last))


def parse_paf(text: DataFrame) -> DataFrame:
    """PAF rows: 12 columns and tags, parts like K:T:V. Rows that are short, have a bad number or a strand but + or - are left out, as are blank and # lines. Lines are split once, tags too."""
    fields = columns(PAF)[:12]
    strand = [n for n, _ in fields].index("strand")
    rows = _fields(hit_lines(text)).where(_typed([k for _, k in fields], strand))
    cols = [(_at(i) if k == "string" else _at(i).cast(k)).alias(n) for i, (n, k) in enumerate(fields)]
    three = F.filter(F.transform(F.slice("f", 13, F.greatest(F.size("f") - 12, F.lit(0))), lambda x: F.split(F.rtrim(x), ":", 3)), lambda x: F.size(x) == 3)
    rows = rows.select(*cols, F.explode(F.array(three)).alias("t"))
    return rows.select(*[n for n, _ in fields], tag_map(F.col("t")).alias("tags"))


def parse_sam(text: DataFrame) -> DataFrame:
    """Alignment rows of SAM text, without the header."""
    rows = _fields(text.where(~F.startswith("value", F.lit("@")))).where(F.size("f") >= 11)
    kinds = ("string", "int", "string", "long", "int", "string", "string", "long", "long", "string", "string")
    names = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    tags = F.array_join(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), "\t")
    return rows.select(*[_at(i).try_cast(k).alias(n) for i, (n, k) in enumerate(zip(names, kinds))], F.nullif(tags, F.lit("")).alias("tags"))


def count_sam(text: DataFrame) -> DataFrame:
    """Number of lines that are no header."""
    return text.where(~F.startswith("value", F.lit("@"))).agg(F.count("*").alias("alignments"))


def has_alignments(text: DataFrame) -> bool:
    return not text.where(~F.startswith("value", F.lit("@"))).isEmpty()


def parse_nodes(text: DataFrame) -> DataFrame:
    """(taxid, parent, rank) of nodes.dmp lines; the root, 1, and lines without ids are left out."""
    f = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", " ")))
    rows = text.select(f.alias("f")).where(F.size("f") >= 3).select(_at(0).try_cast("int").alias("taxid"), _at(1).try_cast("int").alias("parent"), _at(2).alias("rank"))
    return rows.where("taxid IS NOT NULL AND parent IS NOT NULL AND taxid <> 1")


def parse_merged(text: DataFrame) -> DataFrame:
    """(old, new) of merged.dmp lines."""
    f = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", " ")))
    rows = text.select(f.alias("f")).where(F.size("f") >= 2).select(_at(0).try_cast("int").alias("old"), _at(1).try_cast("int").alias("new"))
    return rows.where("old IS NOT NULL AND new IS NOT NULL")


def parse_acc2taxid(text: DataFrame, strict: bool = True) -> DataFrame:
    """(accession, taxid) and the other columns of text (such as file and ordinal) of two or more fields: the taxid is the second of two, else the third. Header rows, whose first field begins with accession, are left out; any other bad taxid is an error, or left out if not strict."""
    others = [c for c in text.columns if c != "value"]
    field = F.when(F.size("f") == 2, _at(1)).otherwise(_at(2))
    taxid = field.try_cast("int")
    if strict:
        taxid = F.coalesce(taxid, F.raise_error(F.concat(F.lit("bad taxid: "), F.coalesce(field, F.lit("none")))).cast("int"))
    rows = _fields(text.withColumn("value", F.rtrim(F.regexp_replace("value", r"\s+$", ""))).where("value <> ''")).where(~F.startswith(_at(0), F.lit("accession")) & (F.size("f") >= 2))
    return rows.select(F.substring_index(_at(0), ".", 1).alias("accession"), taxid.alias("taxid"), *others).where("taxid IS NOT NULL")


def parse_taxids(text: DataFrame) -> DataFrame:
    """The distinct integers of a list, one a line; bad lines are ignored."""
    return text.select(F.trim("value").try_cast("int").alias("taxid")).where("taxid IS NOT NULL").distinct()


def parse_accession_info(text: DataFrame) -> DataFrame:
    """(accession, name, length) of three tab-separated columns."""
    return _fields(trimmed(text)).where(F.size("f") >= 3).select(_at(0).alias("accession"), _at(1).alias("name"), _at(2).cast("long").alias("length"))


def read_bytes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length, content) of whole files, one a row; a file over Spark's 2 GB of a row needs lines() instead."""
    return spark.read.format("binaryFile").load(paths).select("path", "length", "content")


def parse_json_map(text: DataFrame, kind: str = "long") -> DataFrame:
    """(key, value) of JSON objects, one a row."""
    return text.select(F.explode(F.from_json("value", f"map<string,{kind}>")).alias("key", "value"))


def parse_abundance(text: DataFrame) -> DataFrame:
    """(target_id, est_counts) of abundance.tsv, the header left out."""
    return _fields(trimmed(text)).where((F.size("f") >= 5) & (_at(0) != "target_id")).select(_at(0).alias("target_id"), _at(3).try_cast("double").alias("est_counts"))


def spike_counts(abundance: DataFrame) -> DataFrame:
    return abundance.where(F.startswith("target_id", F.lit("ERCC-")))


def parse_stats_summary(text: DataFrame) -> DataFrame:
    """(key, value) of SN lines, with or without a leading #, the key without its colon."""
    f = F.split(F.regexp_replace("value", r"^#\s*", ""), "\t")
    rows = text.select(f.alias("f")).where((F.size("f") >= 3) & (_at(0) == "SN"))
    return rows.select(F.regexp_replace(F.trim(_at(1)), ":$", "").alias("key"), F.trim(_at(2)).alias("value"))


def parse_insert_sizes(text: DataFrame) -> DataFrame:
    """(size, count) of IS lines of five fields: pairs inward, outward and other, where there are any."""
    f = F.split(F.regexp_replace("value", r"^#\s*", ""), "\t")
    rows = text.select(f.alias("f")).where((F.size("f") == 6) & (_at(0) == "IS"))
    count = _at(3).try_cast("long") + _at(4).try_cast("long") + _at(5).try_cast("long")
    return rows.select(_at(1).try_cast("long").alias("size"), count.alias("count")).where("count > 0")


def parse_depth(text: DataFrame, strict: bool = True) -> DataFrame:
    """(chrom, pos, depth) of three columns; of a position's rows the last counts, by `ordinal` if the lines have one. A line of other columns or with a bad number, and a text without lines, is an error, or left out if not strict."""
    order = F.col("ordinal") if "ordinal" in text.columns else F.monotonically_increasing_id()
    if strict and text.isEmpty():
        raise ValueError("no depth lines")
    rows = text.withColumn("o", order).withColumn("f", F.split("value", "\t"))
    ok = (F.size("f") == 3) & _at(1).try_cast("long").isNotNull() & _at(2).try_cast("int").isNotNull()
    if strict:
        rows = rows.withColumn("f", F.when(ok, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("bad depth line: "), "value")).cast("array<string>")))
    else:
        rows = rows.where(ok)
    rows = rows.select("o", _at(0).alias("chrom"), _at(1).cast("long").alias("pos"), _at(2).cast("int").alias("depth"))
    return rows.groupBy("chrom", "pos").agg(F.max_by("depth", "o").alias("depth"))


def parse_seqkit(text: DataFrame) -> DataFrame:
    """Columns of a blank-separated table of file statistics; commas in numbers go."""
    names = ("file", "format", "type", "num_seqs", "sum_len", "min_len", "avg_len", "max_len")
    kinds = ("string", "string", "string", "long", "long", "long", "double", "long")
    rows = _fields(trimmed(text).select(F.trim("value").alias("value")), r"\s+").where((F.size("f") >= 8) & (_at(0) != "file"))
    return rows.select(*[(_at(i) if k == "string" else F.translate(_at(i), ",", "").try_cast(k)).alias(n) for i, (n, k) in enumerate(zip(names, kinds))])


def spike_stats(text: DataFrame) -> DataFrame:
    """(mapped_reads, mapped_paired) of SN lines."""
    s = parse_stats_summary(text)
    pick = lambda key: F.max(F.when(F.col("key") == key, F.col("value").try_cast("long")))
    return s.agg(pick("reads mapped").alias("mapped_reads"), pick("reads mapped and paired").alias("mapped_paired"))


def variant_counts(text: DataFrame) -> DataFrame:
    """(snps, mnps, indels) of SN lines with an id column."""
    f = F.split("value", "\t")
    rows = text.select(f.alias("f")).where((_at(0) == "SN") & (F.size("f") >= 4))
    pick = lambda key: F.coalesce(F.max(F.when(_at(2) == f"number of {key}:", F.trim(_at(3)).try_cast("long"))), F.lit(0).cast("long")).alias(key.lower())
    return rows.agg(pick("SNPs"), pick("MNPs"), pick("indels"))


def parse_vcf(text: DataFrame) -> DataFrame:
    """(chrom, pos, ref, alt, kind) of variant rows; alleles of more than one length are an indel, of length 1 a SNP, else an MNP."""
    rows = _fields(text.where(~F.startswith("value", F.lit("#")))).where(F.size("f") >= 5)
    lengths = F.array_distinct(F.transform(F.concat(F.array(_at(3)), F.split(_at(4), ",")), F.char_length))
    kind = F.when(F.size(lengths) > 1, "indel").when(lengths[0] == 1, "snp").otherwise("mnp")
    return rows.select(_at(0).alias("chrom"), _at(1).try_cast("long").alias("pos"), _at(3).alias("ref"), _at(4).alias("alt"), kind.alias("kind"))


def variant_classes(variants: DataFrame) -> DataFrame:
    return variants.agg(*[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("snp", "mnp", "indel")])


#: Ranks of assembly levels.
ASSEMBLY_LEVELS = {"chromosome": 4, "complete": 3, "scaffold": 2, "contig": 1}


def best_assembly(metadata: DataFrame, files: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, file, accession, score, released): of the files whose name holds an accession of the metadata that of the highest assembly level, then the latest release, then the first line. metadata: JSON lines in `value`, numbered in `ordinal`; files: file."""
    kind = "accession string, assembly_info struct<assembly_level:string,release_date:string>"
    m = metadata.select(*by, "ordinal", F.from_json("value", kind).alias("m")).select(*by, "ordinal", "m.accession", F.lower("m.assembly_info.assembly_level").alias("level"), F.coalesce("m.assembly_info.release_date", F.lit("1900-01-01")).alias("released"))
    score = F.lit(0)
    for level, rank in ASSEMBLY_LEVELS.items():
        score = F.when(F.col("level") == level, rank).otherwise(score)
    names = files.select(*by, "file", F.explode(F.regexp_extract_all("file", F.lit(r"(GC[AF]_[0-9]+[.][0-9]+)"), 1)).alias("accession"))
    rows = m.withColumn("score", score).join(names, [*by, "accession"])
    best = F.max_by(F.struct("file", "accession", "score", "released"), F.struct("score", "released", -F.col("ordinal")))
    return rows.groupBy(*by).agg(best.alias("b")).where("b IS NOT NULL").select(*by, "b.*")


def parse_names(names: DataFrame, nodes: DataFrame) -> DataFrame:
    """(taxid, name) of species: the first scientific name, else the last synonym, else N/A. names: lines of names.dmp in `value`, numbered in `ordinal`."""
    f = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", " ")))
    rows = names.select("ordinal", f.alias("f")).where(F.size("f") >= 4).select("ordinal", _at(0).try_cast("int").alias("taxid"), _at(1).alias("name"), _at(3).alias("class"))
    pick = F.coalesce(F.min_by("name", F.when(F.col("class") == "scientific name", F.col("ordinal"))), F.max_by("name", F.when(F.col("class") == "synonym", F.col("ordinal"))))
    best = rows.groupBy("taxid").agg(pick.alias("name"))
    return nodes.where("rank = 'species'").select("taxid").join(best, "taxid", "left").select("taxid", F.coalesce("name", F.lit("N/A")).alias("name"))
