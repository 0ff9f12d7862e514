"""Refinement of reads' calls through contigs, overlays, annotation and the sorted FASTA by taxon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import headers, lineage as lin
from ..schemas import RANKS
from ..session import running


def contig_calls(read2contig: DataFrame, contig_top: DataFrame, accessions: DataFrame) -> DataFrame:
    """(read_id, contig_id, contig_accession, contig_species, contig_genus, contig_family) through contig, its top hit and that accession's lineage, each of which must be there.

    Contigs and accessions meet first: that is small, and reads, of which one contig may have very many, join once."""
    known = contig_top.select(F.col("qname").alias("contig_id"), F.col("tname").alias("accession")).join(accessions.select("accession", *RANKS), "accession")
    known = known.select("contig_id", F.col("accession").alias("contig_accession"), *[F.col(r).alias(f"contig_{r}") for r in RANKS])
    return read2contig.select("read_id", "contig_id").join(known, "contig_id").select("read_id", "contig_id", "contig_accession", *[f"contig_{r}" for r in RANKS])


def refined_summary(summary: DataFrame, calls: DataFrame) -> DataFrame:
    """The hit summary with contig calls laid over: a read on a known contig gets its species at level 1; reads that only contigs name are added, from_assembly."""
    both = summary.join(calls, "read_id", "full")
    on_contig = F.col("contig_species").isNotNull()
    out = {"taxid": F.when(on_contig, F.col("contig_species")).otherwise(F.col("taxid")), "level": F.when(on_contig, 1).otherwise(F.col("level")), "accession": F.coalesce("accession", "contig_accession")}
    out |= {r: F.when(on_contig, F.col(f"contig_{r}")).otherwise(F.col(r)) for r in RANKS}
    return both.withColumns(out | {"from_assembly": F.col("level").isNull()})


def overlay(original: DataFrame, updated: DataFrame, added: DataFrame, key: str = "read_id") -> DataFrame:
    """original, its rows replaced where updated or, after it, added has the key; added's other rows appended. Rows that repeat a key in the overlay: the last by ordinal."""
    own = [c for c in original.columns if c != key]

    def last(df: DataFrame, mark: str) -> DataFrame:
        return df.groupBy(key).agg(F.max_by(F.struct(*own), "ordinal").alias(mark))

    rows = original.select(key, F.struct(*own).alias("o")).join(last(updated, "u"), key, "full").join(last(added, "a"), key, "full")
    rows = rows.where(F.col("o").isNotNull() | F.col("a").isNotNull())
    return rows.select(key, F.coalesce("u", "a", "o").alias("r")).select(key, "r.*")


def bam_read_contigs(rows: DataFrame) -> DataFrame:
    """(read_id, contig_id) of primary alignments, a read's first by ordinal."""
    from ..functions.alignments import primary

    return rows.where(primary(F.col("flag"))).groupBy(F.col("qname").alias("read_id")).agg(F.min_by("rname", "ordinal").alias("contig_id"))


def contig_stats(read2contig: DataFrame, least_unique: int = 0) -> DataFrame:
    """(contig_id, reads, unique_reads): sums of cluster sizes and numbers of reads, of contigs with enough of the latter."""
    rows = read2contig.groupBy("contig_id").agg(F.sum("cluster_size").alias("reads"), F.count("*").alias("unique_reads"))
    return rows.where(F.col("unique_reads") >= least_unique)


def annotated(records: DataFrame, nt: DataFrame, nr: DataFrame, sizes: DataFrame) -> DataFrame:
    """records (id, seq) with their accessions, new id, cluster size and route: mapped with either accession, else unidentified. nt, nr: (read_id, accession), the last by ordinal of a read."""
    def last(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col("read_id").alias("id")).agg(F.max_by("accession", "ordinal").alias(name))

    size = sizes.select(F.col("representative").alias("id"), F.col("size").alias("cluster_size"))
    rows = records.join(last(nt, "nt"), "id", "left").join(last(nr, "nr"), "id", "left").join(size, "id", "left")
    route = F.when(F.col("nt").isNotNull() | F.col("nr").isNotNull(), "mapped").otherwise("unidentified")
    return rows.select("id", "seq", "nt", "nr", headers.annotated_id(F.col("nr"), F.col("nt"), F.col("id")).alias("new_id"), F.greatest(F.coalesce("cluster_size", F.lit(1)), F.lit(1)).alias("cluster_size"), route.alias("route"))


def routed(rows: DataFrame) -> DataFrame:
    """(route, id, seq): mapped records once, unidentified ones as often as their cluster has reads, and once under unique_unidentified."""
    mapped = F.col("route") == "mapped"
    routes = F.when(mapped, F.array(F.lit("mapped"))).otherwise(F.concat(F.array_repeat(F.lit("unidentified"), F.col("cluster_size").cast("int")), F.array(F.lit("unique_unidentified"))))
    return rows.select(F.explode(routes).alias("route"), F.col("new_id").alias("id"), "seq")


def with_taxid_headers(rows: DataFrame, nt: DataFrame, nr: DataFrame, lineages: DataFrame) -> DataFrame:
    """records (id, seq) under headers with both databases' lineages; the call is that of the id's last part. nt, nr: (read_id, taxid, level)."""
    out = rows.withColumn("read_id", headers.last_part(F.col("id")))
    for name, calls in (("nt", nt), ("nr", nr)):
        own = calls.select("read_id", F.col("taxid").alias(f"t_{name}"), F.col("level").alias(f"v_{name}"))
        known = lineages.select(F.col("taxid").alias(f"t_{name}"), *[F.col(r).alias(f"{name}_{r}") for r in RANKS])
        out = out.join(own, "read_id", "left").join(known, f"t_{name}", "left")
    line = {n: lin.of_call([F.col(f"{n}_{r}") for r in RANKS], F.col(f"t_{n}"), F.col(f"v_{n}")) for n in ("nt", "nr")}
    return out.select(headers.taxid_header(line["nr"], line["nt"], F.col("id")).alias("id"), "seq")


def located(records: DataFrame, size: Column) -> DataFrame:
    """Records of a taxid as they lie in a file sorted by (taxid, ordinal): first_byte and last_byte of each. records: taxid, ordinal.

    Sums by taxid give where each taxid starts, sums by stretches of ordinals where each stretch of a taxid does; no task sorts a whole taxid."""
    sized = records.where("taxid <> -1").withColumn("_n", size.cast("long"))
    starts = running(sized.groupBy("taxid").agg(F.sum("_n").alias("_bytes")), [], "taxid", "_bytes", "_start").select("taxid", "_start")
    rows = running(sized, ["taxid"], "ordinal", "_n", "_inside_taxid").join(starts, "taxid")
    first = F.col("_start") + F.col("_inside_taxid")
    return rows.withColumn("first_byte", first).withColumn("last_byte", first + F.col("_n") - 1).drop("_n", "_start", "_inside_taxid")


def locator(records: DataFrame, size: Column, hit_type: str) -> DataFrame:
    """(taxid, first_byte, last_byte, hit_type): the stretch of each taxid in the file sorted by taxid. Needs sums by taxid alone."""
    sums = records.where("taxid <> -1").groupBy("taxid").agg(F.sum(size.cast("long")).alias("n"))
    first = F.col("first")
    return running(sums, [], "taxid", "n", "first").select("taxid", first.alias("first_byte"), (first + F.col("n") - 1).alias("last_byte"), F.lit(hit_type).alias("hit_type"))


def record_bytes() -> Column:
    """Bytes of a record (id, seq) as FASTA text of two lines."""
    return F.octet_length("id") + F.octet_length("seq") + 3


def sorted_fasta(records: DataFrame, field: str) -> DataFrame:
    """(value, taxid, ordinal): the FASTA text of records (id, seq, ordinal) that have a taxid in a header field, in the order of the locator's file (taxid, then ordinal), dealt by ranges."""
    rows = records.withColumn("taxid", headers.header_taxid(F.col("id"), field)).where("taxid <> -1")
    return rows.repartitionByRange("taxid", "ordinal").sortWithinPartitions("taxid", "ordinal").select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value"), "taxid", "ordinal")


def locators(records: DataFrame) -> DataFrame:
    """The locators of all six header fields, of records (id, seq) as FASTA text."""
    size = record_bytes()
    out = None
    for field in headers.FIELDS:
        own = locator(records.withColumn("taxid", headers.header_taxid(F.col("id"), field)), size, field)
        out = own if out is None else out.unionByName(own)
    return out
