"""Taxon counts: the roll-up over lineages, counts after refinement, contig summaries and their merges."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lineage as lin
from ..schemas import RANKS

LEAST_EVALUE = sys.float_info.min


def rollup(calls: DataFrame, count_type: str = "NT", removed: list[int] = (), allowed: list[int] | None = None) -> DataFrame:
    """Counts by species, genus and family, as one aggregation over grouping sets: partial sums by (species, genus, family) before the shuffle.

    calls: a row a read with level, taxid, its lineage, pident, alen, evalue, cluster_size and source. Calls without a taxid or level are left out,
    as are those whose validated lineage fails the keep filter. Logs of evalues have a floor; a protein read's length counts three times in a merged table.
    Ids of "no specific call" are keys like others; the level comes from grouping_id(), never from a null."""
    cleaned = lin.validated([F.col(r) for r in RANKS], F.col("taxid"), F.col("level"))
    rows = calls.where("taxid > 0 AND level > 0").withColumns({f"_{r}": v for r, v in zip(RANKS, cleaned)})
    rows = rows.where(lin.kept([F.col(f"_{r}") for r in RANKS], removed, allowed))
    length = F.col("alen") * (F.when(F.col("source") == "NR", 3).otherwise(1) if count_type == "merged_NT_NR" else F.lit(1))
    rows = rows.select(*[F.col(f"_{r}").alias(r) for r in RANKS], "cluster_size", "pident", "source", length.cast("double").alias("length"), (F.col("alen") * F.col("cluster_size")).alias("bases"), F.log10(F.greatest("evalue", F.lit(LEAST_EVALUE))).alias("log_e"))
    s, g, f = (F.col(r) for r in RANKS)
    sets = rows.groupingSets([[s, g, f], [g, f], [f]], s, g, f).agg(
        F.grouping_id().alias("gid"),
        F.sum("cluster_size").alias("nonunique_count"),
        F.count("*").alias("unique_count"),
        F.sum("bases").alias("base_count"),
        F.sum("pident").alias("sum_pident"),
        F.sum("length").alias("sum_length"),
        F.sum("log_e").alias("sum_log_e"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )
    return finalised(sets, count_type)


def finalised(sets: DataFrame, count_type: str) -> DataFrame:
    """Buckets to taxon counts: the key's first id and its level, means over unique reads, the duplicate ratio, sources or null."""
    level = F.when(F.col("gid") == 0, 1).when(F.col("gid") == 4, 2).otherwise(3)
    key = F.when(F.col("gid") == 0, F.col("species")).when(F.col("gid") == 4, F.col("genus")).otherwise(F.col("family"))
    mean = lambda c: F.col(c) / F.col("unique_count")
    return sets.select(
        key.alias("tax_id"),
        level.alias("tax_level"),
        F.when(F.col("gid") == 6, lin.NOT_SPECIFIC[1]).otherwise(F.col("genus")).alias("genus_taxid"),
        F.col("family").alias("family_taxid"),
        F.col("unique_count").alias("count"),
        "nonunique_count",
        "unique_count",
        mean("nonunique_count").alias("dcr"),
        mean("sum_pident").alias("percent_identity"),
        mean("sum_length").alias("alignment_length"),
        mean("sum_log_e").alias("e_value"),
        F.lit(count_type).alias("count_type"),
        "base_count",
        F.when(F.size("sources") > 0, F.col("sources")).alias("source_count_type"),
    )


def refined(calls: DataFrame, count_type: str = "NT") -> DataFrame:
    """Counts of refined calls by taxid alone. Here nonunique is the number of calls and unique the sum of cluster sizes, as consumers of this table expect; bases count one a call."""
    rows = calls.where("taxid > 0 AND level > 0").groupBy("taxid").agg(F.count("*").alias("nonunique_count"), F.sum("cluster_size").alias("unique_count"), F.avg("pident").alias("percent_identity"), F.avg("alen").alias("alignment_length"), F.avg("evalue").alias("e_value"))
    return rows.select(F.col("taxid").alias("tax_id"), F.lit(1).alias("tax_level"), "nonunique_count", "unique_count", (F.col("unique_count") / F.col("nonunique_count")).alias("dcr"), "percent_identity", "alignment_length", "e_value", F.col("nonunique_count").alias("base_count"), F.lit(count_type).alias("count_type"))


def contig_summary(calls: DataFrame, least: int = 4) -> DataFrame:
    """(taxid, tax_level, contig, reads, weighted) by species and by genus: reads of a contig (* without one) and their clusters' sizes, where there are at least `least` reads."""
    contig = F.coalesce("contig_id", F.lit("*")).alias("contig")
    pairs = F.explode(F.array(F.struct(F.lit(1).alias("tax_level"), F.col("species").alias("taxid")), F.struct(F.lit(2).alias("tax_level"), F.col("genus").alias("taxid"))))
    rows = calls.select(contig, "cluster_size", pairs.alias("t")).where("t.taxid > 0")
    return rows.groupBy("t.taxid", "t.tax_level", "contig").agg(F.count("*").alias("reads"), F.sum("cluster_size").alias("weighted")).where(F.col("reads") >= least)


def contig_summary_rows(summary: DataFrame) -> DataFrame:
    """(taxid, tax_level, contig_counts), the counts as a map."""
    entries = F.array_sort(F.collect_list(F.struct("contig", "weighted")))
    return summary.groupBy("taxid", "tax_level").agg(F.map_from_entries(entries).alias("contig_counts"))


def prefer_first(first: DataFrame, second: DataFrame, key: str = "contig_name") -> DataFrame:
    """first, and second's rows whose key first doesn't have."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))


def chosen_source(nt: DataFrame, nr: DataFrame, exclusive: bool = True) -> DataFrame:
    """A read's call of both databases, with its source: the nucleotide call if it comes from a contig, or if the protein call has no contig and there is a nucleotide one; else the protein call. exclusive=False keeps a protein call beside a nucleotide one."""
    def own(df: DataFrame, mark: str) -> DataFrame:
        return df.select("read_id", F.struct(*[c for c in df.columns if c not in ("read_id", "source")]).alias(mark))

    both = own(nt, "a").join(own(nr, "b"), "read_id", "full")
    contig = lambda m: F.col(f"{m}.contig_species") > 0
    call = F.coalesce(F.col("a.species") > 0, F.lit(False))
    take = F.coalesce(contig("a"), F.lit(False)) | (~F.coalesce(contig("b"), F.lit(False)) & call)
    nt_rows = both.where(take).select("read_id", "a.*", F.lit("NT").alias("source"))
    rest = both.where(F.col("b").isNotNull() & (~take if exclusive else F.lit(True)))
    return nt_rows.unionByName(rest.select("read_id", "b.*", F.lit("NR").alias("source")))


def combined_json(nt: DataFrame, nr: DataFrame) -> DataFrame:
    """One row: both tables as the report's JSON. The report is as long as there are taxa."""
    rows = nt.withColumn("_o", F.lit(0)).unionByName(nr.withColumn("_o", F.lit(1)))
    own = [c for c in nt.columns]
    ordered = F.array_sort(F.collect_list(F.struct("_o", "tax_level", "tax_id", F.struct(*own).alias("row"))))
    return rows.agg(F.to_json(F.struct(F.struct(F.transform(ordered, lambda x: x["row"]).alias("taxon_counts_attributes")).alias("pipeline_output"))).alias("value"))


def log_evalue(evalue: Column) -> Column:
    return F.log10(F.greatest(evalue, F.lit(LEAST_EVALUE)))
