"""Alignments to calls: filtering, best hits, consensus over a taxonomy, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lineage as lin
from ..schemas import RANKS


def resolved(hits: DataFrame, acc2taxid: DataFrame, lineages: DataFrame, least: int = 36, removed: list[int] | DataFrame = (), allowed: list[int] | None = None) -> DataFrame:
    """Hits of at least `least` aligned bases whose accession has a positive taxid and whose lineage passes the keep filter, with hit_taxid, species, genus and family (-1 where the lineage is unknown) and known.

    The dictionaries join by key; where they are small, adaptive execution broadcasts them after measuring. A list of taxa to
    remove goes into the plan; one of any length can be a table (taxid) instead, which the lineages meet before the hits do."""
    if isinstance(removed, DataFrame):
        gone = removed.select("taxid").where("taxid > 0").distinct()
        for r in RANKS:
            lineages = lineages.join(gone.select(F.col("taxid").alias("_gone"), F.lit(True).alias(f"_{r}")), F.col(r) == F.col("_gone"), "left").drop("_gone")
        lineages = lineages.withColumn("_out", F.coalesce(*[f"_{r}" for r in RANKS], F.lit(False))).drop(*[f"_{r}" for r in RANKS])
        removed = ()
    else:
        lineages = lineages.withColumn("_out", F.lit(False))
    rows = hits.where(F.col("alen") >= least)
    rows = rows.join(acc2taxid.where("taxid > 0").select(F.col("accession").alias("tname"), F.col("taxid").alias("hit_taxid")), "tname")
    rows = rows.join(lineages.select(F.col("taxid").alias("hit_taxid"), *RANKS, "_out", F.lit(True).alias("known")), "hit_taxid", "left")
    rows = rows.where(~F.coalesce("_out", F.lit(False))).drop("_out")
    rows = rows.withColumns({r: F.coalesce(r, F.lit(-1)) for r in RANKS} | {"known": F.coalesce("known", F.lit(False))})
    return rows.where(lin.kept([F.col(r) for r in RANKS], removed, allowed))


def best_hits(hits: DataFrame, order: list[Column]) -> DataFrame:
    """A read's hit of the highest bitscore; ties go to the first in `order`, which must be total."""
    return _first(hits, [-F.col("bitscore"), *order])


def _first(hits: DataFrame, order: list[Column]) -> DataFrame:
    """A query's first row in an order. Spark limits ranks of a window before the shuffle, so a task passes one row a query on; an aggregate of structs (min_by) sorts as well and takes half as long again."""
    by = Window.partitionBy("qname").orderBy(*order)
    return hits.withColumn("_rn", F.row_number().over(by)).where("_rn = 1").drop("_rn")


def _agreed(mode: str) -> tuple[Column, Column]:
    """(level, taxid) of grouped hits. reference: how many ranks agree, from species up without a break; lca: the lowest rank that all agree on, 0 without one."""
    one = {r: (F.size(F.collect_set(F.when(F.col("known") & (F.col(r) > 0), F.col(r)))) == 1) for r in RANKS}
    value = {r: F.max(F.when(F.col("known") & (F.col(r) > 0), F.col(r))) for r in RANKS}
    s, g, f = RANKS
    if mode == "lca":
        return F.when(one[s], 1).when(one[g], 2).when(one[f], 3).otherwise(0), F.when(one[s], value[s]).when(one[g], value[g]).when(one[f], value[f]).otherwise(0)
    return F.when(~one[s], 0).when(~one[g], 1).when(~one[f], 2).otherwise(3), F.when(~one[s], 0).when(~one[g], value[s]).when(~one[f], value[g]).otherwise(value[f])


def consensus(hits: DataFrame, order: list[str], mode: str = "reference", removed: list[int] = (), allowed: list[int] | None = None, by: tuple = ("qname",)) -> DataFrame:
    """(by, level, taxid, species, genus, family, n_hits) of resolved hits: the level at which they agree and the first known hit's lineage.

    A call whose validated lineage fails the keep filter is level 0 and taxid 0 with no hits. One aggregation a read; no sort and no window."""
    level, taxid = _agreed(mode)
    place = F.struct(*order)
    calls = hits.groupBy(*by).agg(level.alias("level"), taxid.alias("taxid"), F.min_by(F.struct(*RANKS), F.when(F.col("known"), place)).alias("l"), F.count_if("known").alias("n_hits"))
    own = [c for c in calls.columns if c not in ("level", "taxid", "l", "n_hits")]
    first = [F.coalesce(F.col(f"l.{r}"), F.lit(-1)) for r in RANKS]
    passes = lin.kept(lin.validated(first, F.col("taxid"), F.col("level")), removed, allowed)
    none = ~passes | (F.col("n_hits") == 0)
    out = {"level": F.when(none, 0).otherwise(F.col("level")), "taxid": F.when(none, 0).otherwise(F.col("taxid")).cast("int"), "n_hits": F.when(none, 0).otherwise(F.col("n_hits")).cast("long")}
    out |= {r: F.when(none, -1).otherwise(v).cast("int") for r, v in zip(RANKS, first)}
    return calls.withColumns(out).select(*own, "level", "taxid", *RANKS, "n_hits")


def summarize(hits: DataFrame, acc2taxid: DataFrame, lineages: DataFrame, order: list[str], least: int = 36, mode: str = "reference", removed: list[int] = (), allowed: list[int] | None = None, source: str | None = None) -> DataFrame:
    """The hit summary: a row a read that has a surviving hit, with the consensus and the best hit's accession and scores.

    Hits of a read meet once: the best hit is an aggregate of the same groups as the consensus."""
    rows = resolved(hits, acc2taxid, lineages, least, removed, allowed)
    level, taxid = _agreed(mode)
    place = F.struct(*order)
    best = F.min_by(F.struct("tname", "pident", "alen", "evalue", "bitscore"), F.struct(-F.col("bitscore"), *order))
    calls = rows.groupBy("qname").agg(level.alias("level"), taxid.alias("taxid"), F.min_by(F.struct(*RANKS), F.when(F.col("known"), place)).alias("l"), F.count_if("known").alias("n"), best.alias("b"))
    first = [F.coalesce(F.col(f"l.{r}"), F.lit(-1)) for r in RANKS]
    none = ~lin.kept(lin.validated(first, F.col("taxid"), F.col("level")), removed, allowed) | (F.col("n") == 0)
    lineage = [F.when(none, -1).otherwise(v).cast("int").alias(r) for r, v in zip(RANKS, first)]
    return calls.select(F.col("qname").alias("read_id"), F.when(none, 0).otherwise(F.col("level")).alias("level"), F.when(none, 0).otherwise(F.col("taxid")).cast("int").alias("taxid"), F.col("b.tname").alias("accession"), *lineage, "b.pident", "b.alen", "b.evalue", "b.bitscore", F.lit(source).cast("string").alias("source"))


def top_nt(hits: DataFrame, order: list[Column]) -> DataFrame:
    """A query's top nucleotide hit: longest, then fewest mismatches and gaps, least evalue, highest bitscore, first in `order`."""
    return _first(hits, [-F.col("alen"), F.col("mismatch"), F.col("gapopen"), F.col("evalue"), -F.col("bitscore"), *order])


def merge_hsps(hits: DataFrame, order: list[str]) -> DataFrame:
    """(qname, tname, pident, alen, evalue, bitscore, hsps, and the representative's mismatch and gapopen): segments of a query and a subject as one; identity weighted by length, least evalue, highest bitscore, whose first row represents."""
    rep = F.min_by(F.struct("mismatch", "gapopen"), F.struct(-F.col("bitscore"), *order))
    rows = hits.groupBy("qname", "tname").agg((F.sum(F.col("pident") * F.col("alen")) / F.nullif(F.sum("alen"), F.lit(0))).alias("pident"), F.sum("alen").alias("alen"), F.min("evalue").alias("evalue"), F.max("bitscore").alias("bitscore"), F.count("*").alias("hsps"), rep.alias("r"))
    return rows.select("qname", "tname", F.coalesce("pident", F.lit(0.0)).alias("pident"), "alen", "evalue", "bitscore", "hsps", "r.mismatch", "r.gapopen")


def top_nr(hits: DataFrame, order: list[str]) -> DataFrame:
    """A query's top protein subject after merge_hsps: highest bitscore, least evalue, first name."""
    return _first(merge_hsps(hits, order), [-F.col("bitscore"), F.col("evalue"), F.col("tname")])


def merge_rows(hits: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a key as one: identity and evalue weighted by length, sums of lengths, mismatches, gaps and bitscores, widest coordinates."""
    w = lambda c: (F.sum(F.col(c) * F.col("alen")) / F.nullif(F.sum("alen"), F.lit(0))).alias(c)
    sums = [F.sum(c).alias(c) for c in ("alen", "mismatch", "gapopen", "bitscore")]
    return hits.groupBy(*key).agg(w("pident"), w("evalue"), *sums, *[F.min(c).alias(c) for c in ("qstart", "tstart")], *[F.max(c).alias(c) for c in ("qend", "tend")])


def reads_by_accession(summary: DataFrame) -> DataFrame:
    """(accession, species, genus, family, count): calls of an accession with a genus; the first read's lineage and the sum of cluster sizes."""
    rows = summary.where("accession <> '-' AND genus > 0")
    return rows.groupBy("accession").agg(F.min_by(F.struct(*RANKS), "read_id").alias("l"), F.sum("cluster_size").alias("count")).select("accession", "l.*", "count")


def reads_by_level(summary: DataFrame) -> DataFrame:
    """(read_id, accession, species, genus, family, assigned): species counts only where all ranks agree; the assigned taxid goes by level."""
    species = F.when((F.col("level") >= 3) & (F.col("species") > 0), F.col("species")).otherwise(0)
    assigned = F.when(F.col("level") >= 3, species).when(F.col("level") == 2, F.col("genus")).when(F.col("level") == 1, F.col("family")).otherwise(0)
    rows = summary.where("accession <> '-' AND genus > 0")
    return rows.select("read_id", "accession", species.cast("int").alias("species"), "genus", "family", assigned.cast("int").alias("assigned"))


def genera(summary: DataFrame) -> DataFrame:
    """(genus, reads, species, accessions) over the calls with a genus."""
    rows = summary.where("accession <> '-' AND genus > 0")
    return rows.groupBy("genus").agg(F.count("*").alias("reads"), F.count_distinct(F.when(F.col("species") > 0, F.col("species"))).alias("species"), F.array_sort(F.collect_set("accession")).alias("accessions"))


def selected_genera(summary: DataFrame, least_reads: int) -> DataFrame:
    """Genera of enough reads and more than one species, with the accessions to fetch."""
    return genera(summary).where((F.col("reads") >= least_reads) & (F.col("species") > 1))


def reference_sequences(sequences: DataFrame, accessions: DataFrame, longest: int = 100_000) -> DataFrame:
    """Sequences of the accessions, those over `longest` left out, in order of accession."""
    rows = sequences.join(accessions.select("accession").distinct(), "accession", "left_semi")
    return rows.where(F.char_length("seq") <= longest).orderBy("accession")


def fetch_counts(sequences: DataFrame, accessions: DataFrame, longest: int = 100_000) -> DataFrame:
    """(wanted, fetched, missing, too_long), one row: what reference_sequences finds of the accessions. With nothing fetched its FASTA is an empty file, which later steps take as the mark of none."""
    own = sequences.groupBy("accession").agg(F.min(F.char_length("seq")).alias("n"))
    rows = accessions.select("accession").distinct().join(own, "accession", "left")
    n = F.col("n")
    return rows.agg(F.count("*").alias("wanted"), F.count_if(n <= longest).alias("fetched"), F.count_if(n.isNull()).alias("missing"), F.count_if(n > longest).alias("too_long"))


def known_accessions(dictionary: DataFrame, *present: DataFrame) -> DataFrame:
    """The dictionary's rows for accessions that some of the tables have."""
    names = present[0].select("accession")
    for p in present[1:]:
        names = names.unionByName(p.select("accession"))
    return dictionary.join(names.distinct(), "accession", "left_semi")
