import pytest
from pyspark.sql import functions as F

from seqsluice.operators import counts, coverage, hits, reads, refine, taxonomy, tools

LINEAGES = [(1, 1, 10, 100), (2, 2, 20, 200), (3, 3, 30, 300), (4, 1, 10, 999)]
HIT = "qname string, tname string, pident double, alen long, mismatch long, gapopen long, evalue double, bitscore double, ordinal long"


def hit(name, acc, alen, bits, n):
    return (name, acc, 99.0, alen, 0, 0, 1e-40, bits, n)


@pytest.fixture()
def dictionaries(spark):
    acc = spark.createDataFrame([("ACC1", 1), ("ACC2", 1), ("SHORT", 1), ("OTHER", 2), ("ODD", 4), ("NONE", 0)], "accession string, taxid int")
    return acc, spark.createDataFrame(LINEAGES, "taxid int, species int, genus int, family int")


def call(spark, dictionaries, rows, **kw):
    return hits.summarize(spark.createDataFrame(rows, HIT), *dictionaries, ["ordinal"], **kw)


def test_consensus(spark, dictionaries):
    single = call(spark, dictionaries, [hit("r", "ACC1", 100, 200.0, 0)]).first()
    assert (single.level, single.taxid) == (3, 100)
    two = call(spark, dictionaries, [hit("r", "ACC1", 100, 200.0, 0), hit("r", "ODD", 100, 199.0, 1)]).first()
    assert (two.level, two.taxid, two.family) == (2, 10, 100)
    apart = call(spark, dictionaries, [hit("r", "ACC1", 100, 200.0, 0), hit("r", "OTHER", 100, 199.0, 1)]).first()
    assert (apart.level, apart.taxid, apart.species) == (0, 0, 1)
    assert call(spark, dictionaries, [hit("r", "ACC1", 100, 200.0, 0), hit("r", "ODD", 100, 199.0, 1)], mode="lca").first().level == 1
    assert call(spark, dictionaries, [hit("r", "NONE", 100, 1.0, 0), hit("r", "MISSING", 100, 1.0, 0)]).count() == 0
    assert call(spark, dictionaries, [hit("r", "ACC1", 100, 200.0, 0)], removed=[100]).count() == 0


def test_best_hit_ties_go_to_the_first(spark, dictionaries):
    rows = [hit("read1", "SHORT", 20, 500.0, 0), hit("read1", "ACC2", 100, 150.0, 1), hit("read1", "ACC1", 100, 150.0, 2)]
    assert call(spark, dictionaries, rows, least=50).first().accession == "ACC2"
    assert hits.best_hits(spark.createDataFrame(rows, HIT).where("alen > 50"), [F.col("ordinal")]).first().tname == "ACC2"


def test_rollup(spark):
    schema = "read_id string, level int, taxid int, species int, genus int, family int, pident double, alen long, evalue double, cluster_size long, source string"
    rows = [("a", 1, 1, 1, 10, 100, 99.0, 100, 1e-20, 1, "NR"), ("b", 1, 1, 1, 10, 100, 97.0, 50, 0.0, 4, "NT"), ("c", 2, 20, 0, 20, 100, 90.0, 10, 1e-5, 1, "NT"), ("d", 0, 0, 1, 1, 1, 1.0, 1, 1.0, 1, "NT")]
    got = {(r.tax_level, r.tax_id): r for r in counts.rollup(spark.createDataFrame(rows, schema), "merged_NT_NR").collect()}
    assert set(got) == {(1, 1), (1, -100), (2, 10), (2, 20), (3, 100)}
    s = got[1, 1]
    assert (s.unique_count, s.nonunique_count, s.base_count, s.dcr, s.source_count_type, s.alignment_length) == (2, 5, 300, 2.5, ["NR", "NT"], 175.0)
    assert abs(s.e_value - (-20 - 307.6526555685888) / 2) < 1e-6
    assert (got[3, 100].unique_count, got[3, 100].genus_taxid, got[2, 20].genus_taxid) == (3, -200, 20)
    report = counts.combined_json(counts.rollup(spark.createDataFrame(rows, schema)), counts.rollup(spark.createDataFrame(rows, schema), "NR")).first().value
    assert report.startswith('{"pipeline_output":{"taxon_counts_attributes":[') and report.count("tax_id") == 10


def test_refined_counts_and_contig_summary(spark):
    rows = spark.createDataFrame([("a", 1, 5, 5, 50, "c1", 3, 99.0, 10, 0.1), ("b", 1, 5, 5, 50, "c1", 1, 97.0, 20, 0.3), ("c", 1, 6, 6, 50, None, 1, 90.0, 5, 0.1)], "read_id string, level int, taxid int, species int, genus int, contig_id string, cluster_size long, pident double, alen long, evalue double")
    got = {r.tax_id: r for r in counts.refined(rows).collect()}
    assert (got[5].nonunique_count, got[5].unique_count, got[5].dcr, got[5].base_count) == (2, 4, 2.0, 2)
    summary = counts.contig_summary(rows, 1)
    maps = {(r.tax_level, r.taxid): r.contig_counts for r in counts.contig_summary_rows(summary).collect()}
    assert maps == {(1, 5): {"c1": 4}, (1, 6): {"*": 1}, (2, 50): {"c1": 4, "*": 1}}
    assert counts.contig_summary(rows, 3).count() == 0


def test_hsps(spark):
    rows = spark.createDataFrame([("q", "a", 90.0, 10, 1, 0, 1e-5, 50.0, 0), ("q", "a", 80.0, 30, 2, 0, 1e-9, 60.0, 1), ("q", "b", 99.0, 5, 0, 0, 1e-9, 60.0, 2)], HIT)
    top = hits.top_nr(rows, ["ordinal"]).first()
    assert (top.tname, top.pident, top.alen, top.evalue, top.bitscore, top.mismatch, top.hsps) == ("a", 82.5, 40, 1e-9, 60.0, 2, 2)
    assert hits.top_nt(rows, [F.col("ordinal")]).first().alen == 30


def test_pairs(spark):
    rec = "struct<id:string,desc:string,seq:string,qual:string>"
    rows = [(0, ("read1/1", None, "ATCG", "IIII"), ("read1/2", None, "GCTA", "HHHH")), (1, ("x/1", None, "A", "I"), ("y/2", None, "C", "I")), (2, ("z/1", None, "A", "I"), None)]
    pairs = spark.createDataFrame(rows, f"ordinal long, r1 {rec}, r2 {rec}")
    assert tuple(reads.pair_stats(pairs, 2, 10).first()) == (1, 0, 0, 3)
    got = reads.concat_pairs(reads.pair_filter(pairs)).first()
    assert (got.id, got.seq, got.qual) == ("read1/1", "ATCGNGCTA", "IIII!HHHH")
    with pytest.raises(Exception, match="different templates"):
        reads.concat_pairs(pairs.where("ordinal = 1")).collect()
    with pytest.raises(Exception, match="different lengths"):
        reads.interleave(pairs).collect()


def test_sampling(spark):
    units = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 10 + 1).cast("double").alias("w"))
    a, b = ({r.id for r in reads.subsample(units, 100, s).collect()} for s in (1, 2))
    assert len(a) == 100 and a != b and a == {r.id for r in reads.subsample(units.repartition(7), 100, 1).collect()}
    assert reads.subsample(units, 5000).count() == 1000
    weights = [r.w for r in reads.subsample_weighted(units, 200, "w").collect()]
    assert len(weights) == 200 and sum(weights) / 200 > 6


def test_clusters(spark):
    rows = spark.createDataFrame([("c", 2, "AAAAC", "G"), ("a", 0, "AAAAT", "G"), ("b", 1, "AAAAC", "T")], "id string, ordinal long, seq1 string, seq2 string")
    got = {r.representative: (r["size"], r.members) for r in reads.dedup_clusters(rows, 4).collect()}
    assert got == {"a": (2, ["a", "c"]), "b": (1, ["b"])}
    assert reads.unique_reads(rows, 4).count() == 2


def test_refinement(spark):
    summary = spark.createDataFrame([("r1", 3, 100, "A", 1, 10, 100), ("r2", 3, 100, "A", 1, 10, 100)], "read_id string, level int, taxid int, accession string, species int, genus int, family int")
    r2c = spark.createDataFrame([("r1", "c1"), ("r3", "c1"), ("r2", "c9")], "read_id string, contig_id string")
    top = spark.createDataFrame([("c1", "B")], "qname string, tname string")
    acc = spark.createDataFrame([("B", 7, 70, 700)], "accession string, species int, genus int, family int")
    got = {r.read_id: r for r in refine.refined_summary(summary, refine.contig_calls(r2c, top, acc)).collect()}
    assert (got["r1"].taxid, got["r1"].level, got["r1"].accession, got["r1"].from_assembly) == (7, 1, "A", False)
    assert (got["r3"].taxid, got["r3"].accession, got["r3"].from_assembly) == (7, "B", True)
    assert (got["r2"].taxid, got["r2"].contig_id) == (100, None)


def test_locator(spark):
    rows = spark.createDataFrame([(">contig_a:species_nt:10:extra", "AAAA", 0), (">b:species_nt:-1:x", "C", 1), (">c:species_nt:5:x", "GG", 2), (">d:species_nt:10:x", "T", 3)], "id string, seq string, ordinal long")
    from seqsluice.functions.headers import header_taxid

    size = F.octet_length("id") + F.octet_length("seq") + 2
    taxa = rows.withColumn("taxid", header_taxid(F.col("id"), "species_nt"))
    stretches = {r.taxid: (r.first_byte, r.last_byte) for r in refine.locator(taxa, size, "NT").collect()}
    each = [(r.taxid, r.first_byte, r.last_byte) for r in refine.located(taxa, size).orderBy("first_byte").collect()]
    assert stretches == {5: (0, each[0][2]), 10: (each[1][1], each[2][2])}
    assert all(a[2] + 1 == b[1] for a, b in zip(each, each[1:]))


def test_depth(spark):
    rows = spark.createDataFrame([("c", 1, "3M2D2M"), ("c", 3, "2S2M1I1M4H")], "rname string, pos long, cigar string")
    depth = {r.pos: r.depth for r in coverage.depth_per_position(coverage.cigar_blocks(rows)).collect()}
    assert depth == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1}
    assert sum(r.depth for r in coverage.depth_per_position(coverage.cigar_blocks(rows, compat=True)).collect()) == 9
    lengths = spark.createDataFrame([("c", 8), ("empty", 4)], "ref string, length long")
    got = {r.ref: r for r in coverage.assembly_coverage(coverage.cigar_blocks(rows), lengths).collect()}
    assert (got["c"].avg, got["c"].max, got["c"].cnt0, got["c"].p50) == (1.0, 2, 0.125, 1) and (got["empty"].avg, got["empty"].cnt0) == (0.0, 1.0)


def test_statistics(spark):
    depths = spark.createDataFrame([(i,) for i in range(1, 8)], "depth int")
    assert tuple(coverage.depth_stats(depths).first())[:4] == (4.0, 2, 4, 6)
    hist = spark.createDataFrame([(100, 2), (200, 1), (300, 1)], "size long, count long")
    got = coverage.histogram_stats(hist).first()
    assert (got.n, got["mean"], got.median) == (4, 175.0, 100)
    lengths = spark.createDataFrame([(n,) for n in (2, 3, 4, 5, 6, 10, 10)], "length long")
    assert tuple(coverage.nx_lx(lengths, 0.5, [F.desc("length")]).first()) == (10, 2)
    assert tuple(coverage.nx_lx(lengths.limit(0), 0.5, [F.desc("length")]).first()) == (0, 0)
    spans = spark.createDataFrame([("a", 0, 5), ("a", 3, 8), ("a", 10, 11), ("a", 10, 11), ("b", 1, 1)], "k string, start long, end long")
    assert {r.k: r.covered for r in coverage.union_length(spans, ["k"]).collect()} == {"a": 9, "b": 0}


def test_accession_bins_of_a_contig(spark):
    hit_rows = [("A", "contig", 1, 4, 0, 4, 4, [2.0, 2.0, 4.0, 4.0]), ("A", "read", 8, 5, 0, 0, 1, [0.0])]
    rows = spark.createDataFrame(hit_rows, "accession string, kind string, start long, end long, query_start long, query_end long, total_length long, coverage array<double>")
    got = {r.bin: tuple(r)[2:] for r in coverage.accession_bins(rows, spark.createDataFrame([("A", 8)], "accession string, length long")).collect()}
    assert [got[b][0] for b in range(8)] == [2.0, 2.0, 4.0, 4.0, 1.0, 1.0, 1.0, 1.0] and got[0][1:] == (1.0, 1, 0)


def test_taxonomy(spark):
    nodes = spark.createDataFrame([(9, 1, "family"), (8, 9, "genus"), (7, 8, "species"), (6, 7, "strain"), (5, 4, "genus"), (4, 5, "species"), (3, 9, "species")], "taxid int, parent int, rank string")
    want = {9: (-1, -1, 9), 8: (-1, 8, 9), 7: (7, 8, 9), 6: (7, 8, 9), 3: (3, -1, 9)}
    got = {r.taxid: tuple(r)[1:] for r in taxonomy.lineages(nodes).collect()}
    assert {k: got[k] for k in want} == want and got[4] == (4, 5, -1) and got[5] == (4, 5, -1)
    chain = [(k, k - 1, "family" if k == 2 else "genus" if k == 3 else "species" if k == 400 else "no rank") for k in range(2, 401)]
    deep = {r.taxid: tuple(r)[1:] for r in taxonomy.lineages(spark.createDataFrame(chain, "taxid int, parent int, rank string")).collect()}
    assert deep[400] == (400, 3, 2) and deep[200] == (-1, 3, 2) and deep[2] == (-1, -1, 2)
    assert {r.taxid: tuple(r)[1:] for r in taxonomy.lineages_recursive(nodes.where("taxid NOT IN (4, 5)")).collect()} == want
    merged = taxonomy.merged_nodes(nodes, spark.createDataFrame([(3, 2), (2, 7), (77, 9)], "old int, new int"))
    assert {r.taxid: (r.parent, r["rank"]) for r in merged.collect()}[3] == (8, "species") and merged.count() == nodes.count()


def test_removed_taxa_as_a_table(spark):
    rows = spark.createDataFrame([("q", f"a{k}", 50) for k in range(6)], "qname string, tname string, alen int")
    acc = spark.createDataFrame([(f"a{k}", k + 1) for k in range(6)], "accession string, taxid int")
    tree = spark.createDataFrame([(k + 1, k + 1, 10 + k % 2, 20 + k % 3) for k in range(5)], "taxid int, species int, genus int, family int")
    gone = [2, 21, 9999]
    listed = hits.resolved(rows, acc, tree, removed=gone).collect()
    table = hits.resolved(rows, acc, tree, removed=spark.createDataFrame([(t,) for t in [*gone, -1, None]], "taxid int"))
    assert sorted(map(str, listed)) == sorted(map(str, table.collect())) and {r.tname for r in listed} == {"a0", "a2", "a3", "a5"}


def test_tools(spark):
    assert tools.arguments("blastn", 8, reads="q.fa", db="nt")[-1] == "8" and "5000" in tools.arguments("blastn")
    assert tools.version_ok("samtools", "1.20") and not tools.version_ok("samtools", "1.9".replace("9", "1"))
    with pytest.raises(ValueError, match="no arguments"):
        tools.arguments("nothing")
    got = tools.piped(spark.createDataFrame([("b",), ("a",)], "value string").coalesce(1), ["sort"])
    assert [r.value for r in got.collect()] == ["a", "b"]
    with pytest.raises(Exception, match="exited with 1"):
        tools.piped(spark.createDataFrame([("b",)], "value string"), ["false"]).collect()


def test_alignment_score():
    assert reads.alignment_score("ACGT", "ACGT") == 8
    assert reads.alignment_score("ACGT", "ACT") == 6 - 6
    assert reads.alignment_score("", "AC") == -7
