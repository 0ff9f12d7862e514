import datetime

import pytest

from seqsluice.__main__ import main
from seqsluice.operators import tools
from seqsluice.sources import sinks, tabular
from seqsluice.streaming import ingest


def test_dictionaries_from_the_command_line(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("".join(f"{t}\t|\t{p}\t|\t{r}\t|\n" for t, p, r in [(1, 1, "no rank"), (9, 1, "family"), (8, 9, "genus"), (7, 8, "species"), (5, 9, "species")]))
    (tmp_path / "merged.dmp").write_text("5\t|\t7\t|\n")
    main(["taxid_lineages", "--nodes", str(tmp_path / "nodes.dmp"), "--merged", str(tmp_path / "merged.dmp"), "--out", str(tmp_path / "lineages")], spark)
    assert {r.taxid: tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "lineages")).collect()} == {9: (-1, -1, 9), 8: (-1, 8, 9), 7: (7, 8, 9), 5: (5, 8, 9)}
    (tmp_path / "map.tsv").write_text("accession\taccession.version\ttaxid\tgi\nA\tA.1\t5\t0\nB\tB.1\t7\t0\nA\tA.2\t9\t0\n")
    (tmp_path / "a.fa").write_text(">A.1 one\nAC\nGT\n>C.1\nGG\n>A.2\nT\n")
    main(["accession2taxid", "--mapping", str(tmp_path / "map.tsv"), "--fasta", str(tmp_path / "a.fa"), "--out", str(tmp_path / "taxids")], spark)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "taxids")).collect()] == [("A", 9)]
    main(["fasta_offsets", "--fasta", str(tmp_path / "a.fa"), "--out", str(tmp_path / "offsets")], spark)
    assert {r.accession: r.offset for r in spark.read.parquet(str(tmp_path / "offsets")).collect()} == {"A": 0, "C": 14}
    with pytest.raises(FileNotFoundError):
        main(["fasta_offsets", "--fasta", str(tmp_path / "none.fa"), "--out", str(tmp_path / "x")], spark)


def test_steps_and_blocks():
    assert tools.diamond_block(64, 1e6) == 6.0 and tools.diamond_block(1800, 1e6) == 200.0 and tools.diamond_block(120, 1e6) == 8.0
    assert tools.diamond_block(120, 1e6, 7_000_000_000) == 7.0 and tools.diamond_block(120, 50) == 4.0 and tools.diamond_block(120, 60) == 8.0 * 0.7
    assert tools.split_index(["a.mmi", "a.part_002.mmi", "a.part_001.mmi", "b.part_001.mmi"], "a.mmi") == ["a.mmi", "a.part_001.mmi", "a.part_002.mmi"]
    with pytest.raises(ValueError, match="no .mmi"):
        tools.split_index(["a.fa"], "a.fa")
    with pytest.raises(FileNotFoundError):
        tools.split_index([], "a.mmi")
    steps = tools.mmseqs_steps("r.fa", "t.fa", "w", "o.m8", padded=True)
    assert [s[1] for s in steps] == ["createdb", "createdb", "makepaddedseqdb", "createindex", "search", "convertalis"]
    assert tools.index_steps("kallisto", "f", "o") == ["kallisto", "index", "-i", "o", "f"]
    assert tools.arguments("samtools", command="consensus", input="a.bam")[1] == "consensus" and "-b" in tools.arguments("diamond", block=6)


def test_records_of_a_program(spark):
    lines = spark.createDataFrame([("@r1 d",), ("AC",), ("+",), ("@I",)], "value string").coalesce(1)
    assert [tuple(r) for r in tools.piped_records(lines, ["cat"]).collect()] == [("r1", "d", "AC", "@I")]
    fasta = spark.createDataFrame([(">x a b",), ("AC",), ("GT",), (">y",)], "value string").coalesce(1)
    assert [tuple(r) for r in tools.piped_records(fasta, ["cat"], "fasta").collect()] == [("x", "a b", "ACGT", None), ("y", None, "", None)]
    with pytest.raises(Exception, match="malformed FASTQ"):
        tools.piped_records(fasta, ["cat"]).collect()
    assert [r.value for r in tools.piped(lines.limit(1), ["sh", "-c", "cat >&2"], stderr=True).collect()] == ["@r1 d"]


def test_no_contigs(spark):
    empty = spark.createDataFrame([], "ref string, " + ", ".join(f"{c} double" for c in ("avg", "min", "max", "p25", "p50", "p75", "avg2xcnt", "cnt0", "cnt1", "cnt2")))
    assert [r.contig_name for r in sinks.coverage_csv(empty).collect()] == ["No Contigs"]


def test_best_assembly(spark):
    meta = [(1, "GCF_1.1", "Scaffold", "2020-01-01"), (1, "GCF_2.1", "Complete", "2019-01-01"), (1, "GCA_3.1", "complete", "2021-05-01"), (2, "GCF_4.1", "contig", None), (2, "GCF_5.1", "Chromosome", "1999-01-01")]
    rows = [(t, k, '{"accession": "%s", "assembly_info": {"assembly_level": "%s"%s}}' % (a, level, f', "release_date": "{d}"' if d else "")) for k, (t, a, level, d) in enumerate(meta)]
    files = [(1, "x/GCF_1.1_n.fna"), (1, "x/GCF_2.1_n.fna"), (1, "x/GCA_3.1_n.fna"), (2, "x/GCF_4.1_n.fna")]
    got = tabular.best_assembly(spark.createDataFrame(rows, "taxid int, ordinal int, value string"), spark.createDataFrame(files, "taxid int, file string"), ["taxid"]).collect()
    assert {r.taxid: r.file for r in got} == {1: "x/GCA_3.1_n.fna", 2: "x/GCF_4.1_n.fna"}


def test_calls_of_a_stream(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, 0) + datetime.timedelta(seconds=s)
    rows = [(at(0), "r1", 1, 7, 8, 9), (at(5), "r1", 2, 7, 8, 9), (at(6), "r2", 1, 7, 8, 9), (at(7), "r2", 2, 6, 8, 9), (at(9000), "r3", 1, 7, 8, 9)]
    spark.createDataFrame(rows, "t timestamp, qname string, o int, species int, genus int, family int").selectExpr("*", "true AS known").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, qname string, o int, species int, genus int, family int, known boolean").parquet(str(tmp_path / "in"))
    said = []
    listener = ingest.Progress(said.append)
    spark.streams.addListener(listener)
    calls = ingest.read_calls(stream, ["o"], "t")
    calls.writeStream.format("memory").queryName("calls").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = {r.qname: (r.level, r.taxid, r.n_hits) for r in spark.table("calls").collect()}
    spark.streams.removeListener(listener)
    assert got == {"r1": (3, 9, 2), "r2": (0, 0, 2)}
