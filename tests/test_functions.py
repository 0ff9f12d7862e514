import pytest
from pyspark.sql import functions as F

from seqsluice.functions import alignments as al
from seqsluice.functions import headers as hd
from seqsluice.functions import lineage as lin


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


#: Ids made of a stem and what the rules know of mates: suffixes, numbers after a blank, and stems that differ.
PAIRS = [
    ("RUN7.42.1", "RUN7.42.2", True),
    ("RUN7.42 1", "RUN7.42 2", True),
    ("RUN7.42/1", "RUN7.42/2", True),
    ("RUN7.42.1", "RUN7.43.1", False),
    ("lane:3:tile:9 1:N:0:GGTA", "lane:3:tile:9 2:N:0:GGTA", True),
    ("alone", "alone", True),
    ("x9_R1", "x9_R2", True),
    ("x9", "y9", False),
]


def test_same_template(spark):
    rows = spark.createDataFrame(PAIRS, "a string, b string, same boolean")
    got = rows.select("same", hd.same_template(F.col("a"), F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [r.same for r in got]


@pytest.mark.parametrize(
    ("header", "prefix", "name", "desc"),
    [
        ("acc_7.1", ">", "acc_7.1", None),
        ("acc_7.1 a virus of something", ">", "acc_7.1", "a virus of something"),
        ("r5\twith a tab", "@", "r5", "with a tab"),
        ("@r5.2 len=99", "@", "r5.2", "len=99"),
        ("lonely ", ">", "lonely", None),
        ("r5.2.1 r5.2 len=99", "@", "r5.2.1", "r5.2 len=99"),
    ],
)
def test_headers(spark, header, prefix, name, desc):
    assert (one(spark, hd.header_id(F.lit(header), prefix)), one(spark, hd.header_desc(F.lit(header)))) == (name, desc)


def test_header_taxids(spark):
    assert one(spark, hd.header_taxid(F.lit("s9:species_nt:77:r"), "species_nt")) == 77
    assert one(spark, hd.header_taxid(F.lit("s9:species_nt:77:r"), "genus_nt")) == -1
    assert one(spark, hd.header_taxid(F.lit(">s9:species_nt:seven:r"), "species_nt")) == -1
    assert one(spark, hd.header_field_number(F.lit(">a:b:c"), "b")) == 2
    assert one(spark, hd.header_field_number(F.lit(">a:b:c"), "d")) == -1
    assert one(spark, hd.annotated_id(F.lit(None).cast("string"), F.lit("N1"), F.lit("r"))) == "NR::NT:N1:r"
    assert one(spark, hd.no_call_header(F.lit("r"))).endswith("species_nt:-100:r")
    assert one(spark, hd.last_part(F.lit("NR:x:NT:y:contig_1"))) == "contig_1"


def test_split_accessions(spark):
    assert one(spark, hd.split_accessions(F.lit(">a,b,c"))) == ">a\x01b\x01c"
    assert one(spark, hd.split_accessions(F.lit(">a, b,c"))) == ">a, b,c"
    assert one(spark, hd.split_accessions(F.lit("a,b"))) == "a,b"


def test_names():
    assert hd.mate_file("x_R1_001.fastq") == "x_R2_001.fastq" or hd.mate_file("x_R1.fastq") == "x_R2.fastq"
    assert [hd.sample_name(n) for n in ("a_S1_L001_R1_001.fastq.gz", "a_R1_001.fq", "dir/a_1.fastq", "a-2.fastq.gz", "a.fastq")] == ["a"] * 5
    assert hd.find_pairs(["s_R2.fastq.gz", "s_r1.FASTQ", "t_1.fastq", "s_1.txt"], "s") == ["s_R2.fastq.gz", "s_r1.FASTQ"]
    assert hd.file_kind("x.FQ.gz") == ("fastq", True) and hd.file_kind("x.fna") == ("fasta", False) and hd.file_kind("x.txt")[0] is None
    assert hd.renamed("a.fq.gz", "p", "q") == "p_a_q.fq.gz"


@pytest.mark.parametrize(
    ("lineage", "taxid", "level", "want"),
    [
        ((10, 20, 30), 999, 0, (-100, -200, -300)),
        ((10, 20, 30), 10, 1, (10, 20, 30)),
        ((0, 20, 30), 20, 2, (-100, 20, 30)),
        ((0, 0, 30), 30, 3, (-100, -200, 30)),
        ((5, 0, 0), 5, 1, (5, -205, -95)),
    ],
)
def test_validated(spark, lineage, taxid, level, want):
    cols = lin.validated([F.lit(x) for x in lineage], F.lit(taxid), F.lit(level))
    assert tuple(spark.range(1).select(*cols).first()) == want


def test_lineage_of_call(spark):
    line = [F.lit(11), F.lit(22), F.lit(33)]
    of = lambda t, v: tuple(spark.range(1).select(*lin.of_call(line, F.lit(t).cast("int"), F.lit(v).cast("int"))).first())
    assert of(42, 1) == (11, 22, 33) and of(42, 2) == (-100, -200, -300) and of(None, None) == (-1, -1, -1)


@pytest.mark.parametrize(("ids", "ok"), [([333], True), ([444, 999], True), ([222], False), ([111], False), ([9605], False), ([9606], False), ([333, 222], False), ([7], False)])
def test_kept(spark, ids, ok):
    assert one(spark, lin.kept([F.lit(i) for i in ids], [111, 222], [333, 444])) is ok
    assert one(spark, lin.kept([F.lit(7), F.lit(-1)])) is True


def test_numbers(spark):
    got = spark.range(1).select(*[al.rounded(F.lit(x)) for x in (0.01234, 0.456, 12.34)]).first()
    assert tuple(got) == (0.012, 0.46, 12.3)
    assert one(spark, al.gap_openings(F.lit("10M2I5D"))) == 2
    assert one(spark, al.rescaled(F.lit(5.0), F.lit(0.0), F.lit(10.0), F.lit(100.0), F.lit(200.0))) == 150.0


def test_flags(spark):
    flag = F.col("f")
    rows = spark.createDataFrame([(0,), (4,), (256,), (2048,), (13,), (77,)], "f int")
    assert [r.x for r in rows.select(al.primary(flag).alias("x")).collect()] == [True, False, False, False, False, False]
    assert [r.x for r in rows.select(al.pair_unmapped(flag).alias("x")).collect()] == [False, False, False, False, True, True]
