import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from seqsluice.functions import alignments as al
from seqsluice.sources import bam, files, sinks, tabular

BASIC = "q7\t120\t3\t118\t+\tXX_000001.3\t4000\t40\t155\t111\t115\t50"
TAGS = "q8\t90\t5\t85\t-\tYY7\t2600\t300\t382\t76\t82\t20\tcg:Z:40M1I30M3D9M\tNM:i:6\tAS:i:61"
M8 = "q1\tZZ_000009.1\t97.250\t200\t5\t1\t1\t200\t31\t229\t4.5e-60\t212.5\t200\t8000"


def test_m8(lines):
    text = lines(M8, M8 + "\textra", M8 + "   ", "", "read1\tx\t99", M8.replace("\t200\t5\t", "\t\t5\t"), M8.replace("\t200\t5\t", "\t-1\t5\t"), M8.replace("4.5e-60", "0"))
    rows = tabular.parse_m8(text).collect()
    assert len(rows) == 4 and {r.tname for r in rows} == {"ZZ_000009"} and rows[0].evalue == 4.5e-60 and rows[0].slen == 8000
    narrow = tabular.parse_m8(lines("\t".join(M8.split("\t")[:12])), wide=False).first()
    assert (narrow.qlen, narrow.slen, narrow.bitscore) == (0, 0, 212.5)
    with pytest.raises(Exception, match="malformed row"):
        tabular.parse_m8(lines("a\tb"), strict=True).collect()


def test_paf(lines, spark):
    rows = {r.qname: r for r in tabular.parse_paf(lines(BASIC, TAGS, BASIC.replace("+", "x"), "#c", "", "short\t1", BASIC.replace("q7", "r6") + "   ", BASIC.replace("q7", "r7") + "\tbadtag\tgood:Z:value\tNM:i:5\tincomplete:")).collect()}
    assert set(rows) == {"q7", "q8", "r6", "r7"}
    assert rows["q8"].tags == {"cg": "40M1I30M3D9M", "NM": "6", "AS": "61"} and rows["r7"].tags == {"good": "value", "NM": "5"} and rows["r6"].mapq == 50
    paf = tabular.parse_paf(lines(TAGS))
    m8 = paf.select(*[c.alias(n) for n, c in al.m8_of_paf(29903.0).items()]).first()
    assert (m8.tname, m8.mismatch, m8.gapopen, m8.qstart, m8.tstart, m8.tend, m8.alen) == ("YY7", 6, 2, 6, 382, 301, 82)
    assert abs(m8.bitscore - (1.58 * 70 + 2.302585093) / 0.693147181) < 1e-4
    assert paf.select(al.paf_line().alias("x")).first().x.startswith("q8\t90\t5")
    assert paf.select(*[c.alias(n) for n, c in al.m8_of_paf().items()]).select(al.m8_line().alias("x")).first().x.count("\t") == 13


def test_small_parsers(lines):
    assert sorted(r.taxid for r in tabular.parse_taxids(lines("1", "2", "abc", "2", "  3  ")).collect()) == [1, 2, 3]
    assert [tuple(r) for r in tabular.parse_nodes(lines("1\t|\t1\t|\tno rank\t|", "9\t|\t1\t|\tfamily\t|", "x\t|\t2\t|\tgenus\t|")).collect()] == [(9, 1, "family")]
    assert [tuple(r) for r in tabular.parse_acc2taxid(lines("accession\taccession.version\ttaxid\tgi", "A\tA.1\t5\t0", "B.2\t7")).collect()] == [("A", 5), ("B", 7)]
    assert {r.key: r.value for r in tabular.parse_stats_summary(lines("SN\treads mapped:\t12", "# SN\tx:\t3\t# c")).collect()} == {"reads mapped": "12", "x": "3"}
    assert [tuple(r) for r in tabular.parse_insert_sizes(lines("IS\t100\t9\t5\t1\t0", "IS\t101\t0\t0\t0\t0")).collect()] == [(100, 6)]
    assert tuple(tabular.spike_stats(lines("SN\treads mapped:\t12", "SN\treads mapped and paired:\t10")).first()) == (12, 10)
    assert tuple(tabular.variant_counts(lines("SN\t0\tnumber of SNPs:\t3", "SN\t0\tnumber of indels:\t1")).first()) == (3, 0, 1)
    vcf = lines("#CHROM", "c\t1\t.\tA\tC,T\t.", "c\t2\t.\tAC\tG\t.", "c\t3\t.\tAC\tGT\t.")
    assert tuple(tabular.variant_classes(tabular.parse_vcf(vcf)).first()) == (1, 1, 1)
    seqkit = tabular.parse_seqkit(lines("file format type num_seqs sum_len min_len avg_len max_len", "a.fq FASTQ DNA 1,000 150,000 150 150.5 151")).first()
    assert (seqkit.num_seqs, seqkit.sum_len, seqkit.avg_len) == (1000, 150000, 150.5)
    assert [tuple(r) for r in tabular.parse_json_map(lines('{"a": 3, "b": 4}')).collect()] == [("a", 3), ("b", 4)]
    assert tabular.count_sam(lines("@HD", "r\t0", "s\t4")).first()[0] == 2 and tabular.has_alignments(lines("@HD")) is False
    assert sorted(tuple(r) for r in tabular.read_accession(lines("a\tB.1\tx", "lonely", "\tz", "q\t")).collect()) == [("a", "B.1")]
    assert [r.target_id for r in tabular.spike_counts(tabular.parse_abundance(lines("target_id\ta\tb\test_counts\tt", "ERCC-1\t1\t1\t5.0\t1", "T\t1\t1\t2\t1"))).collect()] == ["ERCC-1"]
    assert tuple(tabular.parse_depth(lines("c\t1\t4", "bad", "c\t2\t5"), strict=False).agg(F.sum("depth"), F.count("pos")).first()) == (9, 2)
    assert tuple(tabular.parse_depth(lines("c\t1\t4", "c\t2\t5")).agg(F.sum("depth"), F.count("pos")).first()) == (9, 2)
    for bad in ("bad", "c\tx\t4", "c\t1\t4\t5"):
        with pytest.raises(Exception, match="bad depth line"):
            tabular.parse_depth(lines("c\t1\t4", bad)).collect()
    with pytest.raises(ValueError, match="no depth lines"):
        tabular.parse_depth(lines("x").limit(0))
    with pytest.raises(Exception, match="bad taxid: x"):
        tabular.parse_acc2taxid(lines("A\tA.1\tx\t0")).collect()
    assert tabular.parse_acc2taxid(lines("A\tA.1\tx\t0"), strict=False).isEmpty()


def test_fasta_and_fastq(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one two\nACGT\nAC\n>y\nGG\n")
    rows = files.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("ordinal").collect()
    assert [(r.id, r.desc, r.seq) for r in rows] == [("x", "one two", "ACGTAC"), ("y", None, "GG")]
    fq = b"@r1 d\nACGT\n+\n@III\n@r2\nAC\n+\nII\n@bad\nAC\n-\nII\n@r4\nAC\n+\nII\n"
    with gzip.open(tmp_path / "a.fq.gz", "wb") as f:
        f.write(fq)
    got = files.read_fastq(spark, [str(tmp_path / "a.fq.gz")])
    assert [(r.ordinal, r.id, r.desc, r.seq, r.qual) for r in got.orderBy("ordinal").collect()] == [(0, "r1", "d", "ACGT", "@III"), (1, "r2", None, "AC", "II")]
    with pytest.raises(Exception, match="malformed FASTQ"):
        files.read_fastq(spark, [str(tmp_path / "a.fq.gz")], strict=True).collect()
    sinks.write_fastq(got, str(tmp_path / "out"))
    again = [l for p in sorted((tmp_path / "out").glob("part*")) for l in p.read_text().splitlines()]
    assert sorted(again) == sorted(fq.decode().splitlines()[:8])
    assert files.find_files(spark, str(tmp_path), ("fq", "fa"))[0].endswith((".fa", ".gz"))
    with pytest.raises(FileNotFoundError):
        files.find_files(spark, str(tmp_path), ("bam",))


def test_fasta_in_splits(spark, tmp_path):
    """A file of many splits has ordinals in its order; a blank line may end a file; headers may stay whole; small files are told."""
    text = "".join(f">r{i} d{i}\nAC\nGT{'A' * (i % 7)}\n" for i in range(400))
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "b.fa").write_text(">x one\nAC\n\nGT\n>y\nTT\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = files.read_fasta(spark, str(tmp_path / "a.fa"))
        assert rows.rdd.getNumPartitions() > 4
        assert [(r.ordinal, r.id, r.seq) for r in rows.orderBy("ordinal").collect()] == [(i, f"r{i}", f"ACGT{'A' * (i % 7)}") for i in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    paths = [str(tmp_path / "a.fa"), str(tmp_path / "b.fa")]
    assert [(r.id, r.seq) for r in files.read_fasta(spark, paths[1]).orderBy("ordinal").collect()] == [("x", "ACGT"), ("y", "TT")]
    cut = files.read_fasta(spark, paths, until_blank=True)
    assert cut.count() == 401 and [(r.id, r.seq) for r in cut.where("id IN ('x', 'y')").collect()] == [("x", "AC")]
    assert files.whole_headers(cut).where("ordinal = 0 AND id = 'x one' AND desc IS NULL").count() == 1
    assert files.too_small(spark, paths[1], 25) and not files.too_small(spark, paths[0], 25) and files.too_small(spark, str(tmp_path / "none"), 1)


@pytest.mark.parametrize("split", [90, 1000, 1 << 20])
def test_fastq_in_stretches(spark, tmp_path, split):
    """Qualities that look like headers, records longer than a stretch, a malformed record in the middle."""
    rng = random.Random(split)
    records = []
    for i in range(40):
        n = rng.choice((1, 3, 9, 120))
        records.append(f"@r{i} x\n{''.join(rng.choices('ACGT', k=n))}\n+\n{''.join(rng.choices('@+I', k=n))}\n")
    (tmp_path / "a.fq").write_text("".join(records))
    (tmp_path / "b.fq").write_text("".join(records[:9]) + "@bad\nAC\n-\nII\n" + "".join(records[9:]))
    paths = [str(tmp_path / "a.fq"), str(tmp_path / "b.fq")]
    got = files.read_fastq(spark, paths, split=split).collect()
    for path, n in zip(paths, (len(records), 9)):
        own = sorted((r.ordinal, r.id, r.seq, r.qual) for r in got if r.source == path)
        assert own == [(i, *(x.split("\n")[k].lstrip("@").split(" ")[0] if k == 0 else x.split("\n")[k] for k in (0, 1, 3))) for i, x in enumerate(records[:n])]
    with pytest.raises(Exception, match="malformed FASTQ"):
        files.read_fastq(spark, paths[1:], strict=True, split=split).collect()
    assert files.read_fastq(spark, paths[:1], strict=True, split=split).count() == len(records)
    (tmp_path / "z.fq").write_bytes(gzip.compress("".join(records).encode()))
    assert files.read_fastq(spark, [*paths[:1], str(tmp_path / "z.fq")], strict=True, split=split).count() == 2 * len(records)
    (tmp_path / "c.fq").write_text("".join(records) + "@cut\nACGT\n")
    assert files.read_fastq(spark, [str(tmp_path / "c.fq")], split=split).count() == len(records)
    with pytest.raises(Exception, match="malformed FASTQ"):
        files.read_fastq(spark, [str(tmp_path / "c.fq")], strict=True, split=split).collect()


def test_pairs_of_files(spark, tmp_path):
    (tmp_path / "1.fq").write_text("@a/1\nAC\n+\nII\n@b/1\nACG\n+\nIII\n")
    (tmp_path / "2.fq").write_text("@a/2\nGG\n+\nII\n")
    rows = files.read_pairs(spark, [str(tmp_path / "1.fq")], [str(tmp_path / "2.fq")]).orderBy("ordinal").collect()
    assert [(r.r1.id, r.r2 and r.r2.id) for r in rows] == [("a/1", "a/2"), ("b/1", None)]


def test_bam(spark, tmp_path):
    name, cigar, seq = b"r1\0", struct.pack("<I", 4 << 4), bytes([0x12, 0x48])
    body = struct.pack("<iiBBHHHiiii", 0, 9, len(name), 60, 0, 1, 99, 4, 0, 29, 24) + name + cigar + seq + bytes([30] * 4)
    body += b"NMC\x03" + b"ASs" + struct.pack("<h", -7) + b"XAAq" + b"MDZ4\0" + b"XBBs" + struct.pack("<i2h", 2, 5, -6) + b"XFf" + struct.pack("<f", 0.5)
    data = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 4) + b"chr\0" + struct.pack("<i", 1000) + struct.pack("<i", len(body)) + body
    (tmp_path / "a.bam").write_bytes(gzip.compress(data))
    row = files.read_bam(spark, [str(tmp_path / "a.bam")]).first()
    assert tuple(row) == ("r1", 99, "chr", 10, 60, "4M", "=", 30, 24, "ACGT", "????", "NM:i:3\tAS:i:-7\tXA:A:q\tMD:Z:4\tXB:B:s,5,-6\tXF:f:0.5")


@pytest.mark.parametrize("split", [61, 700, 3000, 1 << 20])
def test_bam_in_stretches(spark, tmp_path, split):
    """Blocks of a few bytes, records over many blocks, an empty block in the middle and at the end."""
    rng = random.Random(2)
    want, body = [], [b"BAM\1" + struct.pack("<ii", 3, 0x0A0A0A), struct.pack("<i", 2), struct.pack("<i", 3) + b"r0\0" + struct.pack("<i", 99), struct.pack("<i", 3) + b"r1\0" + struct.pack("<i", 99)]
    body[0] = b"BAM\1" + struct.pack("<i", 3) + b"@HD"
    for i in range(120):
        n, name = rng.choice((0, 1, 7, 40, 900)), f"read{i}" + "x" * rng.randrange(30)
        seq = bytes(rng.randrange(256) for _ in range((n + 1) // 2))
        block = struct.pack("<iiBBHHHiiii", rng.randrange(-1, 2), i, len(name) + 1, 9, 0, 1, 16, n, -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", n << 4) + seq + bytes([30] * n) + b"ASi" + struct.pack("<i", i)
        body.append(struct.pack("<i", len(block)) + block)
        want.append((name, i + 1, n, f"AS:i:{i}"))
    data, out = b"".join(body), []

    def block(part):
        z = zlib.compressobj(1, zlib.DEFLATED, -15)
        packed = z.compress(part) + z.flush()
        return b"\x1f\x8b\x08\x04" + bytes(4) + b"\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(part), len(part))

    at = 0
    while at < len(data):
        n = rng.choice((5, 90, 400, 3000))
        out.append(block(data[at : at + n]))
        at += n
        if rng.random() < 0.1:
            out.append(block(b""))
    (tmp_path / "a.bam").write_bytes(b"".join([*out, block(b"")]))
    size = sum(map(len, out)) + len(block(b""))
    if split == 61:  # stretches shorter than blocks, without a session
        rows = [r for s in range(0, size, split) for r in bam.records(str(tmp_path / "a.bam"), s, min(size, s + split))]
        got = [(r[0], r[3], 0 if r[9] == "*" else len(r[9]), r[11]) for r in rows]
    else:
        got = [(r.qname, r.pos, 0 if r.seq == "*" else len(r.seq), r.tags) for r in files.read_bam(spark, [str(tmp_path / "a.bam")], split).orderBy("pos").collect()]
    assert got == want
    cut = (tmp_path / "a.bam").read_bytes()
    (tmp_path / "b.bam").write_bytes(b"".join([*out[:-1], block(out and b"x" * 50)]))
    with pytest.raises(Exception, match="malformed|no whole"):
        files.read_bam(spark, [str(tmp_path / "b.bam")]).collect()
    assert len(cut) == size


def test_synthetic_reads(spark):
    rows = files.synthetic_reads(spark, 20, 50).collect()
    assert len({r.seq for r in rows}) == 20 and all(len(r.seq) == len(r.qual) == 50 and set(r.seq) <= set("ACGT") and all(33 <= ord(q) <= 73 for q in r.qual) for r in rows)
    assert files.synthetic_reads(spark, 1, 0).first().seq == ""


def test_summary_text_forms(spark):
    row = ("r", 1, 5, "ACC", 5, 50, 500, None, None, None, None, None, False, "NT")
    from seqsluice.schemas import HIT_SUMMARY

    df = spark.createDataFrame([row], HIT_SUMMARY)
    wide = sinks.wide_lines(df)
    assert wide.first().value.count("\t") == 27
    back = sinks.parse_wide(wide).first()
    assert (back.read_id, back.taxid, back.family, back.contig_id, back.from_assembly, back.source) == ("r", 5, 500, None, False, "NT")
    assert tuple(sinks.parse_narrow(sinks.narrow_lines(df)).first()) == ("r", "ACC", 5, 50, 500, 1)
