"""External programs: argument lists, and a stage that pipes records through one."""

from __future__ import annotations

import itertools
import shutil
import subprocess
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.files import record_of

#: Least versions of the programs.
LEAST_VERSIONS = {"samtools": 1.19, "bcftools": 1.19, "minimap2": 2.24, "kraken2": 2.1, "pigz": 2.8, "fastp": 1.0, "mafft": 7.5, "quast": 5.20, "seqkit": 2.10, "bowtie2": 2.50, "kallisto": 0.5, "hisat2": 2.20, "star": 2.7, "diamond": 2.1, "spades": 4.2, "blastn": 2.12, "blastx": 2.12, "makeblastdb": 2.12, "mmseqs": 0.0}
#: The columns that tabular aligners are asked for.
OUTFMT_14 = "6 qseqid sseqid pident length mismatch gapopen qstart qend sstart send evalue bitscore qlen slen"


def arguments(tool: str, threads: int = 4, **p: object) -> list[str]:
    """The program and its arguments, as the pipelines set them; p holds paths and what differs between uses."""
    t, g = str(threads), lambda k, d="-": str(p.get(k, d))
    made = {
        "fastp": lambda: ["fastp", "-i", g("input", "/dev/stdin"), "--stdout", "-w", t, "--length_required", "35", "--qualified_quality_phred", "17", "--unqualified_percent_limit", "15", "--n_base_limit", "15", "--low_complexity_filter", "--complexity_threshold", "60"],
        "minimap2": lambda: ["minimap2", "-t", t, *(["-c", "-x", "sr", "--secondary", "yes"] if p.get("paf", True) else ["-ax", g("preset", "sr")]), g("index"), g("reads")],
        "bowtie2": lambda: ["bowtie2", "-x", g("index"), "-p", t, "--very-sensitive-local", "-q", "--interleaved" if p.get("paired") else "-U", g("reads")],
        "hisat2": lambda: ["hisat2", "-x", g("index"), "-p", t, "-q", "-U", g("reads")],
        "star": lambda: ["STAR", "--genomeDir", g("index"), "--runThreadN", t, "--readFilesIn", g("reads"), "--outStd", "SAM"],
        "kallisto": lambda: ["kallisto", "quant", "-i", g("index"), "-o", g("out"), "-t", t, *([] if p.get("paired") else ["--single", "-l", "200", "-s", "20"]), g("reads")],
        "kraken2": lambda: ["kraken2", "--db", g("db"), "--threads", t, "--report", g("report"), "--classified-out", g("classified"), g("reads")],
        "samtools": lambda: ["samtools", "consensus", "-f", "fasta", "-m", "simple", "--min-BQ", g("quality", "20"), "-d", g("depth", "10"), "-@", t, g("input")] if p.get("command") == "consensus" else ["samtools", g("command", "view"), "-@", t, *map(str, p.get("args", []))],
        "bcftools": lambda: ["bcftools", g("command", "call"), *(["--ploidy", "1", "-m", "-v", "-P", g("theta", "0.6")] if p.get("command", "call") == "call" else ["-a", "AD", "-d", "10000"] if p.get("command") == "mpileup" else ["-f", g("reference")] if p.get("command") == "consensus" else [])],
        "seqkit": lambda: ["seqkit", "stats", "-j", t, g("reads")],
        "pigz": lambda: ["pigz", "-p", t, "-c"],
        "ivar": lambda: ["ivar", "consensus", "-q", "20", "-t", "0.75", "-m", g("depth", "10"), "-p", g("out")],
        "mafft": lambda: ["mafft", "--auto", "--thread", t, g("input")],
        "quast": lambda: ["quast.py", "-t", t, "-o", g("out"), "-r", g("reference"), g("input")],
        "nucmer": lambda: ["nucmer", "-t", t, "-p", g("out"), g("reference"), g("input")],
        "show-coords": lambda: ["show-coords", "-T", "-l", "-c", g("input")],
        "diamond": lambda: ["diamond", "blastx", "-d", g("db"), "-q", g("reads"), "-p", t, "--mid-sensitive", "-f", "6", *(["-b", g("block")] if p.get("block") else [])],
        "spades": lambda: ["spades.py", "--only-assembler", "-t", t, "-o", g("out"), "-s", g("reads")],
        "makeblastdb": lambda: ["makeblastdb", "-in", g("input"), "-dbtype", g("kind", "nucl"), "-out", g("db")],
        "blastn": lambda: ["blastn", "-query", g("reads"), "-db", g("db"), "-outfmt", OUTFMT_14, "-evalue", "1e-10", "-max_target_seqs", "5000", "-num_threads", t],
        "blastx": lambda: ["blastx", "-query", g("reads"), "-db", g("db"), "-outfmt", "6", "-evalue", "1e-10", "-num_alignments", "5", "-num_threads", t],
        "mmseqs": lambda: ["mmseqs", "easy-search", g("reads"), g("db"), g("out"), g("tmp", "tmp"), "-s", "5.7", "--max-seqs", g("max_seqs", "1000"), "-e", "0.001", "--min-seq-id", "0.25", "--threads", t],
        "sort": lambda: ["sort", "-k1,1", "-S", g("buffer", "8G"), "--parallel", t],
    }
    if tool not in made:
        raise ValueError(f"no arguments for {tool}")
    return made[tool]()


def index_steps(tool: str, fasta: str, out: str, threads: int = 4) -> list[str]:
    """The command that makes a tool's index of a reference."""
    t = str(threads)
    made = {
        "minimap2": ["minimap2", "-t", t, "-d", out, fasta],
        "bowtie2": ["bowtie2-build", "--threads", t, fasta, out],
        "hisat2": ["hisat2-build", "-p", t, fasta, out],
        "star": ["STAR", "--runMode", "genomeGenerate", "--runThreadN", t, "--genomeFastaFiles", fasta, "--genomeDir", out],
        "kallisto": ["kallisto", "index", "-i", out, fasta],
        "diamond": ["diamond", "makedb", "--in", fasta, "-d", out, "-p", t],
        "blastn": ["makeblastdb", "-in", fasta, "-dbtype", "nucl", "-out", out],
        "blastx": ["makeblastdb", "-in", fasta, "-dbtype", "prot", "-out", out],
    }
    if tool not in made:
        raise ValueError(f"no index of {tool}")
    return made[tool]


def split_index(names: list[str], index: str) -> list[str]:
    """An index file and the parts that it was split into (<name>.part_...mmi), among some file names; another extension or a missing file is an error."""
    stem, dot, ext = index.rpartition(".")
    if ext != "mmi":
        raise ValueError(f"{index} is no .mmi index")
    if index not in names:
        raise FileNotFoundError(index)
    return [index, *sorted(n for n in names if n.startswith(f"{stem}.part_") and n.endswith(".mmi"))]


#: GB of memory for each billion letters of a block, by the memory that there is; least and largest block; letters of the database where they aren't known.
BLOCK_MEMORY = ((1400.0, 9.0), (900.0, 10.0), (128.0, 12.0), (0.0, 15.0))
LEAST_BLOCK, MOST_BLOCK, LETTERS = 6.0, 200.0, 300_000_000_000
#: Scratch space is 3 GB a billion letters and 20 GB; with less than 1.2 or 1.5 times that, the block is cut to so much.
SCRATCH, SHORT = (3.0, 20.0), ((1.2, 0.5), (1.5, 0.7))


def diamond_block(memory_gb: float, scratch_gb: float, letters: int = LETTERS) -> float:
    """Billions of letters of the database that a protein search takes at once."""
    each = next(f for least, f in BLOCK_MEMORY if memory_gb >= least)
    block = min(MOST_BLOCK, max(LEAST_BLOCK, min(memory_gb / each, letters / 1e9)))
    need = SCRATCH[0] * block + SCRATCH[1]
    return block * next((cut for times, cut in SHORT if scratch_gb < times * need), 1.0)


def mmseqs_steps(reads: str, target: str, work: str, out: str, threads: int = 4, sensitivity: str = "5.7", max_seqs: int = 1000, padded: bool = False) -> list[list[str]]:
    """The search as steps: databases of the reads and the target (padded for a graphics card), its index, the search, and its hits as 12 columns."""
    t = ["--threads", str(threads)]
    made = [["mmseqs", "createdb", reads, f"{work}/reads"], ["mmseqs", "createdb", target, f"{work}/target"]]
    db = f"{work}/target"
    if padded:
        db += "_padded"
        made.append(["mmseqs", "makepaddedseqdb", f"{work}/target", db])
    made.append(["mmseqs", "createindex", db, f"{work}/tmp", *t])
    made.append(["mmseqs", "search", f"{work}/reads", db, f"{work}/hits", f"{work}/tmp", "-s", sensitivity, "--max-seqs", str(max_seqs), "-e", "0.001", "--min-seq-id", "0.25", "--alignment-mode", "3", *t, *(["--gpu", "1"] if padded else [])])
    made.append(["mmseqs", "convertalis", f"{work}/reads", db, f"{work}/hits", out, "--format-output", "query,target,pident,alnlen,mismatch,gapopen,qstart,qend,tstart,tend,evalue,bits", *t])
    return made


def version_ok(tool: str, found: str) -> bool:
    digits = "".join(c for c in found.strip().lstrip("v") if c.isdigit() or c == ".").split(".")
    return float(".".join(digits[:2]) or 0) >= LEAST_VERSIONS.get(tool, 0.0)


def piped_records(lines: DataFrame, command: list[str], kind: str = "fastq") -> DataFrame:
    """(id, desc, seq, qual) of the FASTQ or FASTA that a program makes of each partition's lines; what is no record is an error."""
    if kind not in ("fastq", "fasta"):
        raise ValueError(f"no records of {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (v for b in batches for v in b.column(0).to_pylist())
        made = fastq_records(lines) if kind == "fastq" else fasta_records_of(lines)
        while rows := list(itertools.islice(made, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["id", "desc", "seq", "qual"])

    return piped(lines, command).mapInArrow(run, "id string, desc string, seq string, qual string")


def fastq_records(lines: Iterator[str]) -> Iterator[tuple]:
    for head in lines:
        row = record_of([x.encode() for x in (head, *(next(lines, "") for _ in range(3)))])
        if row is None:
            raise ValueError(f"malformed FASTQ record: {head[:80]!r}")
        yield row


def fasta_records_of(lines: Iterator[str]) -> Iterator[tuple]:
    head, seq = None, []
    for line in itertools.chain(lines, (">",)):
        if line.startswith(">"):
            if head is not None:
                name, _, desc = head.partition(" ")
                yield name, desc or None, "".join(seq), None
            head, seq = line[1:], []
        elif head is None and line.strip():
            raise ValueError(f"malformed FASTA record: {line[:80]!r}")
        else:
            seq.append(line.strip())


def piped(lines: DataFrame, command: list[str], stderr: bool = False) -> DataFrame:
    """Each partition's `value` lines through a program's stdin; the lines of its stdout, or of its stderr. A missing program or a bad exit is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tempfile
        import threading

        if not shutil.which(command[0]):
            raise FileNotFoundError(command[0])
        with tempfile.TemporaryFile() as err, subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.DEVNULL if stderr else subprocess.PIPE, stderr=subprocess.PIPE if stderr else err) as child:

            def feed() -> None:
                with child.stdin as pipe:
                    for b in batches:
                        for line in b.column(0).to_pylist():
                            pipe.write(line.encode() + b"\n")

            feeder = threading.Thread(target=feed)
            feeder.start()
            rows: list[str] = []
            for line in child.stderr if stderr else child.stdout:
                rows.append(line.decode().rstrip("\n"))
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
            feeder.join()
            if child.wait():
                err.seek(0)
                raise RuntimeError(f"{command[0]} exited with {child.returncode}: {err.read(500)!r}")

    return lines.select("value").mapInArrow(run, "value string")
