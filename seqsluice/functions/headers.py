"""Read ids, headers and names, as columns."""

from __future__ import annotations

import re
from pathlib import PurePath

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes that tell mates apart, in the order in which they are tried.
MATE_SUFFIXES = ("/1", "/2", ".1", ".2", " 1:", " 2:", " 1:N:0:", " 2:N:0:", "/1:N:0:", "/2:N:0:", "_1", "_2", " 1#0/1", " 2#0/2", "|1", "|2", " 1#", " 2#", "/R1", "/R2", "_R1", "_R2", " 1:0", " 2:0")
#: Name parts of a first file and of its mate.
MATE_TAGS = {"R1": "R2", "r1": "r2", "1": "2", "F": "R", "f": "r", "FWD": "REV", "fwd": "rev", "PE1": "PE2", "pe1": "pe2", "READ1": "READ2", "read1": "read2"}
#: Fixed value: the header fields of a sequence that has no call.
NO_CALL = ">family_nr:-300:family_nt:-300:genus_nr:-200:genus_nt:-200:species_nr:-100:species_nt:-100:"
FIELDS = ("family_nr", "family_nt", "genus_nr", "genus_nt", "species_nr", "species_nt")


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9 _:])", r"\\\1", text)


def without_mate_suffix(name: Column) -> Column:
    """One suffix less: the first of MATE_SUFFIXES that the name ends with."""
    out = name
    for suffix in reversed(MATE_SUFFIXES):
        out = F.when(F.endswith(name, F.lit(suffix)), F.substring(name, F.lit(1), F.char_length(name) - len(suffix))).otherwise(out)
    return out


def same_template(a: Column, b: Column) -> Column:
    """Whether two read ids name one template: equal, equal without one mate suffix, or equal up to the first space without trailing separators."""
    x, y = without_mate_suffix(a), without_mate_suffix(b)
    stem = [F.regexp_replace(F.substring_index(v, " ", 1), r"[ \t:#./_]+$", "") for v in (x, y)]
    return (a == b) | (x == y) | (stem[0] == stem[1])


def header_id(header: Column, prefix: str) -> Column:
    return F.regexp_extract(header, f"^{_literal(prefix)}*([^ \t\n]*)", 1)


def header_desc(header: Column) -> Column:
    """What follows the first blank, tab or newline; null if nothing does."""
    return F.nullif(F.regexp_extract(header, r"(?s)^[^ \t\n]*[ \t\n](.*)$", 1), F.lit(""))


def base_accession(accession: Column) -> Column:
    """Without the version: the text before the first dot."""
    return F.substring_index(accession, ".", 1)


def first_field(line: Column) -> Column:
    return F.substring_index(line, "\t", 1)


def header_taxid(header: Column, field: str) -> Column:
    """The integer after :field: in a header, -1 if it is missing or no integer."""
    text = F.regexp_replace(header, "^>", "")
    mark = f":{field}:"
    after = F.when(F.contains(text, F.lit(mark)), F.substring_index(F.substring(text, F.instr(text, mark) + len(mark), F.char_length(text)), ":", 1))
    return F.coalesce(F.trim(after).try_cast("int"), F.lit(-1))


def header_field_number(header: Column, field: str) -> Column:
    """1-based place of a field among the header's parts, -1 if it is missing."""
    place = F.array_position(F.split(F.regexp_replace(header, "^>", ""), ":"), field)
    return F.when(place > 0, place).otherwise(-1).cast("int")


def taxid_header(nr: list[Column], nt: list[Column], old_id: Column) -> Column:
    """A header that carries both lineages (species, genus, family each)."""
    parts = []
    for rank, name in ((2, "family"), (1, "genus"), (0, "species")):
        parts += [F.lit(f"{name}_nr"), nr[rank].cast("string"), F.lit(f"{name}_nt"), nt[rank].cast("string")]
    return F.concat(F.lit(">"), F.concat_ws(":", *parts, old_id))


def no_call_header(old_id: Column) -> Column:
    return F.concat(F.lit(NO_CALL), old_id)


def annotated_id(nr: Column, nt: Column, old_id: Column) -> Column:
    return F.concat(F.lit("NR:"), F.coalesce(nr, F.lit("")), F.lit(":NT:"), F.coalesce(nt, F.lit("")), F.lit(":"), old_id)


def last_part(old_id: Column) -> Column:
    return F.substring_index(old_id, ":", -1)


def split_accessions(header: Column) -> Column:
    """Where the character after the header's first comma is no blank, all commas become the separator of multi-accession headers."""
    joined = F.startswith(header, F.lit(">")) & F.rlike(header, F.lit(r"^[^,]*,([^ ]|$)"))
    has_next = F.rlike(header, F.lit(r"^[^,]*,[^ ]"))
    return F.when(joined & has_next, F.translate(header, ",", "\x01")).otherwise(header)


def gene_id(transcript: Column) -> Column:
    return F.concat(F.lit("gene_"), transcript)


def mate_file(name: str) -> str | None:
    """The name of the second file that goes with a first one: its last part that is a mate tag is swapped."""
    parts = re.split(r"([_.\-])", name)
    for i in range(len(parts) - 1, -1, -1):
        if parts[i] in MATE_TAGS:
            return "".join([*parts[:i], MATE_TAGS[parts[i]], *parts[i + 1 :]])
    return None


def sample_name(path: str) -> str:
    """The sample that a reads file belongs to: the name without extensions, lane, mate and chunk parts."""
    base = PurePath(path).name.split(".fastq")[0].split(".fq")[0]
    while (stem := PurePath(base).stem) != base and PurePath(base).suffix.lower() in (".gz", ".fastq", ".fq", ".fasta", ".fa"):
        base = stem
    end = r"(?:[._-]S\d+)?(?:[._-]L\d{3})?[._-]R[12][._-]\d{3}$|[._-]R?[12]$"
    return re.sub(rf"(?i)(?<=.)(?:{end})", "", base).rstrip("_-.")


#: Fixed value: what follows the sample in the name of a reads file that is one of a pair.
PAIR_NAME = r".*_r?[12]\.fastq(\.gz)?$"


def find_pairs(names: list[str], sample: str) -> list[str]:
    """The reads files of a sample among some names, sorted."""
    pattern = re.compile("^" + re.escape(sample) + PAIR_NAME, re.IGNORECASE)
    return sorted(n for n in names if pattern.match(n))


def file_kind(name: str) -> tuple[str | None, bool]:
    """(fasta, fastq or None; whether it is gzipped), by extension."""
    base = name.lower()
    zipped = base.endswith(".gz")
    ext = base.removesuffix(".gz").rpartition(".")[2]
    kind = "fasta" if ext in ("fasta", "fa", "fna", "faa", "ffn", "frn") else "fastq" if ext in ("fastq", "fq") else None
    return kind, zipped


def renamed(name: str, prefix: str | None = None, postfix: str | None = None, delimiter: str = "_") -> str:
    """A file name with something put before and after what precedes its extensions."""
    base, dot, rest = PurePath(name).name.partition(".")
    return delimiter.join(x for x in (prefix, base, postfix) if x) + dot + rest
