"""Scores, flags, intervals and formats of alignments, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parameters of the extreme-value statistics, and the database's size by default.
LAMBDA, K = 1.58, 0.1
DB_SIZE = 1_528_186_360_278
#: Bits of a SAM flag.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, FIRST, SECONDARY, SUPPLEMENTARY = 1, 2, 4, 8, 64, 256, 2048
MAX_BINS = 500


def gap_openings(cigar: Column) -> Column:
    """Insertions and deletions of a CIGAR string."""
    cigar = F.coalesce(cigar, F.lit(""))
    return (F.char_length(cigar) - F.char_length(F.translate(cigar, "ID", ""))).cast("long")


def tag_int(tags: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit(key)).try_cast("long"), F.lit(0))


def m8_of_paf(genome_size: float = DB_SIZE) -> dict[str, Column]:
    """The 14 tabular columns of a PAF row."""
    c = F.col
    nm = tag_int(c("tags"), "NM")
    score = (c("alen") - 2 * nm).cast("double")
    forward = c("strand") == "+"
    bare = F.when(F.startswith("tname", F.lit(">")), F.substring("tname", 2, 1 << 30)).otherwise(F.col("tname"))
    name = F.substring_index(F.substring_index(bare, " ", 1), "\t", 1)
    return {
        "qname": c("qname"),
        "tname": F.substring_index(name, ".", 1),
        "pident": F.when(c("alen") > 0, 100.0 * c("nmatch") / c("alen")).otherwise(0.0),
        "alen": c("alen"),
        "mismatch": nm,
        "gapopen": gap_openings(F.try_element_at("tags", F.lit("cg"))),
        "qstart": c("qstart") + 1,
        "qend": c("qend"),
        "tstart": F.when(forward, c("tstart") + 1).otherwise(c("tend")),
        "tend": F.when(forward, c("tend")).otherwise(c("tstart") + 1),
        "evalue": K * c("alen") * F.lit(float(genome_size)) * F.exp(-LAMBDA * score),
        "bitscore": (LAMBDA * score - math.log(K)) / math.log(2),
        "qlen": c("qlen"),
        "slen": c("tlen"),
    }


def m8_line(wide: bool = True) -> Column:
    """A row as tabular text: 14 columns, or the 12 that hits are passed on with."""
    c = [F.col(x) for x in ("qname", "tname", "pident", "alen", "mismatch", "gapopen", "qstart", "qend", "tstart", "tend", "evalue", "bitscore")]
    pattern = "%s\t%s\t%.2f\t%d\t%d\t%d\t%d\t%d\t%d\t%d\t%.2e\t%.1f" if wide else "%s\t%s\t%.3f\t%d\t%d\t%d\t%d\t%d\t%d\t%d\t%.3e\t%.3f"
    return F.format_string(pattern + "\t%d\t%d", *c, F.col("qlen"), F.col("slen")) if wide else F.format_string(pattern, *c)


def paf_line() -> Column:
    """A row as PAF text; the tags' types are not kept, so all are Z."""
    fixed = [F.col(x).cast("string") for x in ("qname", "qlen", "qstart", "qend", "strand", "tname", "tlen", "tstart", "tend", "nmatch", "alen", "mapq")]
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit(":Z:"), e["value"]))
    return F.concat_ws("\t", *fixed, tags)


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(bits) == bits


def lacks(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(bits) == 0


def primary(flag: Column) -> Column:
    """Mapped, and neither secondary nor supplementary."""
    return lacks(flag, UNMAPPED | SECONDARY | SUPPLEMENTARY)


def pair_unmapped(flag: Column) -> Column:
    return has(flag, PAIRED | UNMAPPED | MATE_UNMAPPED)


def proper_insert(flag: Column, rnext: Column, tlen: Column, least: int = 10, most: int = 10_000) -> Column:
    """A row that tells an insert's size: a primary, proper, first mate with a mapped mate and a length within bounds."""
    return primary(flag) & has(flag, PROPER | FIRST) & lacks(flag, MATE_UNMAPPED) & (rnext != "*") & (F.abs(tlen).between(least, most))


def rounded(x: Column) -> Column:
    """Three decimals below 0.1, two below 1, else one."""
    return F.when(x < 0.1, F.round(x, 3)).when(x < 1, F.round(x, 2)).otherwise(F.round(x, 1))


def rescaled(x: Column, a: Column, b: Column, c: Column, d: Column) -> Column:
    """x of [a, b], carried over to [c, d]; c where [a, b] is a point."""
    return F.when(a == b, c).otherwise(c + (x - a) * (d - c) / F.nullif(b - a, F.lit(0.0)))
