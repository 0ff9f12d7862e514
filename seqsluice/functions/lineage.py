"""Lineages of species, genus and family, as columns; negative ids have meanings of their own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: No lineage, and "no specific call" by rank.
NULL_TAXID = -1
NOT_SPECIFIC = (-100, -200, -300)
#: The taxa that are always removed.
ALWAYS_REMOVED = (9605, 9606)


def call_of_level(level: int) -> int:
    return -100 * level


def validated(lineage: list[Column], taxid: Column, level: Column) -> list[Column]:
    """The lineage of a call: ranks below its level are not specific; a gap from there up is -100 * rank less its parent's id."""
    out: list[Column] = []
    parent = taxid
    for i, value in enumerate(lineage):
        filled = F.when(value <= 0, F.lit(-100 * (i + 1)) - parent).otherwise(value)
        at_or_above = level <= i + 1
        out.append(F.when((level == 0) | ~at_or_above, NOT_SPECIFIC[i]).otherwise(filled).cast("int"))
        parent = F.when(at_or_above, filled).otherwise(parent)
    return out


def of_call(lineage: list[Column], taxid: Column, level: Column) -> list[Column]:
    """The lineage to print for a (taxid, level): none without a taxid, the database's at species level, else not specific."""
    none = F.coalesce(taxid, F.lit(-1)) <= 0
    return [F.when(none, NULL_TAXID).when(level == 1, F.coalesce(v, F.lit(NULL_TAXID))).otherwise(NOT_SPECIFIC[i]).cast("int") for i, v in enumerate(lineage)]


def kept(taxids: list[Column], removed: list[int] = (), allowed: list[int] | None = None) -> Column:
    """Whether a row passes: none of its positive ids is removed (ALWAYS_REMOVED are), and if there is a list of allowed ones, it has one."""
    real = F.filter(F.array(*taxids), lambda t: t > 0)
    ok = ~F.arrays_overlap(real, F.array(*[F.lit(t) for t in sorted({*ALWAYS_REMOVED, *removed})]))
    if allowed is not None:
        ok &= F.arrays_overlap(real, F.array(*[F.lit(t) for t in sorted(allowed)]).cast("array<int>"))
    return F.coalesce(ok, F.lit(True) if allowed is None else F.lit(False))
