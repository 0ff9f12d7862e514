"""One explicit schema for each kind of record; nothing is inferred."""

from __future__ import annotations

SEQUENCE = "source string, ordinal long, id string, desc string, seq string, qual string"
#: 14 tabular columns of a nucleotide alignment; the protein form has the first 12, and lengths of 0.
M8 = "qname string, tname string, pident double, alen long, mismatch long, gapopen long, qstart long, qend long, tstart long, tend long, evalue double, bitscore double, qlen long, slen long"
PAF = "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, nmatch long, alen long, mapq long, tags map<string,string>"
SAM = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags string"
#: The one layout of a read's taxonomic call; positional text forms exist only for import and export.
HIT_SUMMARY = (
    "read_id string, level int, taxid int, accession string, species int, genus int, family int, contig_id string, contig_accession string, "
    "contig_species int, contig_genus int, contig_family int, from_assembly boolean, source string"
)
LINEAGE = "taxid int, species int, genus int, family int"
RANKS = ("species", "genus", "family")
TAXON_COUNT = (
    "tax_id int, tax_level int, genus_taxid int, family_taxid int, count long, nonunique_count long, unique_count long, dcr double, "
    "percent_identity double, alignment_length double, e_value double, count_type string, base_count long, source_count_type array<string>"
)


def columns(schema: str) -> list[tuple[str, str]]:
    """(name, type) of a flat schema."""
    return [tuple(part.strip().split(" ", 1)) for part in schema.replace("<string,string>", "<string;string>").split(",")]
