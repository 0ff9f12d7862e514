"""Dictionary builds from the command line: python -m seqsluice <module> ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import taxonomy
from .session import session
from .sources import files, sinks, tabular


def _there(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(p)


def build_taxid_lineages(spark: SparkSession, nodes: str, merged: str, out: str) -> None:
    """nodes.dmp and merged.dmp to (taxid, species, genus, family), sorted by taxid."""
    _there(spark, nodes, merged)
    tree = taxonomy.merged_nodes(tabular.parse_nodes(spark.read.text(nodes)), tabular.parse_merged(spark.read.text(merged)))
    sinks.write_dictionary(taxonomy.lineages(tree), out, "taxid")


def build_accession2taxid(spark: SparkSession, mappings: list[str], out: str, fasta: list[str] = ()) -> None:
    """Mapping files to (accession, taxid), sorted by accession; of the accessions of some FASTA files, if there are any."""
    _there(spark, *mappings, *fasta)
    text = spark.read.text(mappings).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("ordinal"), "value")
    present = files.read_fasta(spark, list(fasta)).select(F.substring_index("id", ".", 1).alias("accession")) if fasta else None
    sinks.write_dictionary(taxonomy.accession_dictionary(tabular.parse_acc2taxid(text, strict=present is None), present), out, "accession")


def build_fasta_offsets(spark: SparkSession, fasta: list[str], out: str) -> None:
    """FASTA files to (accession, offset), sorted by accession; a record's bytes are its header line and its bases on one line."""
    _there(spark, *fasta)
    rows = files.read_fasta(spark, list(fasta))
    head = F.octet_length(F.concat_ws(" ", "id", "desc"))
    sinks.write_dictionary(files.accession_offsets(rows, head + F.octet_length("seq") + 3), out, "accession")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="seqsluice")
    modules = parser.add_subparsers(dest="module", required=True)
    a = modules.add_parser("taxid_lineages")
    for name in ("nodes", "merged", "out"):
        a.add_argument(f"--{name}", required=True)
    a = modules.add_parser("accession2taxid")
    a.add_argument("--mapping", nargs="+", required=True)
    a.add_argument("--fasta", nargs="*", default=[])
    a.add_argument("--out", required=True)
    a = modules.add_parser("fasta_offsets")
    a.add_argument("--fasta", nargs="+", required=True)
    a.add_argument("--out", required=True)
    p = parser.parse_args(argv)
    spark = spark or session()
    if p.module == "taxid_lineages":
        build_taxid_lineages(spark, p.nodes, p.merged, p.out)
    elif p.module == "accession2taxid":
        build_accession2taxid(spark, p.mapping, p.out, p.fasta)
    else:
        build_fasta_offsets(spark, p.fasta, p.out)


if __name__ == "__main__":
    main(sys.argv[1:])
