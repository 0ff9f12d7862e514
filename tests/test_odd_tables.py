"""Queries beside their SQL on small tables of a kind that the given ones don't have."""

import duckdb
import pytest

from seqsluice import catalog
from seqsluice.operators import reads
from seqsluice.sources import files


@pytest.fixture()
def agree(spark, tmp_path):
    """Writes tables and compares a query's rows with its SQL's."""

    def run(name, **tables):
        con = duckdb.connect()
        for table, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        got = catalog.queries()[name](spark, str(tmp_path))
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({catalog.oracle_sql()[name]})").fetchall()
        rows = sorted(map(tuple, got.select(*cols).collect()), key=str)
        assert rows == sorted(want, key=str)
        return rows

    return run


def suppliers(spark, *keys):
    nation = spark.createDataFrame([(k, k % 5) for k in range(25)], "n_nationkey int, n_regionkey int")
    return {"supplier": spark.createDataFrame([(k, k if k < 25 else 1) for k in keys], "s_suppkey long, s_nationkey int"), "nation": nation}


def test_suppliers_with_the_number_of_a_fixed_taxon(spark, agree):
    tables = suppliers(spark, 1, 3, 7, 9603, 9604, 9605, 9606, 1000002)
    assert len(agree("keep_filter", **tables)) > 3


def test_merged_counts_of_suppliers_with_the_number_of_a_fixed_taxon(spark, agree):
    rows = [(i, i % 7, k, 1, 10.0 + i, 100.0, 0.05, 0.02, "AN"[i % 2], "F") for i, k in enumerate([0, 1, 9603, 9604, 9604, 9604, 9605, 9606])]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    assert len(agree("merged_counts_weighting", lineitem=spark.createDataFrame(rows, schema))) == 6


def documents(spark, *rows):
    return {"documents": spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")}


@pytest.mark.parametrize("ids", [(0, 1, 2, 4, 6), (1, 3, 4, 5, 7), (-3, 0, 2, 3), (0, 1, 2, 3)])
def test_mates_of_files_of_different_lengths(spark, agree, ids):
    assert agree("fastq_pairs", **documents(spark, *[(i, f"some words {'ab'[i % 2] * (i + 5)} 1") for i in ids], (8, "12 34")))


@pytest.mark.parametrize("ids", [(0, 1, 2), (1, 2, 3, 4), (0, 1, 10, 13, 21), (5, 5, 5, 5, 6, None, None)])
def test_interleaved_documents_of_any_ids(spark, agree, ids):
    assert len(agree("interleave", **documents(spark, *[(i, f"text {k}") for k, i in enumerate(ids)], (30, "")))) == len(ids) + 1


def test_interleave_leaves_out_missing_mates_only_if_told(spark):
    pairs = spark.createDataFrame([(0, ("a",), ("b",)), (1, ("c",), None), (2, None, ("f",))], "ordinal long, r1 struct<id string>, r2 struct<id string>")
    with pytest.raises(Exception, match="streams of different lengths"):
        reads.interleave(pairs).collect()
    assert sorted(map(tuple, reads.interleave(pairs, strict=False).collect())) == [(0, "a"), (1, "b"), (2, "c"), (5, "f")]


def test_short_stretches_share_tasks(spark, tmp_path):
    records = [f"@r{i}\nACGT\n+\nIIII\n" for i in range(300)]
    (tmp_path / "a.fq").write_text("".join(records))
    rows = files.read_fastq(spark, [str(tmp_path / "a.fq")], split=40)
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted((r.ordinal, r.id) for r in rows.collect()) == [(i, f"r{i}") for i in range(300)]
