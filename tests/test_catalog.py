import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seqsluice import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(rows):  # floats to five places
    return [tuple(None if v != v else round(v, 5) if isinstance(v, float) else v for v in r) for r in rows]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_and_sql_agree(spark, duck, name):
    got = catalog.queries()[name](spark, SMALL)
    cols = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(plain(map(tuple, got.select(*cols).collect())), key=key) == sorted(plain(want), key=key)


def test_whole_tables(spark, duck):
    rows = catalog.queries()["coverage_bins"](spark, SMALL)
    refs = duck.execute("SELECT count(DISTINCT l_suppkey) FROM lineitem").fetchone()[0]
    assert refs > 1 and rows.select("ref").distinct().count() == refs and rows.count() == 500 * refs
    for name, source in (("parse_header", "documents"), ("gene_abundance", "part")):
        assert catalog.queries()[name](spark, SMALL).count() == duck.execute(f"SELECT count(*) FROM {source}").fetchone()[0]
    size = F.coalesce(F.length("id"), F.lit(0)) + F.coalesce(F.length("desc"), F.lit(0))
    assert catalog.queries()["parse_header"](spark, SMALL).agg(F.max(size)).first()[0] > 40


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.oracle_sql()) == set(catalog.queries())
