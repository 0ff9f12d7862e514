"""The driver's star schema seen as sequencing tables, once in Spark and once in SQL, so that the operators can be checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What makes the order of a read's hits total.
ORDER = ["partkey", "suppkey", "mismatch", "alen", "pident", "evalue"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HITS = """hits AS (SELECT CAST(l_orderkey AS VARCHAR) AS qname, CAST(l_suppkey AS VARCHAR) AS tname, round(100 * (1 - l_discount), 4) AS pident,
  CAST(l_quantity AS BIGINT) AS alen, CAST(l_linenumber AS BIGINT) AS mismatch, l_partkey % 3 AS gapopen, CAST(1 AS BIGINT) AS qstart, CAST(l_quantity AS BIGINT) AS qend,
  l_partkey % 1000 + 1 AS tstart, l_partkey % 1000 + CAST(l_quantity AS BIGINT) AS tend, round(l_tax + 0.001, 4) AS evalue, l_extendedprice AS bitscore,
  l_partkey AS partkey, l_suppkey AS suppkey, l_returnflag AS flag, l_linestatus AS status FROM lineitem)"""
ACC = "acc AS (SELECT CAST(s_suppkey AS VARCHAR) AS accession, CAST(s_suppkey + 1 AS INT) AS taxid FROM supplier)"
TREE = """tree AS (SELECT CAST(s_suppkey + 1 AS INT) AS taxid, CAST(s_suppkey + 1 AS INT) AS species, 1000000 + s_nationkey AS genus, 2000000 + n_regionkey AS family
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
#: Ranks that don't nest, with missing species and genera, so that all levels and gaps occur.
FLAT_HITS = HITS.replace("CAST(l_suppkey AS VARCHAR) AS tname", "concat(l_returnflag, l_linestatus, l_linenumber % 2) AS tname")
FLAT = """flat AS (SELECT DISTINCT concat(l_returnflag, l_linestatus, l_linenumber % 2) AS accession, CAST(1000 * ascii(l_returnflag) + 10 * ascii(l_linestatus) + l_linenumber % 2 AS INT) AS taxid,
  CAST(ascii(l_returnflag) AS INT) AS species, CAST(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 0 ELSE 1000 + ascii(l_linestatus) END AS INT) AS genus, CAST(2000 + l_linenumber % 2 AS INT) AS family FROM lineitem)"""
SIZES = "sizes AS (SELECT CAST(o_orderkey AS VARCHAR) AS representative, count(*) OVER (PARTITION BY o_custkey) AS size FROM orders)"
REMOVED = (1000003, 1000007)


def hits(spark: SparkSession, sf_dir: str, flat: bool = False) -> DataFrame:
    c = F.col
    tname = F.concat("l_returnflag", "l_linestatus", (c("l_linenumber") % 2).cast("string")) if flat else c("l_suppkey").cast("string")
    long = c("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").cast("string").alias("qname"), tname.alias("tname"), F.round(100 * (1 - c("l_discount")), 4).alias("pident"),
        long.alias("alen"), c("l_linenumber").cast("long").alias("mismatch"), (c("l_partkey") % 3).alias("gapopen"), F.lit(1).cast("long").alias("qstart"), long.alias("qend"),
        (c("l_partkey") % 1000 + 1).alias("tstart"), (c("l_partkey") % 1000 + long).alias("tend"), F.round(c("l_tax") + 0.001, 4).alias("evalue"), c("l_extendedprice").alias("bitscore"),
        c("l_partkey").alias("partkey"), c("l_suppkey").alias("suppkey"), c("l_returnflag").alias("flag"), c("l_linestatus").alias("status"),
    )


def acc2taxid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("accession"), (F.col("s_suppkey") + 1).cast("int").alias("taxid"))


def lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    taxid = (F.col("s_suppkey") + 1).cast("int")
    return rows.select(taxid.alias("taxid"), taxid.alias("species"), (F.col("s_nationkey") + 1000000).alias("genus"), (F.col("n_regionkey") + 2000000).alias("family"))


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rf, ls, odd = F.ascii("l_returnflag"), F.ascii("l_linestatus"), c("l_linenumber") % 2
    genus = F.when((c("l_linestatus") == "F") & (c("l_returnflag") == "A"), 0).otherwise(ls + 1000)
    return table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus", odd.cast("string")).alias("accession"), (1000 * rf + 10 * ls + odd).alias("taxid"), rf.alias("species"), genus.alias("genus"), (odd + 2000).alias("family")).distinct()


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    by = orders.groupBy("o_custkey").agg(F.count("*").alias("size"))
    return orders.join(by, "o_custkey").select(F.col("o_orderkey").cast("string").alias("representative"), "size")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reads: the text's letters are the bases."""
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("read"), "doc_id").alias("id"), F.col("doc_id").alias("ordinal"), F.col("text").alias("seq"), "source")


READS = "reads AS (SELECT concat('read', doc_id) AS id, doc_id AS ordinal, text AS seq, source FROM documents)"


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("ref"), (c("l_partkey") % 1000).alias("start"), (c("l_partkey") % 1000 + c("l_quantity").cast("long")).alias("end"))


INTERVALS = "iv AS (SELECT l_suppkey AS ref, l_partkey % 1000 AS s, l_partkey % 1000 + CAST(l_quantity AS BIGINT) AS e FROM lineitem)"
