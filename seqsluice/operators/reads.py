"""Reads: validation, pairing, dedup, sampling. `ordinal` numbers records, so "first" is always defined."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import same_template
from ..session import numbered


def length_class(length: Column, least: int | None, most: int | None) -> Column:
    """undersized before oversized before validated."""
    out = F.when(length < least, "undersized") if least is not None else F.when(F.lit(False), "")
    if most is not None:
        out = out.when(length > most, "oversized")
    return out.otherwise("validated")


def length_filter(records: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    return records.where(length_class(F.char_length("seq"), least, most) == "validated")


def read_stats(records: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    """(validated, undersized, oversized) in one pass."""
    kind = length_class(F.char_length("seq"), least, most)
    return records.agg(*[F.count_if(kind == k).alias(k) for k in ("validated", "undersized", "oversized")])


def pair_class(least: int | None, most: int | None, strict: bool = True) -> Column:
    """Of a row with r1 and r2: unpaired (a mate is missing, or under strict pairing another template's), undersized or oversized if either mate is, else validated."""
    lone = F.col("r1").isNull() | F.col("r2").isNull()
    if strict:
        lone |= ~same_template(F.col("r1.id"), F.col("r2.id"))
    a, b = F.char_length("r1.seq"), F.char_length("r2.seq")
    return F.when(lone, "unpaired").otherwise(F.when(length_class(F.least(a, b), least, None) != "validated", "undersized").otherwise(length_class(F.greatest(a, b), None, most)))


def pair_filter(pairs: DataFrame, least: int | None = None, most: int | None = None, strict: bool = True) -> DataFrame:
    return pairs.where(pair_class(least, most, strict) == "validated")


def pair_stats(pairs: DataFrame, least: int | None = None, most: int | None = None, strict: bool = True) -> DataFrame:
    """Pairs validated, undersized and oversized, and mates unpaired."""
    kind = pair_class(least, most, strict)
    mates = F.when(F.col("r1").isNotNull() & F.col("r2").isNotNull(), 2).otherwise(1)
    return pairs.agg(*[F.count_if(kind == k).alias(k) for k in ("validated", "undersized", "oversized")], F.coalesce(F.sum(F.when(kind == "unpaired", mates)), F.lit(0)).cast("long").alias("unpaired"))


def first_records(records: DataFrame, n: int) -> DataFrame:
    """Up to n records, the first by ordinal."""
    return records.orderBy("ordinal").limit(n)


def concat_pairs(pairs: DataFrame) -> DataFrame:
    """One record a pair: bases joined by N, qualities by !, under the first mate's header. Mates of different templates are an error."""
    ok = same_template(F.col("r1.id"), F.col("r2.id"))
    checked = F.when(F.coalesce(ok, F.lit(False)), F.col("r1.id")).otherwise(F.raise_error(F.lit("mates of different templates")))
    return pairs.select("ordinal", checked.alias("id"), F.col("r1.desc").alias("desc"), F.concat("r1.seq", F.lit("N"), "r2.seq").alias("seq"), F.concat("r1.qual", F.lit("!"), "r2.qual").alias("qual"))


def interleave(pairs: DataFrame, strict: bool = True) -> DataFrame:
    """R1, R2, R1, R2, ...: a record a row, numbered anew. A missing mate is an error, or leaves its number out if not strict."""
    both = F.array("r1", "r2")
    if strict:
        lone = F.raise_error(F.lit("streams of different lengths")).cast(pairs.select(both.alias("x")).schema["x"].dataType)
        both = F.when(F.col("r1").isNotNull() & F.col("r2").isNotNull(), both).otherwise(lone)
    return pairs.select("ordinal", F.posexplode(both).alias("mate", "r")).where("r IS NOT NULL").select((F.col("ordinal") * 2 + F.col("mate")).alias("ordinal"), "r.*")


def deinterleave(records: DataFrame, strict: bool = True) -> DataFrame:
    """Pairs of an interleaved stream of records numbered from 0. A record without its mate is an error, or a pair with a null if not strict."""
    fields = [F.col(c) for c in records.columns if c != "ordinal"]
    one = records.withColumn("r", F.struct(*fields)).withColumn("pair", F.floor(F.col("ordinal") / 2))
    mate = lambda k: F.max_by("r", F.when(F.col("ordinal") % 2 == k, F.lit(1)))
    pairs = one.groupBy("pair").agg(mate(0).alias("r1"), mate(1).alias("r2")).withColumnRenamed("pair", "ordinal")
    if not strict:
        return pairs
    lone = F.raise_error(F.lit("an odd number of records")).cast(pairs.schema["r2"].dataType)
    return pairs.withColumn("r2", F.when(F.col("r1").isNotNull() & F.col("r2").isNotNull(), F.col("r2")).otherwise(lone))


def dedup_clusters(reads: DataFrame, length: int = 70) -> DataFrame:
    """(representative, size, members): reads (id, seq1, seq2 or null) that share the first `length` bases of each mate; the representative is the first by ordinal, members are in that order.

    Groups are of the prefixes themselves, not of a hash. Members are as many as a cluster has reads; cluster_sizes leaves them out."""
    return _prefixed(reads, length).groupBy("p1", "p2").agg(F.min_by("id", "ordinal").alias("representative"), F.count("*").alias("size"), F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "id"))), lambda x: x["id"]).alias("members")).drop("p1", "p2")


def _prefixed(reads: DataFrame, length: int) -> DataFrame:
    seq2 = F.substring("seq2", 1, length) if "seq2" in reads.columns else F.lit(None).cast("string")
    return reads.select("id", "ordinal", F.substring("seq1", 1, length).alias("p1"), seq2.alias("p2"))


def cluster_sizes(reads: DataFrame, length: int = 70) -> DataFrame:
    """(representative, size), all partial sums before the shuffle."""
    return _prefixed(reads, length).groupBy("p1", "p2").agg(F.min_by("id", "ordinal").alias("representative"), F.count("*").alias("size")).drop("p1", "p2")


def unique_reads(reads: DataFrame, length: int = 70) -> DataFrame:
    """The representatives' rows."""
    sizes = cluster_sizes(reads, length).select(F.col("representative").alias("id"))
    return reads.join(sizes, "id", "left_semi")


def cluster_members(reads: DataFrame, length: int = 70) -> DataFrame:
    """(representative read id, read id), a row a read, representatives included. A join by prefix, so a cluster may have any number of reads; adaptive execution splits a hot one."""
    rows = _prefixed(reads, length)
    first = rows.groupBy("p1", "p2").agg(F.min_by("id", "ordinal").alias("representative")).select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), "representative")
    both = rows.join(first, F.col("p1").eqNullSafe(F.col("q1")) & F.col("p2").eqNullSafe(F.col("q2")))
    return both.select(F.col("representative").alias("representative read id"), F.col("id").alias("read id"))


def with_cluster_size(rows: DataFrame, sizes: DataFrame, key: str = "read_id") -> DataFrame:
    """rows with cluster_size, 1 for reads without a cluster."""
    other = sizes.select(F.col("representative").alias(key), F.col("size").alias("cluster_size"))
    return rows.join(other, key, "left").withColumn("cluster_size", F.coalesce("cluster_size", F.lit(1).cast("long")))


def _draw(key: Column, seed: int) -> Column:
    """The order of a draw without a state: md5 of the key and the seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def subsample(units: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """min(n, all) units (reads or pairs), each set of them as likely: those of the least hashes.

    Counts of 65,536 stretches of the hash tell in which of them the line falls; units before it are taken as they come, and only those of that stretch are put in order."""
    drawn = units.withColumn("_draw", _draw(F.col(key), seed)).withColumn("_cell", F.substring("_draw", 1, 4))
    cells = drawn.groupBy("_cell").count()
    upto = F.sum("count").over(Window.orderBy("_cell"))
    line = cells.withColumn("upto", upto).where(F.col("upto") >= n).agg(F.min(F.struct("_cell", (F.lit(n) - F.col("upto") + F.col("count")).alias("rest"))).alias("m")).first().m
    if line is None:
        return drawn.drop("_draw", "_cell")
    edge = drawn.where(F.col("_cell") == line["_cell"]).orderBy("_draw", key).limit(line["rest"])
    return drawn.where(F.col("_cell") < line["_cell"]).unionByName(edge).drop("_draw", "_cell")


def subsample_weighted(units: DataFrame, n: int, weight: str, seed: int = 42, key: str = "id") -> DataFrame:
    """n units drawn without replacement in proportion to weight: those of the largest ln(u) / weight, with it as sample_key."""
    digits = F.conv(F.substring(_draw(F.col(key), seed), 1, 12), 16, 10).cast("double")
    u = (digits + 0.5) / float(1 << 48)
    return units.where(F.col(weight) > 0).withColumn("sample_key", F.round(F.log(u) / F.col(weight), 9)).orderBy(F.desc("sample_key"), key).limit(n)


def with_ids(records: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Records whose id is in ids."""
    return records.join(ids.select(key).distinct(), key, "left_semi")


def of_taxid_tag(records: DataFrame, taxid: int) -> DataFrame:
    """Records whose id contains kraken:taxid|<taxid>; longer ids that begin so are not told apart."""
    return records.where(F.contains("id", F.lit(f"kraken:taxid|{taxid}")))


def valid_bases(seq: Column, with_n: bool = False) -> Column:
    return F.rlike(seq, F.lit("^[ACGTNacgtn]*$" if with_n else "^[ACGTacgt]*$"))


def check_bases(records: DataFrame, with_n: bool = False) -> DataFrame:
    """records; an error at the first with a character outside the alphabet."""
    bad = F.raise_error(F.concat(F.lit("invalid base in "), "id"))
    return records.withColumn("seq", F.when(valid_bases(F.col("seq"), with_n), F.col("seq")).otherwise(bad))


def long_contigs(contigs: DataFrame, least: int = 100) -> DataFrame:
    return contigs.where(F.char_length("seq") >= least)


def low_quality(records: DataFrame, least_length: int = 35, quality: int = 17, most_low: float = 0.15, most_n: int = 15, least_complexity: float = 0.6) -> Column:
    """Whether a read fails the usual filter: too short, too many bases of low quality or N, or too few places where the base changes."""
    n = F.char_length("seq")
    low = F.char_length(F.translate("qual", "".join(map(chr, range(33 + quality, 127))), ""))
    unknown = n - F.char_length(F.translate("seq", "Nn", ""))
    changes = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring("seq", i, F.lit(1)) != F.substring("seq", i + 1, F.lit(1))))
    return (n < least_length) | (low > most_low * n) | (unknown > most_n) | (changes < least_complexity / 2 * (n - 1))


def fastq_text(records: DataFrame) -> DataFrame:
    head = F.concat(F.lit("@"), F.concat_ws(" ", "id", "desc"))
    return records.select(F.concat_ws("\n", head, "seq", F.lit("+"), "qual").alias("value"))


def fasta_text(records: DataFrame) -> DataFrame:
    return records.select(F.concat(F.lit(">"), F.concat_ws(" ", "id", "desc"), F.lit("\n"), "seq").alias("value"))


def alignment_score(a: str, b: str, match: int = 2, mismatch: int = -2, open_gap: int = -5, extend: int = -1) -> int:
    """The best global alignment's score of two short sequences, gaps affine; a helper for the driver, with no use in a plan."""
    low = -math.inf
    best = [0.0] + [open_gap + extend * j for j in range(1, len(b) + 1)]
    down = [low] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        diagonal, best[0], across = best[0], open_gap + extend * i, low
        for j, y in enumerate(b, 1):
            down[j] = max(best[j] + open_gap + extend, down[j] + extend)
            across = max(best[j - 1] + open_gap + extend, across + extend)
            diagonal, best[j] = best[j], max(diagonal + (match if x == y else mismatch), down[j], across)
    return int(best[-1])


def row_numbers(records: DataFrame, order: list[str]) -> DataFrame:
    """records numbered from 0 in an order, for sources without numbers of their own."""
    return numbered(records, order)


def in_order(*streams: DataFrame) -> DataFrame:
    """The records of several streams one stream after the other: numbered by stream and by their ordinal in it."""
    out = streams[0].withColumn("stream", F.lit(0))
    for k, s in enumerate(streams[1:], 1):
        out = out.unionByName(s.withColumn("stream", F.lit(k)))
    return out.orderBy("stream", "ordinal")


def merged_fairly(*streams: DataFrame) -> DataFrame:
    """The records of several streams by turns: the first of each, the second of each, and so on; streams that have ended are passed over."""
    return in_order(*streams).orderBy("ordinal", "stream")


def shard_of(name: Column, shards: int) -> Column:
    """Which of so many shards a read id belongs to, mates with it."""
    return F.pmod(F.xxhash64(F.substring_index(name, " ", 1)), F.lit(shards))


def sorted_alignments(rows: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """SAM rows by coordinate, the references (name, n) in the order n of the header and unmapped rows last; by read name without references."""
    if references is None:
        return rows.orderBy("qname", "flag")
    order = references.select(F.col("name").alias("rname"), F.col("n").alias("_n"))
    return rows.join(order, "rname", "left").orderBy(F.col("_n").asc_nulls_last(), "pos", "qname", "flag").drop("_n")
