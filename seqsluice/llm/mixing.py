"""Mixing sources to target weights by entropy balancing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, packed, small

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of code points, repeating.
WEIGHTS = (3, 1, 2)
#: Rows of one source and size that are put in order together, about.
TOGETHER = 1024
#: Newton rounds at most and those of one plan, the longest step, and decimals of the dual variable that the rates use.
ROUNDS, EACH, STRIDE, DECIMALS = 60, 3, 4.0, 7
#: Rounded copies are counted in millionths; rounds in which words that are still missing are filled up.
MICRO, FILLS = 1_000_000, 3
RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")


def size_of(text: str = "text") -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _order() -> Column:
    """A number below 2^60 from the id and the text, null as empty."""
    own = F.concat(F.coalesce(F.col("_id"), F.lit("")), F.lit("|"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Adds target to (source, source_size, ...): share times all sizes, split by weight, none above `most` times its source's size.

    Sharing the excess again and again until none is above ends where all sources at their limit have the smallest ratios
    of limit to weight, and the others share the rest by weight. In the order of that ratio the level of the rest rises up
    to the first source that isn't at its limit and falls from there, so the highest level is the one. The input has one row
    a source, and weights that repeat in the order of all sources need that order, so this table, and no other, is one task's."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("double")
    ranked = sources.withColumn("w", w).withColumn("most", most * F.col("source_size"))
    ratio = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    total, all_w = F.sum("source_size").over(every) * share, F.sum("w").over(every)
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    left_w = all_w - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / left_w)
    return ranked.withColumn("level", F.max("level").over(every)).withColumn("target", F.least(F.col("most"), F.col("level") * F.col("w"))).drop("w", "most", "level")


def tilts(sizes: DataFrame, sources: DataFrame, most: float = 2.0) -> DataFrame:
    """Adds x, the dual variable, to sources (source, source_size, mean, target), by Newton rounds over sizes (source, size, n).

    The rates r of documents nearest to "each once" in entropy, sum of r ln r - r + 1, whose words sum up to the target and none
    of which is above `most`, are min(most, exp(x * size / mean)). x is where the dual's gradient, the words at x less the
    target, is zero. A round sums gradient and Hessian by source in one aggregation and takes Newton's step; a step of over
    STRIDE is cut, and one that leaves the interval in which the root is known to lie halves it. Rounds end when no source
    moves by 10^-12. A source that takes `most` times everything has no finite x; it is null, and so it is without words."""
    sources = materialise(sources, "mix-sources")
    open_ = (F.col("source_size") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12))
    null = F.lit(None).cast("double")
    state = sources.where(open_).withColumns({"x": F.lit(0.0), "low": null, "high": null, "moved": F.lit(1.0)})
    narrow, made = sources.count() <= 200_000, None
    for _ in range(ROUNDS // EACH):
        new = state
        for _ in range(EACH):
            new = _round(sizes, F.broadcast(new) if narrow else new, most)
        new = materialise(new, "mix-dual")
        if made is not None:
            discard(made)
        state = made = new
        if state.where("moved > 1e-12").isEmpty():
            break
    return state.select(*sources.columns, F.round("x", DECIMALS).alias("x")).unionByName(sources.where(~open_).withColumn("x", null))


def _round(sizes: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """state after one of Newton's steps. Its columns are keys of the sums, so it is read once and rounds can follow each other in one plan."""
    at = sizes.withColumnRenamed("source", "s").join(state, F.col("s").eqNullSafe(F.col("source")))
    tilt = F.exp(F.col("x") * F.col("size") / F.col("mean"))
    words = F.col("n") * F.col("size")
    now = at.groupBy(*state.columns).agg(F.sum(words * F.least(F.lit(most), tilt)).alias("sum"), F.sum(F.when(tilt < most, words * F.col("size") / F.col("mean") * tilt)).alias("h"))
    now = now.withColumn("g", F.col("sum") - F.col("target"))
    now = now.withColumns({"low": F.when(F.col("g") <= 0, F.col("x")).otherwise(F.col("low")), "high": F.when(F.col("g") > 0, F.col("x")).otherwise(F.col("high"))})
    step = F.when(F.col("h") > 0, F.greatest(F.lit(-STRIDE), F.least(F.lit(STRIDE), -F.col("g") / F.col("h")))).when(F.col("g") > 0, -STRIDE).otherwise(STRIDE)
    to = F.col("x") + step
    outside = F.coalesce((to < F.col("low")) | (to > F.col("high")), F.lit(False)) & F.col("low").isNotNull() & F.col("high").isNotNull()
    now = now.withColumn("to", F.when(outside, (F.col("low") + F.col("high")) / 2).otherwise(to))
    return now.withColumns({"moved": F.abs(F.col("to") - F.col("x")), "x": F.col("to")}).select(*state.columns)


def allotted(sizes: DataFrame, sources: DataFrame, most: float = 2.0) -> DataFrame:
    """(source, size, n, source_size, target, rate, m): how many copies m the n documents of one source and size get together.

    Down the sizes of a source, copies are what whole numbers the running sum of n * rate passes, so each size gets its share
    to within one, and as sizes next to each other differ little, a source's words are short of the target by less than its
    longest document. Then what is missing is offered to all sizes that fit into it, the longest first, FILLS times over.
    All of it is in whole numbers. Windows run over a source's sizes, of which there are fewer than the square root of twice its words."""
    rate = F.when(F.col("x").isNotNull(), F.least(F.lit(most), F.exp(F.col("x") * F.col("size") / F.col("mean")))).when(F.col("source_size") > 0, F.lit(most)).otherwise(1.0)
    by = sizes.withColumnRenamed("source", "s").join(small(sources), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    whole, to_here = Window.partitionBy("source"), down.rowsBetween(Window.unboundedPreceding, 0)
    by = by.withColumn("rate", rate).withColumn("want", F.round(F.col("n") * F.col("rate") * MICRO).cast("long")).withColumn("sum", F.sum("want").over(to_here))
    by = by.withColumn("m", F.floor(F.col("sum") / MICRO) - F.floor((F.col("sum") - F.col("want")) / MICRO))
    goal = F.floor(F.col("target") + 1e-6)
    for _ in range(FILLS):
        by = by.withColumn("missing", goal - F.sum(F.col("m") * F.col("size")).over(whole))
        room = F.when((F.col("size") > 0) & (F.col("size") <= F.col("missing")), F.col("n") * int(most) - F.col("m")).otherwise(0)
        by = by.withColumn("room", room).withColumn("offered", F.sum(F.col("room") * F.col("size")).over(to_here) - F.col("room") * F.col("size"))
        more = F.floor((F.col("missing") - F.col("offered")) / F.greatest(F.col("size"), F.lit(1)))
        by = by.withColumn("m", F.col("m") + F.greatest(F.lit(0), F.least(F.col("room"), more)))
    return by.select("source", "size", "n", "source_size", "target", "rate", "m")


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """docs with size, source_size, target, rate, copies and taken (copies times size).

    Among all ways to weigh documents so that each source's words meet its target and none is taken over `most` times, the one nearest to
    "each once" in entropy gives a document the rate min(most, exp(x * size / mean size)), x the dual variable of its source, which
    Newton's method finds (tilts). Rates are rounded to whole copies of all documents of one source and size (allotted);
    which of them get one more is by a hash of id and text, the least first. A size's documents are dealt into slices of
    that hash, about TOGETHER each, and only the slice in which the line falls is put in order, so no task holds a source or size.

    Reruns agree. Rows equal in id and text are alike: if not all of them get one more, none does. Null text: size 0,
    taken 0. A null source is a source, the last. A source without words has target 0. A null id is
    the empty text in the hash. An empty table gives no rows. Columns of docs with these names are replaced.
    """
    rows = packed(docs, RESULTS).select("row", F.col("row.source").alias("source"), size_of().alias("size"), F.col("row.doc_id").cast("string").alias("_id"), "text")
    rows = rows.select("row", "source", "size", _order().alias("o"))
    sized = materialise(rows.select("source", "size", "o"), "mix-sizes")
    sizes = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    words = F.sum(F.col("size") * F.col("n"))
    sources = targets(sizes.groupBy("source").agg(words.alias("source_size"), (words / F.greatest(F.lit(1), F.sum(F.when(F.col("size") > 0, F.col("n"))))).alias("mean")), share, most, weights)
    groups = materialise(allotted(sizes, materialise(tilts(sizes, sources, most), "mix-tilts"), most).withColumn("more", F.col("m") % F.col("n")), "mix-groups")
    split = groups.where("more > 0").select(F.col("source").alias("s"), F.col("size").alias("z"), "n", "more")
    slices = F.ceil(F.col("n") / TOGETHER)
    cells = sized.join(small(split, groups), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    cells = cells.groupBy("s", "z", "more", F.shiftright(F.shiftright("o", 30) * slices, 30).alias("slice"), "o").agg(F.count("*").alias("c"))
    by = Window.partitionBy("s", "z").orderBy("slice")
    cut = cells.groupBy("s", "z", "more", "slice").agg(F.sum("c").alias("c")).withColumn("upto", F.sum("c").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    cut = cut.where((F.col("upto") >= F.col("more")) & (F.col("upto") - F.col("c") < F.col("more"))).select(F.col("s").alias("s2"), F.col("z").alias("z2"), F.col("slice").alias("slice2"), (F.col("upto") - F.col("c")).alias("before"))
    inside = cells.join(cut, F.col("s").eqNullSafe(F.col("s2")) & (F.col("z") == F.col("z2")) & (F.col("slice") == F.col("slice2")))
    fine = Window.partitionBy("s", "z").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("rank", F.col("before") + F.sum("c").over(fine))
    # The first number of the slice is no member of it, so a line before all of the slice's is one too.
    line = F.coalesce(F.max(F.when(F.col("rank") <= F.col("more"), F.col("o"))), F.min("o") - 1)
    lines = inside.groupBy("s", "z").agg(line.alias("line"))
    groups = groups.join(lines, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left").drop("s", "z")
    groups = materialise(groups.select(F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "rate", F.floor(F.col("m") / F.col("n")).alias("base"), F.coalesce("line", F.lit(-1)).alias("line")), "mix-lines")
    out = rows.join(small(groups), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    copies = F.col("base") + (F.col("o") <= F.col("line")).cast("long")
    return out.select("row.*", "size", "source_size", F.round("target", 6).alias("target"), F.round("rate", 6).alias("rate"), copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def oracle(table: str = "documents") -> str:
    """(doc_id, size, source_size, target, taken) in DuckDB's SQL: the dual by the same Newton rounds, without slices."""
    fills, last = "", "m0"
    for k in range(FILLS):
        fills += f"""f{k} AS (SELECT *, CASE WHEN size > 0 AND size <= missing THEN 2 * n - m ELSE 0 END AS room FROM (SELECT *, floor(target + 1e-6)::BIGINT - sum(m * size) OVER (PARTITION BY source) AS missing FROM {last})),
m{k + 1} AS (SELECT source, size, n, source_size, target, m + greatest(0, least(room, floor((missing - offered) / greatest(size, 1))::BIGINT)) AS m FROM (SELECT *, sum(room * size) OVER (PARTITION BY source ORDER BY size DESC) - room * size AS offered FROM f{k})),
"""
        last = f"m{k + 1}"
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS o FROM {table}),
h AS (SELECT source, size, count(*) AS n FROM d GROUP BY 1, 2),
s AS (SELECT source, sum(size * n)::BIGINT AS source_size, sum(size * n) / greatest(1, coalesce(sum(n) FILTER (WHERE size > 0), 1))::DOUBLE AS mean FROM h GROUP BY 1),
r AS (SELECT *, [{', '.join(f'{w}.0::DOUBLE' for w in WEIGHTS)}][((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C")) - 1) % {len(WEIGHTS)} + 1] AS w, 2.0::DOUBLE * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level FROM r
  WINDOW o AS (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, mean, least(most, (max(level) OVER ()) * w) AS target FROM l),
x AS (SELECT source, 0 AS k, 0.0::DOUBLE AS x, NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM t WHERE source_size > 0 AND target < 2.0::DOUBLE * source_size * (1 - 1e-12::DOUBLE)
  UNION ALL SELECT source, k + 1, CASE WHEN (coalesce(goes < low, false) OR coalesce(goes > high, false)) AND low IS NOT NULL AND high IS NOT NULL THEN (low + high) / 2 ELSE goes END, low, high
  FROM (SELECT source, k, CASE WHEN g <= 0 THEN x ELSE low END AS low, CASE WHEN g > 0 THEN x ELSE high END AS high,
    x + CASE WHEN h > 0 THEN greatest(-{STRIDE}::DOUBLE, least({STRIDE}::DOUBLE, -g / h)) WHEN g > 0 THEN -{STRIDE}::DOUBLE ELSE {STRIDE}::DOUBLE END AS goes
    FROM (SELECT x.source, x.k, any_value(x.x) AS x, any_value(low) AS low, any_value(high) AS high, sum(n * size * least(2.0::DOUBLE, exp(x.x * size / mean))) - any_value(target) AS g,
        sum(n * size * size / mean * exp(x.x * size / mean)) FILTER (WHERE exp(x.x * size / mean) < 2) AS h
      FROM x JOIN h ON h.source IS NOT DISTINCT FROM x.source JOIN t ON t.source IS NOT DISTINCT FROM x.source WHERE x.k < {ROUNDS} GROUP BY x.source, x.k))),
y AS (SELECT h.source, h.size, h.n, t.source_size, t.target, round(n * CASE WHEN x.k IS NOT NULL THEN least(2.0::DOUBLE, exp(round(x.x, {DECIMALS}) * size / mean)) WHEN source_size > 0 THEN 2 ELSE 1 END * {MICRO})::BIGINT AS want
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source LEFT JOIN x ON x.source IS NOT DISTINCT FROM h.source AND x.k = {ROUNDS}),
m0 AS (SELECT source, size, n, source_size, target, (upto // {MICRO} - (upto - want) // {MICRO})::BIGINT AS m FROM (SELECT *, sum(want) OVER (PARTITION BY source ORDER BY size DESC)::BIGINT AS upto FROM y)),
{fills}g AS (SELECT d.*, source_size, target, m // n AS base, m % n AS more, count(*) OVER (PARTITION BY d.source, d.size ORDER BY o RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank
  FROM d JOIN {last} AS z ON d.source IS NOT DISTINCT FROM z.source AND d.size = z.size)
SELECT doc_id, size, source_size, round(target, 6) AS target, ((base + CASE WHEN rank <= more THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM g"""
