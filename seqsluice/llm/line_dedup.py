"""Line dedup by a segment-partition edit join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, materialise, packed, small

FIRST = ("_d", "_t", "i")
#: Letters whose counts tell lines apart before their texts are compared.
LETTERS = "etaoinsrhldc"


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(_d, _t, i, line, h, g) of each line of at least `least` characters, blanks at its ends aside; h and g identify it."""
    own = keyed(docs, "text").where(F.col("text").isNotNull()).select("_d", "_t", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    own = own.withColumn("line", F.trim("line")).where(F.char_length("line") >= least)
    return own.withColumns({"h": F.xxhash64("line"), "g": F.hash("line")})


def _keys(lines: DataFrame, places: list[tuple[int, int, int]], most: int) -> DataFrame:
    """(h, letters, key) of substrings of each line. A place (shorter, i, shift) is where the i-th of most + 1 segments of a line that is so many characters shorter would be, shifted; the last segments are the longer.

    The places are a small table that each line is exploded by, so the plan's code stays short whatever their number."""
    parts = most + 1
    table = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(p, ("shorter", "i", "shift"))]) for p in places])
    rows = lines.select("h", "letters", "n_chars", "line", F.explode(table).alias("p")).select("h", "letters", "n_chars", "line", "p.i", "p.shift", (F.col("n_chars") - F.col("p.shorter")).alias("length"))
    short = F.floor(F.col("length") / parts).cast("int")
    rest = F.pmod("length", F.lit(parts))
    start = 1 + (F.col("i") - 1) * short + F.greatest(F.lit(0), F.col("i") - 1 - parts + rest) + F.col("shift")
    size = short + F.when(parts - F.col("i") < rest, 1).otherwise(0)
    rows = rows.where((start >= 1) & (start + size <= F.col("n_chars") + 1))
    return rows.select("h", "letters", F.xxhash64("length", "i", F.substring("line", start, size)).alias("key"))


def _letters() -> Column:
    """Counts of LETTERS in the line, modulo 16, four bits each."""
    n = lambda c: (F.octet_length("line") - F.octet_length(F.replace("line", F.lit(c), F.lit("")))) % 16
    out = F.lit(0).cast("long")
    for k, c in enumerate(LETTERS):
        out = out.bitwiseOR(F.shiftleft(n(c).cast("long"), 4 * k))
    return out


def _may_match(a: Column, b: Column, most: int) -> Column:
    """Whether the letters allow `most` edits: an edit adds a letter at most and takes one at most."""
    more, less = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(v, 4 * k).bitwiseAND(F.lit(15).cast("long")) for v in (a, b))
        d = (x - y + 16).bitwiseAND(F.lit(15).cast("long"))
        more += F.when(d < 8, d).otherwise(0)
        less += F.when(d >= 8, 16 - d).otherwise(0)
    return (more <= most) & (less <= most)


def _index(lines: DataFrame, most: int) -> DataFrame:
    return _keys(lines, [(0, i, 0) for i in range(1, most + 2)], most).withColumnsRenamed({"h": "b", "letters": "letters_b"})


def _probes(lines: DataFrame, most: int) -> DataFrame:
    """For each length up to `most` shorter than the line, the substrings that a segment of such a line can meet within `most` edits (multi-match-aware windows)."""
    places = []
    for shorter in range(most + 1):
        for i in range(1, most + 2):
            low, high = max(1 - i, shorter - (most + 1 - i)), min(i - 1, shorter + most + 1 - i)
            places += [(shorter, i, shift) for shift in range(low, high + 1)]
    return _keys(lines, places, most).withColumnsRenamed({"h": "a", "letters": "letters_a"})


def _close(a: Column, b: Column, most: int) -> Column:
    """Whether two arrays of characters are within `most` edits, `most` up to 4.

    Bit-parallel in one long: lane e has a bit for each of the 2 * most + 1 diagonals that e edits can be on. For each character of b
    a mask tells on which diagonals a has the same one; a match stays on its diagonal and in its lane, an exchanged character goes up a lane, one that
    only b has a diagonal down as well, one that only a has a diagonal up."""
    width = 2 * most + 1
    lane, band = width + 1, (1 << width) - 1
    spread = sum(1 << e * lane for e in range(most + 1))
    lanes = F.lit(band * spread).cast("long")
    mask = lambda c, j: sum((F.when(F.get(a, j + d) == c, 1 << d + most).otherwise(0) for d in range(-most, most + 1)), F.lit(0)).cast("long")

    def up(e: int):
        """What a character that only a has adds to lane e + 1."""
        own, above = (F.lit(band << k * lane).cast("long") for k in (e, e + 1))
        return lambda t: t.bitwiseOR(F.shiftleft(t.bitwiseAND(own), lane + 1).bitwiseAND(above))

    def step(s: Column, m: Column) -> Column:
        moved = s.bitwiseAND(m * spread).bitwiseOR(F.shiftleft(s.bitwiseOR(F.shiftright(s, 1).bitwiseAND(lanes)), lane)).bitwiseAND(lanes)
        for e in range(most):  # lambdas hold what the next lane repeats
            moved = F.element_at(F.transform(F.array(moved), up(e)), 1)
        return moved

    start = sum(((1 << e + 1) - 1) << most + e * lane for e in range(most + 1))
    last = F.aggregate(F.transform(b, mask), F.lit(start).cast("long"), step)
    apart = F.size(a) - F.size(b)
    ends = F.call_function("shiftleft", F.lit(spread).cast("long"), F.greatest(apart + most, F.lit(0)))
    return (F.abs(apart) <= most) & (last.bitwiseAND(ends) != 0)


def removals(docs: DataFrame, most: int = 2, least: int = 20, shortest: int = 5) -> DataFrame:
    """(_d, _t, removed, near): numbers (from 0) of each document's removed lines, and how many of them have no exact twin before."""
    by_first = F.struct(*FIRST)
    distinct = _lines(docs, shortest).groupBy("h", "g").agg(F.min(by_first).alias("first"), F.count("*").alias("n"), F.any_value("line").alias("line"))
    distinct = distinct.withColumn("n_chars", F.char_length("line")).withColumn("letters", F.when(F.col("n_chars") >= least, _letters()))
    distinct = materialise(distinct, "lines")
    long = distinct.where(F.col("n_chars") >= least)
    # A probing line and an indexed one of no greater length share a segment; equal lines share h.
    pairs = _probes(long, most).join(_index(long, most), "key").where((F.col("a") != F.col("b")) & _may_match(F.col("letters_a"), F.col("letters_b"), most))
    pairs = materialise(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    met = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    texts = materialise(distinct.join(met, "h", "left_semi").select("h", "first", "line"), "line-texts")
    left = texts.select(F.col("h").alias("a"), F.col("first").alias("first_a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("h").alias("b"), F.col("first").alias("first_b"), F.col("line").alias("line_b"))
    both = pairs.join(left, "a").join(right, "b")
    # A generator holds the characters, else the lambdas would split the lines for each of them.
    both = both.select("a", "b", "first_a", "first_b", F.explode(F.array(F.struct(F.split("line_a", "").alias("x"), F.split("line_b", "").alias("y")))).alias("c"))
    near = both.where(_close(F.col("c.x"), F.col("c.y"), most))
    later = near.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("h")).distinct().withColumn("near", F.lit(True))
    decided = distinct.select("h", "g", "first", "n").join(later, "h", "left").where((F.col("n") > 1) | F.col("near"))
    hit = _lines(docs, shortest).select(*FIRST, "h", "g").join(decided, ["h", "g"])
    is_first = by_first == F.col("first")
    gone = hit.where(F.col("near") | ~is_first)
    return gone.groupBy("_d", "_t").agg(F.array_sort(F.collect_set("i")).alias("removed"), F.count_if(is_first).alias("near"))


RESULTS = ("kept", "n_lines", "n_removed", "n_near", "removed")


def dedup_lines(docs: DataFrame, most: int = 2, least: int = 20, shortest: int = 5) -> DataFrame:
    """docs with kept (the text without repeated lines), n_lines, n_removed, n_near and removed (line numbers from 0).

    Lines are what newlines separate, without blanks at their ends. A line of at least `shortest` characters goes if an equal
    line first occurs earlier, one of at least `least` also if a distinct one of so many, within `most` edits, does; earlier is by doc_id, then text, then line number.
    Shorter lines, such as braces, and blank ones stay.

    Distinct lines are split into most + 1 segments, of which an edit join's match must hold one unchanged; segments are
    indexed by length, number and content, and probed by each line's substrings at the places that can match. Lines that
    meet are a pair only if their counts of letters allow so few edits, and pairs are verified with the banded, bit-parallel
    edit distance (_close). Equal lines are one before the join, so neither a hot line nor a group of copies multiplies; distinct lines of one
    length that share a segment do meet in the join, as many as there are. The list of removals is broadcast to the documents if it is small, and joined by a shuffle otherwise.

    A null text has no line and stays null; an empty one has one empty line. A null doc_id sorts first. Rows equal in id and text are one document here: their lines don't count as repeats of each other. Columns of docs with the names of results are replaced.
    """
    found = materialise(removals(docs, most, least, shortest), "line-removals")
    out = packed(docs, RESULTS).join(small(found), ["_d", "_t"], "left")
    # A generator holds the lines, else the lambda below would split the text for each of them.
    out = out.withColumn("_lines", F.explode(F.array(F.split(F.coalesce("text", F.lit("")), "\n"))))
    rest = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("removed"))
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.transform(rest, lambda i: F.get("_lines", i)), "\n"))
    return out.select("row.*", kept.alias("kept"), F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), F.coalesce("near", F.lit(0)).alias("n_near"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_near, removed) for every document; removed as text, like 0,3."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "n_near", F.array_join("removed", ",").alias("removed"))


def oracle(most: int = 2, least: int = 20, shortest: int = 5, table: str = "documents") -> str:
    """The same in DuckDB's SQL, by comparing all distinct lines of like length. The hash of equal ids' texts is of no account where ids differ."""
    return rf"""WITH l AS (SELECT doc_id, i::INT - 1 AS i, trim(line, ' ') AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {table}) WHERE length(trim(line, ' ')) >= {shortest}),
f AS (SELECT line, min((doc_id, i)) AS first, length(line) AS n FROM l GROUP BY line),
near AS (SELECT DISTINCT b.line FROM f a JOIN f b ON a.n >= {least} AND b.n >= {least} AND a.n BETWEEN b.n - {most} AND b.n + {most} AND a.first < b.first AND levenshtein(a.line, b.line) <= {most}),
gone AS (SELECT l.doc_id, l.i, (l.doc_id, l.i) = f.first AS is_first FROM l JOIN f USING (line) LEFT JOIN near ON l.line = near.line WHERE near.line IS NOT NULL OR (l.doc_id, l.i) <> f.first),
r AS (SELECT doc_id, list_sort(list(i)) AS removed, count(*)::INT AS n_removed, count(*) FILTER (WHERE is_first) AS n_near FROM gone GROUP BY 1)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10)))::INT END AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near, coalesce(array_to_string(removed, ','), '') AS removed FROM {table} d LEFT JOIN r ON d.doc_id IS NOT DISTINCT FROM r.doc_id"""
