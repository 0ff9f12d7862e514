"""N-gram Jaccard join by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, packed, small, text_bytes, whole_groups
from .components import components
from .shingles import minima, shingle_sets

#: Sampled tokens of a set: its least members under so many hash functions.
TOKENS = 64
#: A bucket of more sets is split further.
BUCKET = 1000
#: Children of a root bucket that is split; below, a bucket has one and with this chance a second, 1 / threshold in all.
FIRST_CHILDREN, SECOND_CHILD = 4, 0.25
#: Sets and shingles of a block of a large candidate component.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21


def _nodes(k: int):
    """(_d, _t, node, size, tokens): node is a hash of the text's shingle set, 0 size for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                sets = shingle_sets(b.column(2).to_pylist(), k)
                live = [s for s in sets if len(s)]
                rows = iter(minima(live, TOKENS))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([next(rows).tobytes() if len(s) else b"" for s in sets], pa.binary())], names=["_d", "_t", "node", "size", "tokens"])

    return run


def _node(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1).to_pylist(), k)], pa.binary())], names=["node", "members"])

    return run


class Forest:
    """Union of sets of nodes; keeps the links that joined two."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((x, y))


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), TOKENS)


def _brute(alike: int):
    """Links between sets of one bucket whose sampled tokens agree in `alike` places or more: a spanning forest of them, not all pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in whole_groups(batches):
            path, node, x = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), _matrix(b.column(2))
            forest = Forest()
            live = np.arange(len(path) - 1)
            for k in range(1, len(path)):
                live = live[live + k < len(path)]
                live = live[path[live] == path[live + k]]
                if not len(live):
                    break
                for part in np.array_split(live, max(1, len(live) >> 14)):
                    for i in part[(x[part] == x[part + k]).sum(1) >= alike]:
                        forest.join(int(node[i]), int(node[i + k]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in forest.links], pa.int64()), pa.array([c for _, c in forest.links], pa.int64())], names=["a", "b"])

    return run


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        same = (_matrix(b.column(2)) == _matrix(b.column(4))).sum(1) if b.num_rows else []
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(same, pa.int32())], names=["path", "node", "tokens", "pivot", "same"])


def _token(place: Column) -> Column:
    """The sampled token at a place, as bytes."""
    return F.substring("tokens", place * 4 + 1, F.lit(4))


def _children(level: int) -> Column:
    """Paths of the child buckets that a set of a large bucket goes to, by the tokens at places which the path picks. Their number doesn't depend on the bucket's size."""
    start, stride = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(TOKENS)), 2 * F.pmod(F.xxhash64("path", F.lit(2)), F.lit(TOKENS // 2)) + 1
    child = lambda j: F.xxhash64("path", F.lit(j), _token(F.pmod(start + j * stride, F.lit(TOKENS)).cast("int")))
    if not level:
        return F.array(*map(child, range(FIRST_CHILDREN)))
    second = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(1000)) < 1000 * SECOND_CHILD
    return F.when(second, F.array(child(0), child(1))).otherwise(F.array(child(0)))


def candidate_links(sets: DataFrame, threshold: float, recall: float, spare: float = 0.2) -> list[DataFrame]:
    """(a, b), a table for each level: links that connect all pairs of (node, tokens) which are as alike as `threshold`, but for a share of 1 - recall that share no run's token and those below, and few others.

    A run picks one sampled token for all sets and puts sets that share its value into a bucket; a pair of similarity s
    shares it with probability s, so log(1 - recall) / log(1 - threshold) runs reach the recall for this step alone. Buckets of
    up to BUCKET sets are compared outright by all their sampled tokens; pairs that agree in a share of threshold - spare are
    linked. In a larger bucket all sets are compared with one pivot. Those alike to it are linked with it and need no link with
    each other. If they outnumber those up to twice as far, these are linked with the pivot too: by the triangle inequality, no
    set beyond can then be alike to the pivot's own, so those leave the bucket, and the component that is verified is at most
    twice as large. Otherwise only those leave that can't be alike to a set that isn't linked. What stays is split by sampled
    tokens that the path picks: into FIRST_CHILDREN children at the root, one token each, and into 1 / 0.8 on average at each
    level below, the branching of a chosen path. A level thus has a constant number of rows for each set that stays, whatever its
    bucket's size. All sets that share the buckets of another run in the same company are compared once.

    Losses at similarity 0.8 with 64 tokens and six runs: pairs that agree in under 39 tokens (1.3e-4 by the binomial); pairs
    that share no run's token (0.2^6 = 6.4e-5). Where each run splits the pair's bucket, it loses a share of the pairs that
    it had together: 0.2^4 with one level, 1.2e-2 with two, 3.1e-2 with three, 5.6e-2 with four, so that six runs miss 6.6e-5,
    8.9e-5, 1.3e-4 and 2.2e-4. All fall quickly above the threshold."""
    alike = math.ceil((threshold - spare) * TOKENS)
    far = TOKENS - alike
    runs = math.ceil(math.log(1 - recall) / math.log(1 - threshold) - 1e-9)
    roots = [F.struct(F.xxhash64(F.lit(r), _token(F.lit(r))).alias("path")) for r in range(runs)]
    rows = sets.select("node", F.explode(F.array(*roots)).alias("p")).select("p.path", "node")
    links, level, above = [], 0, None
    while True:
        sizes = rows.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("who")).where("n > 1")
        once = sizes.where(F.col("n") <= BUCKET).groupBy("n", "who").agg(F.min("path").alias("path")).select("path", "n").unionByName(sizes.where(F.col("n") > BUCKET).select("path", "n"))
        kept = rows.join(once, "path")
        kept = materialise((kept if level else kept.join(sets, "node")).select("path", "node", "tokens", "n"), f"buckets-{level}")
        if above is not None:
            discard(above)
        few = kept.where(F.col("n") <= BUCKET).select("path", "node", "tokens").repartition("path").sortWithinPartitions("path")
        found = few.mapInArrow(_brute(alike), "a long, b long")
        large = kept.where(F.col("n") > BUCKET).select("path", "node", "tokens")
        more = not large.isEmpty()
        if more:
            pivots = large.groupBy("path").agg(F.min("node").alias("pivot")).join(sets.select(F.col("node").alias("pivot"), F.col("tokens").alias("other")), "pivot")
            beside = large.join(pivots, "path").select("path", "node", "tokens", "pivot", "other")
            beside = above = materialise(beside.mapInArrow(_agree, "path long, node long, tokens binary, pivot long, same int"), f"pivots-{level}")
            apart = TOKENS - F.col("same")
            near, middle = apart <= far, (apart > far) & (apart <= 2 * far)
            around = beside.groupBy("path").agg(F.count_if(near).alias("n1"), F.count_if(middle).alias("n2"), F.min(F.when(~near, apart)).alias("d1"), F.min(F.when(apart > 2 * far, apart)).alias("d2"))
            beside = beside.join(around, "path").withColumn("dense", F.col("n2") <= F.col("n1"))
            found = found.unionByName(beside.where((near | (F.col("dense") & middle)) & (F.col("node") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("node").alias("b")))
            open_dense = (apart > 2 * far) | (middle & (apart >= F.col("d2") - far))
            stay = beside.where(F.coalesce(F.when(F.col("dense"), open_dense).otherwise(~near | (apart >= F.col("d1") - far)), F.lit(False)))
            rows = stay.select("node", "tokens", F.explode(_children(level)).alias("path"))
            level += 1
        links.append(materialise(found, "links"))
        discard(kept)
        if not more:
            return links


def _exact(threshold: float):
    """Exact similarities inside a task (one block of a component, or a pair of blocks): each set's links to others, weighted by their copies, and a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in whole_groups(batches):
            task = b.column(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(task)) + 1, [len(task)]])
            node, part, copies, paired = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 5))
            members = b.column(4)
            out, links = [], []
            for lo, hi in zip(cuts, cuts[1:]):
                sets = [np.frombuffer(m.as_py(), np.uint64) for m in members[lo:hi]]
                sizes = np.array([len(s) for s in sets])
                near = _shared(sets) >= threshold * (sizes[:, None] + sizes[None, :]) / (1 + threshold) - 1e-9
                np.fill_diagonal(near, False)
                if paired[lo]:  # between blocks only
                    near &= part[lo:hi, None] != part[None, lo:hi]
                out += zip(node[lo:hi].tolist(), (near @ copies[lo:hi]).tolist())
                forest = Forest()
                for i, j in zip(*np.nonzero(np.triu(near))):
                    forest.join(int(node[lo + i]), int(node[lo + j]))
                links += forest.links
            rows = [(n, k, None, None) for n, k in out if k] + [(None, None, x, y) for x, y in links]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["node", "links", "a", "b"])

    return run


def _shared(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of indicator matrices over `width` members at a time that two sets or more have."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    use = count[code] > 1
    code, owner = rank[code[use]], owner[use]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [at, at + width])
        own, place = np.unique(owner[lo:hi], return_inverse=True)
        x = np.zeros((len(own), width), np.float32)
        x[place, code[lo:hi] - at] = 1
        out[np.ix_(own, own)] += x @ x.T
    return out


RESULTS = ("class_id", "n_links", "class_key", "is_first")


def join(docs: DataFrame, threshold: float = 0.8, k: int = 5, recall: float = 0.9999) -> DataFrame:
    """docs with class_id, n_links, class_key and is_first: the documents whose sets of k-word shingles have a Jaccard similarity of at least `threshold`.

    n_links counts the other documents alike to this one, copies included. class_id is the least doc_id of those it is linked
    with over any number of links, its own where there are none. Where ids repeat, two classes can have one class_id;
    class_key tells them apart (null without words), and is_first marks the class's least document by id and hash of its
    text (rows equal in both are all marked).

    Documents of one shingle set are one node from the start (a 64-bit hash of the set), so copies never meet. Chosen paths
    over sampled tokens connect candidates (candidate_links has their recall); inside each candidate component all pairs are
    verified on the whole sets, a large component in pairs of blocks, each a task of its own. A block has about BLOCK sets and
    BLOCK_SHINGLES shingles. Counts are exact for the pairs inside a component.
    The verification is quadratic in the distinct sets of one component, which counting their links can't avoid; no pair is a row.

    Words are runs of digits, a-z after lower-casing A-Z, and non-ASCII characters; fewer than k are one shingle. A text without words, or null,
    has no links, and its own id as class. A null doc_id sorts before others. Rows equal in id and text count as copies of each other. Columns of docs with the names of results are replaced.
    """
    whole = packed(docs, RESULTS)
    nodes = whole.select("_d", "_t", text_bytes().alias("data")).mapInArrow(_nodes(k), "_d long, _t long, node long, size long, tokens binary")
    nodes = materialise(nodes, "nodes")
    place = F.struct("_d", "_t")
    sets = materialise(nodes.where("size > 0").groupBy("node").agg(F.any_value("tokens").alias("tokens"), F.min(place).alias("first"), F.count("*").alias("copies"), F.max("size").alias("size")), "sets")
    links = candidate_links(sets.select("node", "tokens"), threshold, recall)
    candidates = components(reduce(DataFrame.unionByName, links))
    found = candidates.join(sets.select("node", "first", "copies", "size"), "node").select("node", "root", "copies", "size", "first._d", "first._t")
    found = materialise(found, "candidates")
    for made in links:
        discard(made)
    texts = whole.select("_d", "_t", text_bytes().alias("data")).join(small(found.select("_d", "_t", "node"), found), ["_d", "_t"])
    sizes = found.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("nb"))
    placed = found.join(sizes, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("nb")))
    members = materialise(texts.select("node", "data").mapInArrow(_sets(k), "node long, members binary").groupBy("node").agg(F.any_value("members").alias("members")), "members")
    pairs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))
    tasks = placed.join(members, "node").select("root", "node", "part", "copies", "members", pairs.alias("with"))
    tasks = tasks.select(F.xxhash64("root", F.least("part", "with"), F.greatest("part", "with")).alias("task"), "node", "part", "copies", "members", (F.col("part") != F.col("with")).alias("paired"))
    verified = materialise(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_exact(threshold), "node long, links long, a long, b long"), "verified")
    discard(members)
    linked = verified.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(verified.where("a IS NOT NULL").select("a", "b"))
    ids = sets.select("node", "first", "copies").join(roots, "node", "left").join(linked, "node", "left")
    ids = materialise(ids.select("node", F.coalesce("root", "node").alias("root"), "first", "copies", F.coalesce("links", F.lit(0)).alias("links")), "classes")
    for made in (found, verified, sets):
        discard(made)
    best = ids.groupBy("root").agg(F.min("first").alias("best"))
    ids = ids.join(best, "root").select("node", "root", "best", (F.col("links") + F.col("copies") - 1).alias("links"))
    per_row = nodes.where("size > 0").select("_d", "_t", "node").distinct().join(ids, "node").select("_d", "_t", "best", "root", "links")
    out = whole.join(per_row, ["_d", "_t"], "left")
    label = F.coalesce("best._d", "_d")
    first = F.coalesce((F.col("_d") == F.col("best._d")) & (F.col("_t") == F.col("best._t")), F.lit(True))
    return out.select("row.*", F.when(label != -(2**63), label).alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"), F.col("root").alias("class_key"), first.alias("is_first"))


def oracle(threshold: float = 0.8, k: int = 5) -> str:
    """(doc_id, class_id, n_links) in DuckDB's SQL, by counting shared shingles of all pairs that share one."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {k - 1}], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE x >= {threshold} * (na.c + nb.c) / {1 + threshold} - 1e-9),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(root) AS class_id FROM r GROUP BY 1),
t AS (SELECT a, count(*) AS n_links FROM l GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM documents JOIN m ON node = doc_id LEFT JOIN t ON a = doc_id"""
