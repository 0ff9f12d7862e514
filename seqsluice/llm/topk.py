"""Exact top-k search by columnar branch-and-bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, materialise, store_of

OUT = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("n", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
PAIRS = "q long, query_id long, n long, vec_id long, score long"
#: Components of the candidates that a task lays out at once.
CHUNK = 1 << 22
#: Below this, sums of products of integers are exact in a double.
EXACT = 2**53


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): each component x as floor(scale * x). Rows whose id or vector is null, or whose vector holds a null or non-finite component, take no part."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    ok &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.coalesce(ok, F.lit(False))).select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def _matrix(col: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    ends = col.offsets.to_numpy()
    flat, ends = col.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], ends - ends[0]
    sizes = np.diff(ends)
    out = {}
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out[int(d)] = rows, flat[ends[rows][:, None] + np.arange(d)].reshape(len(rows), d)
    return out


class Searcher:
    """The best k of all candidates it is shown, for each query of one length."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, width: int, tile: int = 256):
        self.ids, self.k, self.tile = ids, k, tile
        self.cuts = list(range(0, max(q.shape[1], 1), width)) + [q.shape[1]]
        self.top = np.abs(q).max(initial=0)
        self.q = q.astype(np.float64)
        self.q_int = q
        self.q_rest = self._rest(self.q)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def _rest(self, x: np.ndarray) -> list[np.ndarray]:
        """Norms of what is left after each block of dimensions."""
        return [np.sqrt((x[:, c:] ** 2).sum(1)) for c in self.cuts[1:]]

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        if x.shape[1] * float(max(1, self.top)) * float(max(1, np.abs(x).max(initial=0))) >= EXACT:
            for i in range(len(self.ids)):
                self._keep(i, ids, x, x @ self.q_int[i])
            return
        blocks = [np.ascontiguousarray(x[:, a:b], np.float64) for a, b in zip(self.cuts, self.cuts[1:])]
        rest = self._rest(x.astype(np.float64))
        first = min(4 * self.k, len(ids))
        for t in range(0, len(self.ids), self.tile):
            part = blocks[0] @ self.q[t : t + self.tile, : self.cuts[1]].T
            for j in range(part.shape[1]):
                i, lo = t + j, 0
                if len(self.best[i][0]) < self.k:  # a first bound
                    self._keep(i, ids[:first], x[:first], x[:first] @ self.q_int[i])
                    lo = first
                self._scan(i, ids[lo:], x[lo:], part[lo:, j], [b[lo:] for b in blocks], [r[lo:] for r in rest])

    def _scan(self, i: int, ids: np.ndarray, x: np.ndarray, score: np.ndarray, blocks: list, rest: list) -> None:
        least = self.best[i][0][-1] if len(self.best[i][0]) >= self.k else -np.inf
        alive = None
        for b in range(len(blocks)):
            if b:
                score = score + blocks[b][alive] @ self.q[i, self.cuts[b] : self.cuts[b + 1]]
            mass = (rest[b] if alive is None else rest[b][alive]) * self.q_rest[b][i]
            stay = np.flatnonzero(score + mass * (1 + 1e-9) + 1e-3 >= least)
            alive, score = stay if alive is None else alive[stay], score[stay]
            if not len(alive):
                return
        self._keep(i, ids[alive], x[alive], np.rint(score).astype(np.int64))

    def _keep(self, i: int, ids: np.ndarray, x: np.ndarray, score: np.ndarray) -> None:
        other = ids != self.ids[i]
        other[~other] = (x[~other] != self.q_int[i]).any(1)
        score, ids = np.concatenate([self.best[i][0], score[other]]), np.concatenate([self.best[i][1], ids[other]])
        order = np.lexsort((ids, -score))[: self.k]
        self.best[i] = score[order], ids[order]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids and vectors by their length, about CHUNK components at a time."""
    held: dict[int, list] = {}
    size = 0
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for d, (rows, x) in _matrix(b.column(1)).items():
            held.setdefault(d, []).append((ids[rows], x))
            size += x.size + len(rows)
        if size >= CHUNK:
            yield {d: (np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts])) for d, parts in held.items()}
            held, size = {}, 0
    if held:
        yield {d: (np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts])) for d, parts in held.items()}


def _best(files: list[str], k: int, width: int, block: int):
    """The best k of a chunk of candidates for each query. Queries are read from their files a block at a time, so a task holds one block and one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for file in files:
                store, path = store_of(file)
                with store.open_input_file(path) as f:
                    for b in pq.ParquetFile(f).iter_batches(block, columns=["vec_id", "v", "n", "q"]):
                        ids, n, q = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
                        for d, (rows, v) in _matrix(b.column(1)).items():
                            if d not in chunk:
                                continue
                            found = Searcher(ids[rows], v, k, width)
                            found.add(*chunk[d])
                            at = np.repeat(rows, [len(s) for s, _ in found.best])
                            yield batch({"q": q[at], "query_id": ids[at], "n": n[at], "vec_id": np.concatenate([i for _, i in found.best]), "score": np.concatenate([s for s, _ in found.best])}, OUT)

    return run


def _twins(k: int):
    """Of n equal query rows, each has the n - 1 others as candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n, q = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            for rows, v in _matrix(b.column(1)).values():
                at = np.repeat(np.arange(len(rows)), np.minimum(n[rows] - 1, k))
                yield batch({"q": q[rows[at]], "query_id": ids[rows[at]], "n": n[rows[at]], "vec_id": ids[rows[at]], "score": (v * v).sum(1)[at]}, OUT)

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, width: int = 16, query_block: int = 4096, scale: int = 256) -> DataFrame:
    """The k highest inner products of each row whose vec_id is divisible by `every`, against all other rows: (query_id, rank, vec_id, score), ties to the smaller id.

    Queries are written to the shared folder once and never reach the driver. A task lays a chunk of candidates out by blocks of
    `width` dimensions and reads the queries a block of query_block at a time, so its memory has a bound whatever
    the number of either; after each block of dimensions, those candidates stay whose score so far plus the product of the remaining norms
    (Cauchy-Schwarz) reaches the k-th best score yet. The best of all chunks meet by query.

    Rows are told apart as rows: of those that share an id, each is a query and the others are its candidates, equal vectors or not.
    Equal query rows are searched for once and each returned. Only vectors of one length are compared. Scores beyond 64 bits wrap
    around. Null ids and vectors, and null or non-finite components: the row takes no part. An empty table gives no rows.
    """
    space = quantised(vectors, scale)
    asked = (space.where(F.col("vec_id") % every == 0) if every > 1 else space).groupBy("vec_id", "v").agg(F.count("*").alias("n"))
    asked = materialise(asked.withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    pairs = space.mapInArrow(_best(sorted(asked.inputFiles()), k, width, query_block), PAIRS)
    pairs = pairs.unionByName(asked.where("n > 1").mapInArrow(_twins(k), PAIRS))
    by = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = pairs.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return best.select("query_id", "rank", "vec_id", "score", again.alias("copy")).drop("copy")
