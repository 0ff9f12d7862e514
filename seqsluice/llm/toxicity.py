"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over all terms of the examples."""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, in_learning_fold, materialise, store_of, text_bytes, work_dir
from .shingles import term_counts

#: Bytes of the beginning that stands for a longer word, so that a stem counts in all its endings.
STEM = 5
OUT = pa.schema([("score", pa.float64()), ("evidence", pa.list_(pa.int64()))])


#: Examples of a block of the index, and blocks that a query looks into before bounds decide.
BLOCK, FIRST = 64, 6


@dataclass
class Index:
    """Examples by row, with the postings of every term. Rows lie in blocks; of the terms of many examples the weights lie in a matrix, with the largest of each block beside it."""

    #: Hashes of the terms, in order.
    terms: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    k: int
    size: int = 256
    #: Rows and weights of the postings, term by term, and where each term's begin.
    rows: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    matrix: tuple | None = None
    #: Pairs of a query and a block so far, and those of them whose cosines were computed.
    met: int = 0
    opened: int = 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"matrix": None}

    def vectors(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text the known terms in order, and weights of norm 1: (1 + ln tf) idf."""
        text, term, tf = term_counts(texts, STEM)
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        known = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        text, at, tf = text[known], at[known], tf[known]
        w = weighted(text, self.idf[at] * (1 + np.log(tf)), len(texts))
        cuts = np.searchsorted(text, np.arange(1, len(texts)))
        return list(zip(np.split(at, cuts), np.split(w, cuts)))

    def build(self, example: np.ndarray, term: np.ndarray, w: np.ndarray) -> None:
        """Postings of examples' terms; examples are numbered as ids are."""
        order = np.argsort(term * max(1, len(self.ids)) + example)
        self.rows, self.weights = example[order], w[order]
        self.starts = np.searchsorted(term[order], np.arange(len(self.idf) + 1))
        self.matrix = None

    def _common(self, least: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each term in the matrix, or -1; the matrix of the terms that `least` of the examples hold, a block of rows after the other; and the largest weight of each term and block."""
        if self.matrix is None:
            many = np.flatnonzero(np.diff(self.starts) >= max(1, least * len(self.ids)))
            blocks = -(-len(self.ids) // BLOCK)
            at, dense = np.full(len(self.idf), -1), np.zeros((len(many), blocks * BLOCK))
            at[many] = np.arange(len(many))
            for i, t in enumerate(many):
                own = slice(self.starts[t], self.starts[t + 1])
                dense[i, self.rows[own]] = self.weights[own]
            dense = dense.reshape(len(many), blocks, BLOCK)
            self.matrix = at, np.ascontiguousarray(dense.transpose(1, 0, 2)), dense.max(2)
        return self.matrix

    def cosines(self, vectors: list[tuple[np.ndarray, np.ndarray]], skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines to nine places, -1 where a bound shows that a row is none of the k nearest; and of each vector what none of those is below.

        Terms of few examples give their part outright, by their postings. A block's best row can't exceed its best such part
        plus the block maxima of the other terms. A query looks into the FIRST blocks of the highest bounds; what the k-th
        best cosine there leaves possible is computed too."""
        at, dense, peak = self._common()
        blocks = len(dense)
        q, rest = np.zeros((len(vectors), dense.shape[1])), np.zeros((len(vectors), blocks * BLOCK))
        for i, (terms, w) in enumerate(vectors):
            place = at[terms]
            q[i, place[place >= 0]] = w[place >= 0]
            terms, w = terms[place < 0], w[place < 0]
            n = self.starts[terms + 1] - self.starts[terms]
            own = np.repeat(self.starts[terms] - np.cumsum(n) + n, n)
            own += np.arange(len(own))
            each = self.weights.take(own)
            each *= np.repeat(w, n)
            rest[i] = np.bincount(self.rows.take(own), each, minlength=blocks * BLOCK)
        rest = rest.reshape(len(vectors), blocks, BLOCK)
        bound = rest.max(2) + q @ peak
        out = np.full(rest.shape, -1.0)

        def look(pairs: np.ndarray) -> None:
            for b in np.flatnonzero(pairs.any(0)):
                own = np.flatnonzero(pairs[:, b])
                out[own, b] = np.round(q[own] @ dense[b] + rest[own, b], 9)
            if skip is not None:
                out[np.arange(len(out)), skip // BLOCK, skip % BLOCK] = 0
            self.opened += int(pairs.sum())

        first = np.zeros(bound.shape, bool)
        top = np.argpartition(-bound, FIRST, 1)[:, :FIRST] if blocks > FIRST else np.tile(np.arange(blocks), (len(vectors), 1))
        np.put_along_axis(first, top, True, 1)
        look(first)
        seen = np.take_along_axis(out, top[:, :, None], 1).reshape(len(vectors), -1)
        least = np.partition(seen, -self.k, 1)[:, -self.k] if seen.shape[1] > self.k else np.full(len(seen), -1.0)
        look(~first & (bound >= least[:, None] - 2e-9))
        self.met += bound.size
        return out.reshape(len(vectors), -1)[:, : len(self.ids)], least

    def neighbours(self, vectors: list[tuple[np.ndarray, np.ndarray]], skip: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector cosines and rows of the k nearest examples of positive cosine, ties to the smaller row."""
        for b in range(0, len(vectors) if len(self.ids) else 0, self.size):
            for own, low in zip(*self.cosines(vectors[b : b + self.size], None if skip is None else skip[b : b + self.size])):
                rows = np.flatnonzero(own >= low) if low > 0 else np.flatnonzero(own > 0)
                rows = rows[np.lexsort((rows, -own[rows]))[: self.k]]
                yield own[rows], rows
        if not len(self.ids):
            yield from ((np.empty(0), np.empty(0, np.int64)) for _ in vectors)

    def vote(self, cosines: np.ndarray, rows: np.ndarray) -> float:
        """Share of toxic among the neighbours, weighted by 1 / (0.05 + distance)."""
        w = 1 / (1.05 - cosines)
        return float((w * self.labels[rows]).sum() / w.sum())

    def votes(self, rows: np.ndarray) -> list[float | None]:
        """The vote on each of these examples, left out of its own; None where it has no neighbour."""
        by = np.argsort(self.rows, kind="stable")
        ends = np.searchsorted(self.rows[by], np.arange(len(self.ids) + 1))
        terms = np.repeat(np.arange(len(self.idf)), np.diff(self.starts))[by]
        own = [slice(ends[r], ends[r + 1]) for r in rows]
        return [self.vote(s, r) if len(r) else None for s, r in self.neighbours([(terms[o], self.weights[by[o]]) for o in own], rows)]


@dataclass
class Model:
    """Where the index lies, and the curve from votes to scores; without a path there is no example."""

    path: str | None = None
    k: int = 25
    slope: float = 0.0
    offset: float = -6.0
    #: The score of a text without any term of the index.
    none: float = 0.0

    def index(self) -> Index:
        return loaded(self.path, self.k) if self.path else Index(np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64), self.k)

    def scores(self, index: Index, texts: list[bytes]) -> list[tuple[float, list[int]]]:
        found = index.neighbours(index.vectors(texts))
        return [(1 / (1 + math.exp(-(self.slope * index.vote(s, r) + self.offset))), index.ids[r[:3]].tolist()) if len(r) else (self.none, []) for s, r in found]


@lru_cache(maxsize=1)
def loaded(path: str, k: int) -> Index:
    """The index that a task has written; a worker reads it once."""
    store, name = store_of(path)
    with store.open_input_stream(name) as f, np.load(io.BytesIO(f.read())) as held:
        index = Index(held["terms"], held["idf"], held["ids"], held["labels"], k)
        index.rows, index.weights, index.starts = held["rows"].astype(np.int64), held["weights"], held["starts"]
    return index


def calibrated(labels: np.ndarray, empty: np.ndarray, votes: list[float | None], weight: tuple[float, float] = (1.0, 1.0)) -> tuple[float, float, float]:
    """(slope, offset, none): Platt's curve over the examples' votes; examples without a term give the score of such texts. weight: how many labelled documents an example of each label stands for."""
    held = np.array(weight)[labels]
    if empty.any():
        none = float((1 + held[empty] @ labels[empty]) / (2 + held[empty].sum()))
    else:
        none = float(held @ labels / held.sum())
    ok = np.array([v is not None for v in votes], bool)
    v, y = np.array([v for v in votes if v is not None]), labels[ok]
    slope, offset = platt(v, y.astype(float), held[ok]) if len(set(y)) > 1 else (0.0, 6.0 if len(y) and y[0] else -6.0)
    return slope, offset, none


def weighted(example: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Weights whose squares add up to 1 in each of n examples."""
    return w / np.sqrt(np.bincount(example, w * w, n))[example]


def platt(v: np.ndarray, y: np.ndarray, w: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve with smoothed targets, by damped Newton steps; w are weights."""
    t = np.where(y > 0, ((w * y).sum() + 1) / ((w * y).sum() + 2), 1 / ((w * (1 - y)).sum() + 2))
    x = np.column_stack([v, np.ones(len(v))])
    b = np.array([1.0, -0.5])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g, h = x.T @ (w * (p - t)) + 1e-3 * b, (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return float(b[0]), float(b[1])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each example its terms' hashes and counts, as bytes."""
    for b in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        text, term, tf = term_counts(b.column(1).to_pylist(), STEM)
        cuts = np.searchsorted(text, np.arange(1, b.num_rows))
        made = [pa.array([x.tobytes() for x in np.split(v, cuts)], pa.binary()) for v in (term, tf.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *made], names=["doc_id", "toxic", "h", "terms", "tf"])


def _built(folder: str, k: int, least: float):
    """Writes the index of all examples that the one task is given: (row, toxic, empty, path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (2, 1, 0, 3, 4)))), key=lambda r: r[:2])
        if not rows:
            return
        n, y, ids = len(rows), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        example = np.repeat(np.arange(n), [len(r[4]) // 4 for r in rows])
        terms, term = np.unique(np.frombuffer(b"".join(r[3] for r in rows), np.uint64), return_inverse=True)
        tf = np.frombuffer(b"".join(r[4] for r in rows), np.int32)
        del rows
        pos = int(y.sum())
        c = np.bincount(term, minlength=len(terms)).astype(float)
        a = np.bincount(term, y[example], len(terms))
        phi = np.abs(a * (n - pos) - (c - a) * pos) / np.sqrt(float(max(pos, 1) * max(n - pos, 1)) * c * np.maximum(1, n - c))
        idf = np.log(1 + n / c) * (least + np.minimum(phi, 1))
        w = weighted(example, idf[term] * (1 + np.log(tf)), n)
        strongest = np.full(n, -1)
        by = np.lexsort((-w, example))
        has, first = np.unique(example[by], return_index=True)
        strongest[has] = term[by][first]
        order = np.argsort(strongest, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        index = Index(terms, idf, ids[order], y[order], k)
        index.build(place[example], term, w)
        out = io.BytesIO()
        np.savez(out, terms=terms, idf=idf, ids=index.ids, labels=index.labels, rows=index.rows.astype(np.int32), weights=index.weights, starts=index.starts)
        path = f"{folder}/{uuid.uuid4().hex}.npz"  # the attempt that Spark commits names its own file
        store, name = store_of(path)
        store.create_dir(name.rpartition("/")[0], recursive=True)
        with store.open_output_stream(name) as f:
            f.write(out.getbuffer())
        empty = np.bincount(index.rows, minlength=n) == 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(index.labels), pa.array(empty), pa.array([path] * n)], names=["row", "toxic", "empty", "path"])

    return run


def learn(docs: DataFrame, labels: DataFrame, examples: int = 8000, least: float = 0.1, k: int = 25) -> Model:
    """The index of a bounded sample: of the labelled documents of the learning fold `examples` at most, half of them toxic if there
    are so many (else all toxic ones, and more of the others), in each label those that come first by md5(doc_id).

    Every word and beginning of these texts is a term, chosen without the label. Its weight is the idf times least + phi, the
    correlation of its presence with the label: by idf alone the noise of rare words outweighs the signs, and neighbours tell
    little. Equal texts of the sample with one label are one example; with both labels, an example of each. An id with
    both labels is toxic. An example stands for as many labelled documents of its label as were drawn from, so that
    calibration is by the true shares. Rows are in order of their strongest term, then of the text's hash, so that block
    maxima differ and ties go by content; ids are evidence only. Terms are known by 48 bits of a hash.
    The ids of the sample are broadcast to find its texts; one task builds the index of them in the shared folder, where all
    others read it. Only each example's label and vote reach the driver."""
    spark = docs.sparkSession
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    known = labels.where(in_learning_fold() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") > 0).cast("long").alias("toxic"), place.alias("p"))
    there = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    most = max(examples // 2, examples - there.get(0, 0))
    drawn = {1: min(there.get(1, 0), most)}
    drawn[0] = min(there.get(0, 0), examples - drawn[1])
    each = [known.where(F.col("toxic") == y).orderBy("p").limit(n) for y, n in drawn.items()]
    chosen = each[0].unionByName(each[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text", "toxic", F.md5("text").alias("h"))
    counted = sample.mapInArrow(_counts, "doc_id long, toxic long, h string, terms binary, tf binary").repartition(1)
    made = materialise(counted.mapInArrow(_built(work_dir(spark, "toxicity-index"), k, least), "row long, toxic long, empty boolean, path string"), "toxicity-examples")
    rows = made.orderBy("row").collect()
    if not rows:
        return Model(k=k)
    path = rows[0].path

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(loaded(path, k).votes(b.column(0).to_numpy()), pa.float64())], names=["row", "vote"])

    got = dict(tuple(r) for r in spark.range(0, len(rows), 1, 12).withColumnRenamed("id", "row").mapInArrow(votes, "row long, vote double").collect())
    weight = tuple(there.get(v, 0) / max(1, drawn[v]) for v in (0, 1))
    return Model(path, k, *calibrated(np.array([r.toxic for r in rows]), np.array([r.empty for r in rows]), [got[i] for i in range(len(rows))], weight))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1) and evidence (ids of up to three nearest examples). A text without any term of the index, or null, has the score of such examples and no evidence. Columns of docs with these names are replaced."""
    own = [c for c in docs.columns if c not in OUT.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.index()
        for b in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            col = b.column(b.schema.get_field_index("text"))
            got = model.scores(index, [t or b"" for t in col.cast(pa.binary()).to_pylist()])
            new = batch({"score": [s for s, _ in got], "evidence": [e for _, e in got]}, OUT)
            yield pa.RecordBatch.from_arrays([*b.columns, *new.columns], names=[*b.schema.names, *OUT.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*own).schema)
    return docs.select(*own).mapInArrow(run, f"{fields}, score double, evidence array<bigint>")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every document."""
    scored = score(docs.select("doc_id", (~in_learning_fold()).alias("held_out"), "text"), learn(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
