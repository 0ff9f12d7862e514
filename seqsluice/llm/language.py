"""Language identification by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, in_learning_fold, keyed

OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
#: All ASCII bytes but letters are blanks.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
PIECE = 1 << 20


def ngram_counts(texts: list[bytes], dims: int) -> np.ndarray:
    """Counts of hashed byte 1- to 3-grams, a row for each text; dims is a power of two. Texts are lower-cased UTF-8."""
    out = np.zeros((len(texts), dims), np.float32)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    for row, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PIECE):
            x = np.frombuffer(b" " * 2 * (at == 0) + text[max(0, at - 2) : at + PIECE].translate(LETTERS) + b" " * (at + PIECE >= len(text)), np.uint8).astype(np.uint32)
            gram = x[2:]
            for n in (1, 2, 3):
                if n > 1:
                    gram = gram | (x[3 - n : len(x) - n + 1] << np.uint32(8 * (n - 1)))
                out[row] += np.bincount(((gram + np.uint32(n << 24)) * np.uint32(2654435761)) >> shift, minlength=dims)
    return out


def features(texts: list[bytes], dims: int) -> np.ndarray:
    """Square roots of relative counts: rows of norm 1."""
    counts = ngram_counts(texts, dims)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))


def codewords(n: int, bits: int) -> np.ndarray:
    """n words of +-1. Up to 5 classes, all the splits of the classes; beyond, the columns of a seeded draw that keep words apart."""
    if n <= 5:
        cols = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c] or [(1,) * n]
        return np.array(cols, np.float32).T
    best, gap = None, -1
    for seed in range(200):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (n, bits))
        distance = (bits - code @ code.T) / 2
        least = distance[~np.eye(n, dtype=bool)].min()
        mixed = np.abs(code.sum(0)).max() < n
        if mixed and least > gap:
            best, gap = code, least
    return best if best is not None else np.where(np.eye(n) > 0, 1, -1).astype(np.float32)


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    margin: float

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword by the weighted exponential loss of the bits, its share of exp(-loss), and whether the second is near."""
        f = np.clip(x @ self.weights + self.bias, -3, 3)
        loss = (np.exp(-f[:, None, :] * self.code[None]) * self.trust).sum(2)
        p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        order = np.sort(p, 1)
        second = order[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        return loss.argmin(1), p.max(1), order[:, -1] - second < self.margin


def fit(x: np.ndarray, y: np.ndarray, langs: list[str], bits: int = 31, ridge: float = 0.3, margin: float = 0.2) -> Model:
    """One least-squares classifier a bit, classes weighted alike; a bit is trusted by its weighted training margin. Beyond 128 languages words have more bits."""
    code = codewords(len(langs), max(bits, 4 * (len(langs) - 1).bit_length()))
    w = (len(y) / np.bincount(y, minlength=len(langs)).clip(1) / len(langs))[y].astype(np.float64)
    t = code[y].astype(np.float64)
    bias = (w[:, None] * t).sum(0) / w.sum()
    if len(x) <= x.shape[1]:
        xs = x.astype(np.float64) * np.sqrt(w)[:, None]
        alpha = np.linalg.solve(xs @ xs.T + ridge * np.eye(len(xs)), np.sqrt(w)[:, None] * (t - bias))
        weights = xs.T @ alpha
    else:  # the same by the smaller matrix
        gram, right = ridge * np.eye(x.shape[1]), np.zeros((x.shape[1], t.shape[1]))
        for at in range(0, len(x), 1000):
            own = slice(at, at + 1000)
            xs = x[own].astype(np.float64) * w[own, None]
            gram += xs.T @ x[own]
            right += xs.T @ (t[own] - bias)
        weights = np.linalg.solve(gram, right)
    hit = (w[:, None] * ((x @ weights + bias) * t > 0)).sum(0) / w.sum()
    trust = np.clip(2 * hit - 1, 0.05, 1)
    return Model(langs, code, weights.astype(np.float32), bias.astype(np.float32), (trust / trust.sum()).astype(np.float32), margin)


def _lower(col: pa.Array) -> list[bytes]:
    return [t.lower().encode() if t else b"" for t in col.to_pylist()]


def learn(docs: DataFrame, each: int = 300, dims: int = 4096, most: int = 8_000) -> Model | None:
    """Fitted on documents of every language of the learning fold: at most `each` of a language, the first by md5(doc_id), and fewer of each where languages are so many that the sample would exceed `most`; one at least.

    That sample is the only part of the data that reaches the driver, as rows of `dims` floats: 131 MB for 8,000 of 4,096, and as much again for the matrix of their products. None without any labelled row."""
    known = keyed(docs.where(in_learning_fold() & F.col("lang").isNotNull()), "lang", "text", "doc_id").select("_d", "_t", "lang", "text", F.md5(F.col("doc_id").cast("string").cast("binary")).alias("p"))
    there = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(there)
    if not langs:
        return None
    each = max(1, min(each, most // len(langs)))
    spark = docs.sparkSession
    by = Window.partitionBy("y").orderBy("p", "_t")

    def first(cuts: list[tuple[str, int, float]]) -> list:
        """The first of each language among the ids whose hash is below its cut."""
        place = F.conv(F.substring("p", 1, 8), 16, 10).cast("double") / 2.0**32
        near = known.select("lang", "_d", "_t", "p").join(F.broadcast(spark.createDataFrame(cuts, "lang string, y int, cut double")), "lang").where(place < F.col("cut"))
        return near.withColumn("n", F.row_number().over(by)).where(F.col("n") <= each).select("y", "_d", "_t").collect()

    # A cut twice as wide as needed and more leaves few rows to rank; where ids repeat so that it was too narrow, all rows are ranked.
    cuts = [(lang, k, min(1.0, (2 * each + 200) / there[lang])) for k, lang in enumerate(langs)]
    found = first(cuts)
    got = Counter(r.y for r in found)
    if short := [(lang, k, 1.0) for lang, k, cut in cuts if cut < 1 and got[k] < min(each, there[lang])]:
        again = {k for _, k, _ in short}
        found = [r for r in found if r.y not in again] + first(short)
    chosen = spark.createDataFrame(found, "y int, _d long, _t long")
    # The ids chosen are at most each times the languages; their texts are fetched where they lie.
    sample = known.select("_d", "_t", "text").join(F.broadcast(chosen.select("y", "_d", "_t").distinct()), ["_d", "_t"]).groupBy("y", "_d", "_t").agg(F.any_value("text").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                s = b.slice(at, 64)
                x = features(_lower(s.column(1)), dims)
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["y", "x"])

    got = sample.select("y", "text").mapInArrow(rows, "y int, x binary").toPandas()
    pairs = sorted(zip(got["y"], got["x"]))  # whatever order the tasks ended in
    return fit(np.stack([np.frombuffer(v, np.float32) for _, v in pairs]), np.array([y for y, _ in pairs]), langs)


def predict(docs: DataFrame, model: Model | None, dims: int = 4096) -> DataFrame:
    """docs with lang_pred, score (the share of the nearest codeword) and ambiguous (the second codeword is near).

    A null text, or one without a letter, is `und` with score 0, ambiguous; so is every text where no language was learned. Columns of docs with these names are replaced."""
    own = [c for c in docs.columns if c not in OUT.names]
    schema = docs.select(*own).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                s = b.slice(at, 64)
                texts = s.column(s.schema.get_field_index("text")).to_pylist()
                pred, score, vague = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                live = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
                if live:
                    best, p, near = model.decode(features([texts[i].lower().encode() for i in live], dims))
                    for i, k, v, n in zip(live, best, p, near):
                        pred[i], score[i], vague[i] = model.langs[k], float(v), bool(n)
                new = batch({"lang_pred": pred, "score": score, "ambiguous": vague}, OUT)
                yield pa.RecordBatch.from_arrays([*s.columns, *new.columns], names=[*s.schema.names, *OUT.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.select(*own).mapInArrow(run, f"{fields}, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for every document, learned from the others' lang alone."""
    model = learn(docs)
    return predict(docs.select("doc_id", (~in_learning_fold()).alias("held_out"), "text"), model).drop("text")
