"""Benchmark decontamination with a generalised suffix automaton of the items."""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded, key, materialise, packed, small, text_bytes, words_of

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Builder:
    """All substrings of some items' word sequences; a state is a set of substrings with the same ends. States and edges are numbers in arrays."""

    def __init__(self, n: int):
        self.n = n
        self.vocab: dict[bytes, int] = {}
        self.link, self.len = array("i", [-1]), array("i", [0])
        #: Each state's last edge, and of each edge the one before and its word; by state and word, where an edge leads.
        self.last, self.before, self.word = array("i", [-1]), array("i"), array("i")
        self.to: dict[int, int] = {}
        self.items: list[tuple[str, array]] = []
        self.words = 0

    def add(self, item: str, words: list[bytes]) -> None:
        if not words:
            return
        seq = array("i", [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words])
        self.items.append((item, seq))
        self.words += len(seq)
        at = 0
        for w in seq:
            at = self._extend(at, w)

    def held(self) -> int:
        """Bytes in use: hash tables as Python measures them, two numbers or a word of about 60 bytes for each entry, and arrays."""
        return sys.getsizeof(self.to) + 64 * len(self.to) + sys.getsizeof(self.vocab) + 90 * len(self.vocab) + 12 * len(self.len) + 8 * len(self.word) + 4 * self.words

    def _state(self, length: int, link: int) -> int:
        self.len.append(length)
        self.link.append(link)
        self.last.append(-1)
        return len(self.len) - 1

    def _edge(self, p: int, w: int, q: int) -> None:
        self.to[p << 32 | w] = q
        self.before.append(self.last[p])
        self.word.append(w)
        self.last[p] = len(self.word) - 1

    def _cloned(self, p: int, q: int, w: int) -> int:
        """A state for the substrings of q no longer than those that p's give."""
        if self.len[p] + 1 == self.len[q]:
            return q
        new = self._state(self.len[p] + 1, self.link[q])
        e = self.last[q]
        while e >= 0:
            self._edge(new, self.word[e], self.to[q << 32 | self.word[e]])
            e = self.before[e]
        self.link[q] = new
        while p >= 0 and self.to.get(p << 32 | w) == q:
            self.to[p << 32 | w] = new
            p = self.link[p]
        return new

    def _extend(self, at: int, w: int) -> int:
        if (q := self.to.get(at << 32 | w)) is not None:  # another item has been here
            return self._cloned(at, q, w)
        new, p = self._state(self.len[at] + 1, 0), at
        while p >= 0 and p << 32 | w not in self.to:
            self._edge(p, w, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._cloned(p, self.to[p << 32 | w], w)
        return new


class Automaton:
    """A builder's states as flat arrays that many matches walk at once."""

    def __init__(self, built: Builder):
        self.vocab = built.vocab
        self.link, self.len = np.array(built.link, np.int32), np.array(built.len, np.int32)
        self.link[0] = 0
        edges = np.fromiter(built.to.keys(), np.int64, len(built.to))
        order = np.argsort(edges)
        self.edges, self.to = edges[order], np.fromiter(built.to.values(), np.int32, len(built.to))[order]
        self.names = [item for item, _ in built.items]
        lengths = [min(built.n, len(s)) for _, s in built.items]
        self.lengths = sorted(set(lengths))
        #: Of each window length: the states of windows, and of each the items that have it, as numbers in names.
        self.windows: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        found: dict[int, dict[int, set[int]]] = {m: {} for m in self.lengths}
        for k, ((_, seq), m) in enumerate(zip(built.items, lengths)):
            at = np.zeros(1, np.int64)
            states = np.empty(len(seq), np.int64)
            for i, w in enumerate(seq):  # an item is a path from the start
                at = built.to[int(at) << 32 | w] if i else built.to[w]
                states[i] = at
            for s in np.unique(self.of_length(states[m - 1 :], m)).tolist():
                found[m].setdefault(s, set()).add(k)
        for m, by in found.items():
            states = np.array(sorted(by), np.int64)
            self.windows[m] = states, [sorted(by[s]) for s in states.tolist()]
        pairs = [np.array(s[:-1], np.int64) << 32 | np.array(s[1:], np.int64) for _, s in built.items]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)

    def of_length(self, states: np.ndarray, m: int) -> np.ndarray:
        """The states that have the last m words of matches in these states."""
        while True:
            up = self.link[states]
            climb = (self.len[up] >= m) & (states > 0)
            if not climb.any():
                return states
            states = np.where(climb, up, states)

    def _place(self, where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(where, what), max(len(where) - 1, 0))
        return at, where[at] == what if len(where) else np.zeros(len(what), bool)

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows can be: runs of words, each pair of which some item has. ids: 0 for a word that no item has."""
        least = self.lengths[0]
        if least == 1:
            ok = ids > 0
        else:
            ok = (ids[:-1] > 0) & (ids[1:] > 0)
            at = np.flatnonzero(ok)
            ok[at] = self._place(self.pairs, ids[at] << 32 | ids[at + 1])[1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
        a, b = edge[::2], edge[1::2]
        stay = b - a >= max(1, least - 1)
        return a[stay], b[stay] + (least > 1)

    def match(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, end, items) of each window found: all stretches take a word at a time, the longest match that ends there is the state and its length."""
        a, b = self.stretches(ids) if len(ids) and self.names else (np.empty(0, np.int64),) * 2
        order = np.argsort(a - b, kind="stable")
        a, size = a[order], (b - a)[order]
        state, length = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for j in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -j))
            s, n, w = state[:live], length[:live], ids[a[:live] + j]
            todo = np.arange(live)
            while len(todo):
                at, found = self._place(self.edges, s[todo] << 32 | w[todo])
                s[todo[found]] = self.to[at[found]]
                n[todo[found]] += 1
                todo = todo[~found]
                n[todo[s[todo] == 0]] = 0
                todo = todo[s[todo] > 0]
                s[todo] = self.link[s[todo]]
                n[todo] = self.len[s[todo]]
            for m in self.lengths:
                rows = np.flatnonzero(n >= m)
                if not len(rows):
                    break
                at, found = self._place(self.windows[m][0], self.of_length(s[rows], m))
                for r, k in zip(rows[found].tolist(), at[found].tolist()):
                    end = int(a[r]) + j + 1
                    yield end - m, end, self.windows[m][1][k]


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _found(auto: Automaton, texts: list[bytes]) -> tuple[list[int], dict[int, list]]:
    """Words of each text, and by text its hits (first word, end, items)."""
    get = auto.vocab.get
    ids, ends, counts = [], [], []
    for data in texts:
        own = [get(w, 0) for w in words_of(data)]
        counts.append(len(own))
        ids += own
        ids.append(0)
        ends.append(len(ids))
    hits: dict[int, list] = {}
    for lo, hi, found in auto.match(np.array(ids, np.int64)):
        doc = int(np.searchsorted(ends, lo, side="right"))
        first = ends[doc - 1] if doc else 0
        hits.setdefault(doc, []).append((lo - first, hi - first, found))
    return counts, hits


def _together(auto: Automaton, got: list) -> tuple[list[int], list[str]]:
    """Hits as runs of words in a flat list, and the items."""
    return [x for s in merged([[a, z] for a, z, _ in got]) for x in s], sorted({auto.names[k] for _, _, f in got for k in f})


def _hits(shared):
    """(_d, _t, spans, items) of the texts with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            _, hits = _found(shared.value, b.column(2).to_pylist())
            rows = pa.array(list(hits), pa.int64())
            both = [_together(shared.value, got) for got in hits.values()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array([s for s, _ in both], pa.list_(pa.int32())), pa.array([i for _, i in both], pa.list_(pa.string()))], names=["_d", "_t", "spans", "items"])

    return run


def _report(shared, limit: float, text: int):
    """Hits of the last block and of those before it, and what follows from them. text: its place in the row; cleaned is null where it would be the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            texts = [t or b"" for t in b.column(2).field(text).cast(pa.binary()).to_pylist()]
            counts, hits = _found(shared.value, texts)
            out = []
            for k, (data, n, old, had) in enumerate(zip(texts, counts, b.column(0).to_pylist(), b.column(1).to_pylist())):
                spans, items = _together(shared.value, hits.get(k, []))
                if old:
                    spans = [x for s in merged([*map(list, zip(old[::2], old[1::2])), *map(list, zip(spans[::2], spans[1::2]))]) for x in s]
                    items = sorted({*items, *had})
                hit = sum(spans[1::2]) - sum(spans[::2])
                out.append((cut(data, spans) if spans else None, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0, hit > 0 and hit >= limit * n))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(2), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))], names=["row", *REPORT])

    return run


REPORT = ("cleaned", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "over_limit")


def cut(data: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans, from the first letter of the first to the last of the last."""
    if not spans:
        return data
    at = [m.span() for m in WORD.finditer(data.translate(WORD_BYTES))]
    out, done = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(data[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, data[done:]])


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, limit: float = 0.5, block_bytes: int = 128 << 20) -> DataFrame:
    """docs with cleaned (the text without the hit spans), n_words, n_hit, n_items, items_sha256, contaminated, and over_limit (at least `limit` of the words are hit).

    The items go in blocks: a block ends with the item that brings the automaton in the driver to block_bytes, so that neither
    the driver nor what is broadcast (flat arrays, smaller) grows with the benchmark. Each block but the last is a pass over the texts that
    writes the hits alone; the last one joins them and reports. A document's words stream through the automaton, which
    holds the longest match that ends at each word; where that is long enough, the window is looked up. Only stretches in which each
    pair of neighbours occurs in an item are streamed: elsewhere a match can't reach two words. Stretches of many documents go a word at a time together, by array operations.

    Null texts and items have no words; a null item_id counts as the empty text, and rows of one item_id are one item in
    the counts. An empty benchmark hits nothing. cleaned is null only where the text is. Columns of docs with the names of results are replaced.
    """
    bounded(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    texts = docs.select(*key(), text_bytes().alias("data"))
    earlier: DataFrame | None = None
    block = Builder(n)
    for row in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_bytes().alias("data")).toLocalIterator():
        if block.held() >= block_bytes:
            hits = texts.mapInArrow(_hits(sc.broadcast(Automaton(block))), "_d long, _t long, spans array<int>, items array<string>")
            hits = materialise(hits, "decontaminate-hits")
            earlier = hits if earlier is None else earlier.unionByName(hits)
            block = Builder(n)
        block.add(row.item, words_of(bytes(row.data)))
    state = packed(docs, REPORT)
    if earlier is None:
        state = state.withColumns({"spans": F.lit(None).cast("array<int>"), "items": F.lit(None).cast("array<string>")})
    else:
        hits = materialise(earlier.groupBy("_d", "_t").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "decontaminate-hits")
        state = state.join(small(hits), ["_d", "_t"], "left")
    state = state.select("spans", "items", "row")  # the text goes once, in its row
    text = [f.name.lower() for f in state.schema["row"].dataType].index("text")
    out = state.mapInArrow(_report(sc.broadcast(Automaton(block)), limit, text), f"row {state.schema['row'].dataType.simpleString()}, cleaned binary, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, over_limit boolean")
    cleaned = F.when(F.col("row.text").isNotNull(), F.coalesce(F.col("cleaned").cast("string"), F.col("row.text").cast("string")))
    return out.select("row.*", cleaned.alias("cleaned"), *REPORT[1:])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs.select("doc_id", "text"), items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def oracle(n: int = 10) -> str:
    """report() in DuckDB's SQL: all windows of all documents, joined as text."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, w, least({n}, len(w)) AS m FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, m, array_to_string(w[k : k + m - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS k FROM i)),
d AS (SELECT doc_id, {words} AS w FROM documents),
dw AS (SELECT doc_id, m, k, array_to_string(w[k : k + m - 1], ' ') AS s FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM i) WHERE len(w) >= m)),
h AS (SELECT doc_id, m, k, item FROM dw JOIN iw USING (m, s)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM h) GROUP BY 1),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)"""
