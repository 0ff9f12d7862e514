"""Suffix-array dedup: removal of repeated byte strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keyed, materialise, packed, small, text_bytes, whole_groups

#: Bytes of a repeated string, of the grams that anchor the suffixes, and of the context beside a gram that a string through it can reach.
LENGTH, GRAM = 200, 64
SIDE = LENGTH - GRAM
#: Stands between documents; no byte equals it.
GAP = 256
TILE, HALO = 1 << 17, 512
#: Suffixes of a bucket, and of one gram that a task may compare at once after a split; those of more are compared window by window.
BUCKET, TOGETHER = 40_000, 20_000
#: Occurrences of one context that a task joins.
HOT = 20_000
MIX = np.uint64(0x9E3779B97F4A7C15)
CODES = np.random.default_rng(3).integers(1, 1 << 63, GAP + 1, dtype=np.uint64)
KEY = ["g", "l", "r"]


def _double(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of strings twice as long, along the last axis."""
    x = h[..., :-step] * MIX
    x ^= x >> np.uint64(29)
    x += h[..., step:]
    return x


def _ladder(x: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all strings of 1, 2, 4, ... 128 symbols."""
    out = {1: CODES[x]}
    n = 1
    while n < 128:
        out[2 * n] = _double(out[n], n)
        n *= 2
    return out


def _end(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * MIX
    h ^= h >> np.uint64(32)
    h *= MIX
    return h ^ (h >> np.uint64(29))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a = a * MIX
    a ^= a >> np.uint64(31)
    return a + b


def _slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """of(x[i : i + width]) for all i."""
    n = 1
    out = x
    while 2 * n <= width:
        out = of(out[:-n], out[n:])
        n *= 2
    return of(out[: len(x) - width + 1], out[width - n :][: len(x) - width + 1])


def anchors(x: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """Places in [lo, hi) of x that anchor a window, with hashes of the gram there and of the SIDE symbols before and after it.

    Each window of LENGTH bytes is anchored where its least gram hash is, everywhere on ties; equal windows have the same anchors in the same places."""
    at = max(0, lo - HALO)
    part = x[at : min(len(x), hi + HALO)]
    rungs = _ladder(part)
    gram = _end(rungs[GRAM], 1)
    least = _slide(gram, SIDE + 1, np.minimum)
    whole = (part[: len(least)] != GAP) & (part[LENGTH - 1 : LENGTH - 1 + len(least)] != GAP)
    least = np.where(whole, least, np.uint64(0))
    pad = np.zeros(SIDE, np.uint64)
    chosen = _slide(np.concatenate([pad, least, pad]), SIDE + 1, np.maximum)
    here = np.flatnonzero((chosen == gram) & (gram > 0))
    here = here[(here + at >= lo) & (here + at < hi)]
    side = _end(_pair(rungs[128][: len(part) - SIDE + 1], rungs[8][128 : 128 + len(part) - SIDE + 1]), 2)
    return here + at, gram[here], side[here - SIDE], side[here + GRAM]


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with gaps of LENGTH before, between and after them; where each begins."""
    gap = np.full(LENGTH, GAP, np.uint16)
    parts, starts, at = [gap], [], LENGTH
    for t in texts:
        starts.append(at)
        parts += [np.frombuffer(t, np.uint8).astype(np.uint16), gap]
        at += len(t) + LENGTH
    return np.concatenate(parts), np.array(starts, np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        data = big.column(2).to_pylist()
        at = 0
        while at < len(data):
            end, size = at, 0
            while end < len(data) and (end == at or size + len(data[end]) < 1 << 20):
                size += len(data[end])
                end += 1
            x, starts = _laid_out(data[at:end])
            lens = np.array([len(t) for t in data[at:end]])
            d, t = (big.column(i).slice(at, end - at).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo in range(LENGTH, len(x), TILE):
                where, g, left, right = anchors(x, lo, min(len(x), lo + TILE))
                doc = np.searchsorted(starts, where, side="right") - 1
                pos = where - starts[doc]
                la, ra = np.minimum(SIDE, pos), np.minimum(SIDE, lens[doc] - pos - GRAM)
                yield pa.RecordBatch.from_arrays([pa.array(d[doc]), pa.array(t[doc]), pa.array(pos), pa.array(la.astype(np.int16)), pa.array(ra.astype(np.int16)), *(pa.array(_signed(v)) for v in (g, left, right))], names=["_d", "_t", "pos", "la", "ra", *KEY])
            at = end


ANCHOR = "_d long, _t long, pos long, la short, ra short, g long, l long, r long"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each wanted anchor: the suffix that starts there and the bytes before it, as far as a window through the gram can reach."""
    for b in batches:
        for data, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([data[w["pos"] : w["pos"] + LENGTH] for w in wanted], pa.binary()),
                    pa.array([data[max(0, w["pos"] - SIDE) : w["pos"]] for w in wanted], pa.binary()),
                    *(pa.array([w[k] for w in wanted], pa.int64()) for k in KEY),
                ],
                names=["suffix", "before", *KEY],
            )


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Order of the rows, compared word by word: rows equal so far are split by the next word, and only those that still have an equal go on."""
    order = np.arange(len(words))
    group = np.zeros(len(words), np.int64)
    live = np.arange(len(words))
    for c in range(words.shape[1]):
        if len(live) < 2:
            break
        key = words[order[live], c]
        by = np.lexsort((key, group[live]))
        order[live] = order[live][by]
        g, key = group[live], key[by]  # groups are stretches, so they stay in place
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])])
        first = live[new]
        group[live] = first[np.cumsum(new) - 1]
        size = np.diff(np.append(np.flatnonzero(new), len(live)))
        live = live[np.repeat(size, size) > 1]
    return order


def _padded(values: list[bytes], width: int, right: bool) -> np.ndarray:
    out = np.full((len(values), width), GAP, np.uint16)
    for i, v in enumerate(values):
        if right:
            out[i, width - len(v) :] = np.frombuffer(v, np.uint8)
        else:
            out[i, : len(v)] = np.frombuffer(v, np.uint8)
    return out


def _window_hashes(context: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each offset o of the gram in a window: rows whose window is whole, and the window's hash."""
    for lo in range(0, len(context), 2000):
        part = context[lo : lo + 2000]
        rungs = _ladder(part)
        whole = (part[:, : SIDE + 1] != GAP) & (part[:, LENGTH - 1 : LENGTH + SIDE] != GAP)
        h = _end(_pair(_pair(rungs[128][:, : SIDE + 1], rungs[64][:, 128 : 129 + SIDE]), rungs[8][:, 192 : 193 + SIDE]), 4)
        for o in range(SIDE + 1):
            rows = np.flatnonzero(whole[:, SIDE - o])
            yield o, rows + lo, h[rows, SIDE - o]


def _reach(suffix: np.ndarray, before: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted suffixes in groups of one gram: how far before the gram and past it the repeated windows through it go; -1 without one.

    All such windows of a row overlap in the gram, so their union is one run. Two rows share the window that begins o bytes before
    the gram if their suffixes agree in the other LENGTH - o bytes and they agree in the o bytes before. The first is
    told by the common prefixes of neighbours: rows between which none is shorter are a stretch of the order. Of a stretch, rows whose bytes before agree too have one hash."""
    far_l, far_r = np.full(len(group), -1), np.full(len(group), -1)
    if len(group) < 2:
        return far_l, far_r
    shared = np.concatenate([[0], np.where(group[1:] == group[:-1], _common(suffix[1:], suffix[:-1]), 0)])
    alike = np.maximum(shared, np.append(shared[1:], 0))  # with the closer neighbour
    left, right = (before != GAP).sum(1), (suffix != GAP).sum(1) - GRAM
    hashes = np.zeros(len(group), np.uint64)
    power = np.ones(1, np.uint64)
    for o in range(SIDE + 1):
        if o:
            hashes = hashes + CODES[before[:, SIDE - o]] * power
            power = power * MIX
        live = np.flatnonzero((alike >= LENGTH - o) & (left >= o) & (right >= SIDE - o))
        if len(live) < 2:
            continue
        stretch = np.cumsum(shared < LENGTH - o)[live].astype(np.uint64)
        key = _end(hashes[live] ^ (stretch * CODES[GAP]), 5)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        hit = live[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
        far_l[hit] = o
        far_r[hit] = np.maximum(far_r[hit], SIDE - o)
    return far_l, far_r


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the rows, gaps aside."""
    differ = (a != b) | (a == GAP)
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def _sorted(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Suffixes in order, the bytes before them, their keys, the order, and the number of each one's gram."""
    suffix = _padded(rows["suffix"].to_pylist(), LENGTH, False)
    before = _padded(rows["before"].to_pylist(), SIDE, True)
    order = multikey_sort(np.ascontiguousarray(suffix.astype(">u2")).view(">u8"))
    suffix, before = suffix[order], before[order]
    group = np.cumsum(np.concatenate([[0], (suffix[1:, :GRAM] != suffix[:-1, :GRAM]).any(1)]))
    return suffix, before, [rows[k].to_numpy()[order] for k in KEY], order, group


SUFFIX = "g long, l long, r long, suffix binary, before binary"
REACH = "g long, l long, r long, left long, right long"


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts one bucket's suffixes and compares those of one gram. The first and last gram may go on in the buckets beside, so their suffixes are passed on for the comparison across boundaries."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    suffix, before, keys, order, group = _sorted(rows)
    edge = (group == 0) | (group == group[-1])
    inner = np.flatnonzero(~edge)
    far_l, far_r = _reach(suffix[inner], before[inner], group[inner])
    hit = far_l >= 0
    none = pa.nulls(int(hit.sum()), pa.binary())
    yield pa.RecordBatch.from_arrays([*(pa.array(k[inner][hit]) for k in keys), pa.array(far_l[hit]), pa.array(far_r[hit]), none, none], names=[*KEY, "left", "right", "suffix", "before"])
    outer = rows.take(pa.array(order[edge]))
    none = pa.nulls(outer.num_rows, pa.int64())
    cols = [outer[k].combine_chunks() for k in KEY] + [none, none] + [outer[k].combine_chunks() for k in ("suffix", "before")]
    yield pa.RecordBatch.from_arrays(cols, names=[*KEY, "left", "right", "suffix", "before"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares all suffixes of each gram; rows of a gram are together."""
    for b in whole_groups(batches):
        suffix, before, keys, _, group = _sorted(b)
        far_l, far_r = _reach(suffix, before, group)
        hit = far_l >= 0
        yield pa.RecordBatch.from_arrays([*(pa.array(k[hit]) for k in keys), pa.array(far_l[hit]), pa.array(far_r[hit])], names=[*KEY, "left", "right"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows through each gram, as hashes."""
    for b in batches:
        if b.num_rows:
            suffix, before = _padded(b["suffix"].to_pylist(), LENGTH, False), _padded(b["before"].to_pylist(), SIDE, True)
            for o, at, h in _window_hashes(np.concatenate([before, suffix], axis=1)):
                left = np.full(len(at), o)
                yield pa.RecordBatch.from_arrays([*(pa.array(b[k].to_numpy()[at]) for k in KEY), pa.array(left), pa.array(SIDE - left), pa.array(_signed(h))], names=[*KEY, "left", "right", "window"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for data, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            runs: list[list[int]] = []
            for s in sorted((s["start"], s["end"]) for s in spans or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append([*s])
            kept, at = [], 0
            for lo, hi in runs:
                kept.append(data[at:lo])
                at = hi
            rest = b"".join([*kept, data[at:]])
            out.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([*b.columns[2:], *(pa.array(cols[i], pa.int64()) for i in range(3)), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())], names=[*b.schema.names[2:], *RESULTS])


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def repeats(docs: DataFrame) -> DataFrame:
    """(_d, _t, spans): for each document with a repeated string, the runs of bytes (start, end) that repeated strings cover; runs may overlap."""
    found = materialise(keyed(docs, text_bytes().alias("data")).mapInArrow(_anchors, ANCHOR), "anchors")
    again = materialise(found.groupBy("g").count().where("count > 1").select("g"), "repeated-grams")
    kept = materialise(found.join(again, "g"), "repeated-anchors")
    discard(found)
    place = F.struct("_d", "_t", "pos")
    contexts = materialise(kept.groupBy(*KEY).agg(F.count("*").alias("n"), F.min(place).alias("first")), "contexts")
    # Anchors whose whole context occurs again need no more; the others are compared with all contexts of their gram. A context of very many occurrences is dealt to several tasks.
    again = contexts.where("n > 1").select(*KEY, F.ceil(F.col("n") / HOT).alias("parts"))
    hot = materialise(again.where("parts > 1"), "hot-contexts")
    dealt = kept.join(small(hot), KEY, "left").withColumn("part", F.pmod(F.xxhash64("_d", "_t", "pos"), F.coalesce("parts", F.lit(1)))).drop("parts")
    twins = dealt.join(again.select(*KEY, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")), [*KEY, "part"])
    spans = twins.select("_d", "_t", (F.col("pos") - F.col("la")).alias("start"), (F.col("pos") + GRAM + F.col("ra")).alias("end"))
    open_grams = contexts.where("n = 1").select("g").distinct()
    wanted = contexts.join(open_grams, "g", "left_semi").select("first._d", "first._t", F.struct("first.pos", *KEY).alias("w"))
    wanted = materialise(wanted.groupBy("_d", "_t").agg(F.collect_list("w").alias("wanted")), "wanted")
    texts = keyed(docs, text_bytes().alias("data"))
    suffixes = texts.join(wanted, ["_d", "_t"]).select("data", "wanted").mapInArrow(_contexts, "suffix binary, before binary, g long, l long, r long")
    suffixes = materialise(suffixes, "suffixes")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // BUCKET))
    buckets = materialise(suffixes.repartitionByRange(parts, "suffix", "l", "r").mapInArrow(_bucket, f"{REACH}, suffix binary, before binary"), "buckets")
    edges = buckets.where("suffix IS NOT NULL").select(*KEY, "suffix", "before")
    sizes = edges.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    few = edges.join(sizes.where(F.col("n") <= TOGETHER).select("g"), "g").repartition("g").sortWithinPartitions("g").mapInArrow(_across, REACH)
    many = edges.join(sizes.where(F.col("n") > TOGETHER).select("g"), "g").mapInArrow(_windows, f"{REACH}, window long")
    shared = many.groupBy("window", "left").count().where("count > 1").select("window", "left")
    many = many.join(shared, ["window", "left"]).select(*KEY, "left", "right")
    reach = buckets.where("suffix IS NULL").select(*KEY, "left", "right").unionByName(few).unionByName(many).groupBy(*KEY).agg(F.max("left").alias("left"), F.max("right").alias("right"))
    single = contexts.where("n = 1").join(reach, KEY).select("first._d", "first._t", (F.col("first.pos") - F.col("left")).alias("start"), (F.col("first.pos") + GRAM + F.col("right")).alias("end"))
    return materialise(spans.unionByName(single).groupBy("_d", "_t").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def dedup(docs: DataFrame) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes): without each byte that a LENGTH-byte string covers which also starts anywhere else.

    A sparse suffix array stands for that of all bytes. Of each window of LENGTH bytes one suffix is taken, where the
    window's least gram hash is, so equal windows are met through suffixes at the same place in them; a suffix whose gram occurs
    once can't be in a repeated window and goes first. Suffixes whose context on both sides occurs again are settled by
    that. The others go, with one of each context of their gram, to buckets between sampled splitters of their leading
    bytes, about BUCKET suffixes each; a bucket is sorted by multikey quicksort, and the common prefixes of neighbours, with hashes
    of the bytes before, tell the repeated windows. Splitters can fall inside a gram's suffixes, even equal ones; those of a bucket's
    first and last gram are compared across boundaries in the same way, up to TOGETHER of a gram in one task, more of them by counting their windows.

    Hot passages are counted before any join, and no task gathers more than TOGETHER suffixes of a gram or HOT occurrences of a context.
    Null texts are empty. Rows equal in id and text are separate documents, so each repeats the other. An empty table gives no rows. Columns of docs with the names of results are replaced.
    """
    found = repeats(docs)
    joined = packed(docs, RESULTS).join(found, ["_d", "_t"], "left").select(text_bytes().alias("data"), "spans", "row")
    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"row {row}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").select("row.*", *RESULTS)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256); the text goes in once, as bytes."""
    found = repeats(docs)
    joined = keyed(docs, text_bytes().alias("data"), "doc_id").join(found, ["_d", "_t"], "left").select("data", "spans", "doc_id")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").drop("kept")
