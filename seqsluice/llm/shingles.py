"""Word shingles of many texts at once, and their minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import WORD_BYTES

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
#: Bits of a shingle's hash; the rest of a word holds the text's number in its batch.
BITS = np.uint64(48)
MASK = np.uint64((1 << 48) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX2
    x = (x ^ (x >> np.uint64(32))) * MIX2
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each."""
    buf = np.frombuffer(b"".join(t.translate(WORD_BYTES) + b" " for t in texts), np.uint8)
    letter = np.concatenate([[0], buf != 32]).astype(np.int8)
    edge = np.diff(letter)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[buf] * _powers(BASE, len(buf)))])
    hashes = _mixed((sums[ends] - sums[starts]) * _powers(BASE_INVERSE, len(buf))[starts])
    stops = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, stops), prepend=0)


def pieces(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers and texts in groups of about `size` bytes; a longer text goes in pieces that are cut at a blank of its words, so that arrays made of a group have a bound."""
    numbers: list[int] = []
    group: list[bytes] = []
    held = 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or not at and not text:
            end = len(text)
            if end - at > size:
                end = at + size
                while end < len(text) and WORD_BYTES[text[end]] != 32:
                    end += 1
            if group and held + end - at > size:
                yield numbers, group
                numbers, group, held = [], [], 0
            numbers.append(k)
            group.append(text[at:end])
            held += end - at
            at = end
            if not text:
                break
    if group:
        yield numbers, group


def term_counts(texts: list[bytes], stem: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count), in order of both: how often each word occurs in each of up to 65,536 texts, and of words of over `stem` bytes the first `stem`, as 48-bit hashes."""
    keys, counts = [], []
    for numbers, group in pieces(texts):
        buf = np.frombuffer(b"".join(t.translate(WORD_BYTES) + b" " for t in group), np.uint8)
        edge = np.diff(np.concatenate([[0], buf != 32]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[buf] * _powers(BASE, len(buf)))])
        back = _powers(BASE_INVERSE, len(buf))[starts]
        own = np.searchsorted(np.cumsum([len(t) + 1 for t in group]), starts, side="right")
        text = np.array(numbers, np.uint64)[own] << BITS
        words = _mixed((sums[ends] - sums[starts]) * back) & MASK
        long = np.flatnonzero(ends - starts > stem)
        stems = _mixed(((sums[starts[long] + stem] - sums[starts[long]]) * back[long]) ^ MIX) & MASK
        key, count = np.unique(np.concatenate([words | text, stems | text[long]]), return_counts=True)
        keys.append(key)
        counts.append(count)
    key, count = np.concatenate(keys or [np.empty(0, np.uint64)]), np.concatenate(counts or [np.empty(0, np.int64)])
    if len(keys) > 1:  # a text in pieces
        key, at = np.unique(key, return_inverse=True)
        count = np.bincount(at, count, len(key)).astype(np.int64)
    return (key >> BITS).astype(np.int64), key & MASK, count


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes (48 bits) of each text's runs of k words; of fewer words, but not none, the whole is one shingle."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):  # texts together, as long as they are short
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < 1 << 20) and end - at < 1 << 15:
            size += len(texts[end])
            end += 1
        out += _sets(texts[at:end], k)
        at = end
    return out


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    words, counts = word_hashes(texts)
    stops = np.cumsum(counts)
    firsts = stops - counts
    n_shingles = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), n_shingles)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + firsts[doc]
    value = np.zeros(len(doc), np.uint64)
    for j in range(k):
        inside = start + j < stops[doc]
        value = (value + np.where(inside, words[np.minimum(start + j, max(len(words) - 1, 0))] if len(words) else 0, np.uint64(0))) * MIX + np.uint64(j + 1)
    keys = np.unique((_mixed(value) & MASK) | (doc.astype(np.uint64) << BITS))
    return np.split(keys & MASK, np.searchsorted(keys, np.arange(1, len(texts)).astype(np.uint64) << BITS))


def minima(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Row by set: the least 32-bit values of its members under t hash functions; sets must not be empty."""
    ends = np.cumsum([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    first = ends - [len(s) for s in sets]
    out = np.empty((len(sets), t), np.uint32)
    seeds = np.random.default_rng(11).integers(1, 1 << 63, (t, 2), dtype=np.uint64)
    for j in range(t):
        x = (flat ^ seeds[j, 0]) * (seeds[j, 1] | np.uint64(1))
        x = (x ^ (x >> np.uint64(29))) * MIX >> np.uint64(32)
        out[:, j] = np.minimum.reduceat(x, first) if len(sets) else 0
    return out
