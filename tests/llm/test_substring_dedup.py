import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from seqsluice.llm import substring_dedup as sd


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + sd.LENGTH] for d in data for i in range(len(d) - sd.LENGTH + 1))
    out = []
    for d in data:
        mask = bytearray(len(d) + 1)
        for i in range(len(d) - sd.LENGTH + 1):
            if seen[d[i : i + sd.LENGTH]] > 1:
                mask[i : i + sd.LENGTH] = b"\1" * sd.LENGTH
        kept = bytes(b for b, m in zip(d, mask) if not m)
        runs = sum(1 for i in range(len(d)) if mask[i] and not (i and mask[i - 1]))
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def noise(rng, n):
    return "".join(rng.choices("abcdefgh ijklmnoé\n", k=n))


def corpus(rng):
    shared = [noise(rng, n) for n in (199, 200, 201, 230, 260, 330, 500, 2000)]
    texts = [noise(rng, rng.randrange(1500)) for _ in range(40)]
    for _ in range(120):
        p = rng.choice(shared)
        lo = rng.randrange(max(1, len(p) - 150))
        hi = rng.randrange(lo, len(p)) + 1
        texts.append(noise(rng, rng.randrange(200)) + p[lo:hi] + noise(rng, rng.randrange(200)) + rng.choice(["", rng.choice(shared)]))
    texts += [texts[3], texts[3], "", None, "a" * 199, "b" * 201, "ab" * 300, "z" * 1000, "xyz" * 90, noise(rng, 300) * 3]
    near = noise(rng, 1200)
    for _ in range(80):
        at = rng.randrange(1200)
        texts.append(near[:at] + rng.choice("QRSTUV") + near[at:])
    return texts


@pytest.mark.parametrize(("parts", "together"), [(4, 20_000), (60, 20_000), (60, 5)])
def test_matches_brute_force(spark, monkeypatch, parts, together):
    monkeypatch.setattr(sd, "TOGETHER", together)
    texts = corpus(random.Random(8))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = sd.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    want = brute(texts)
    assert {i: (got[i], want[i]) for i in got if got[i] != want[i]} == {}
    assert len(got) == len(texts)


def test_odd_rows(spark, odd_docs, no_docs):
    got = sd.dedup(odd_docs)
    assert got.columns == [*odd_docs.columns, *sd.RESULTS]
    rows = [(r.doc_id, r.n_bytes, r.n_removed) for r in got.collect()]
    assert len(rows) == 10
    long = [r for r in rows if r[1] > 1000]
    assert len(long) == 3 and all(r[1] == r[2] for r in long)
    assert sd.dedup(no_docs).count() == 0


def test_multikey_sort():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, (500, 6)).astype(">u8")
    order = sd.multikey_sort(words)
    assert [words[i].tolist() for i in order] == sorted(w.tolist() for w in words)
    assert len(sd.multikey_sort(words[:0])) == 0
