import random
import re

import pytest

from seqsluice.llm import jaccard_join, shingles
from seqsluice.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingled(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingled(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = dict.fromkeys(up, 0)
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-12:
                links[i] += 1
                links[j] += 1
                r, s = sorted((root(i), root(j)))
                up[s] = r
    return {i: (root(i), links[i]) for i in up}


def corpus(rng, groups):
    rows = []
    for size, words, edits in groups:
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(len(rows) + i, f"{passage} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 80)))) for i in range(60)]
    return rows


@pytest.mark.parametrize(("bucket", "block"), [(1000, 256), (12, 16)])
def test_classes_and_links_match_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(jaccard_join, "BUCKET", bucket)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus(random.Random(4), [(90, 200, 6), (40, 60, 2), (7, 30, 1), (2, 400, 8), (30, 8, 0), (5, 3, 0), (1, 12, 0)])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    got = jaccard_join.join(odd_docs)
    assert got.columns == [*odd_docs.columns, *jaccard_join.RESULTS]
    rows = {(r.doc_id, (r.text or "")[:5]): (r.class_id, r.n_links) for r in got.collect()}
    assert rows[3, "w0 w1"] == (3, 2) and rows[4, "w0 w1"] == (3, 2)
    assert rows[None, ""] == (None, 0) and rows[1, ""] == (1, 0) and rows[2, " \n\t "] == (2, 0) and rows[5, "one t"] == (5, 0)
    assert got.count() == odd_docs.count()
    assert jaccard_join.join(no_docs).count() == 0


def test_shingle_sets_are_those_of_the_words():
    texts = ["", "a", "a b c d", "A b! c d e", "a b c d e f", "ünï b c d e f g " * 50]
    sets = shingles.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingled(t)) for t in texts]
    assert set(sets[3].tolist()) <= set(sets[4].tolist())


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(90)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        r, s = sorted((root(a), root(b)))
        up[s] = r
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_recall_where_buckets_are_split(spark, monkeypatch):
    """Pages of one template, alike in half of their words, some of them in pairs at about 0.8: no pivot takes them out, every bucket is split over several levels."""
    monkeypatch.setattr(jaccard_join, "BUCKET", 25)
    rng = random.Random(8)
    template = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = [f"u{rng.randrange(10**9)}" for _ in range(75)]
        rows.append((2 * i, " ".join(template + own)))
        rows.append((2 * i + 1, " ".join(template + own[:61] + [f"v{rng.randrange(10**9)}" for _ in range(14)])))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert all(n == 1 for _, n in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
