"""Odd rows, empty tables and brute force for the operators without a file of their own."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seqsluice.llm.common import WORD_BYTES
from seqsluice.llm import decontaminate, jaccard_join, language, line_dedup, mixing, shingles, substring_dedup, token_counts, topk, toxicity, url_filter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans(url_filter.UPPER, url_filter.LOWER)


def words(text):
    return WORD.findall((text or "").translate(UPPER))


# --- 2 ----


def test_token_counts(spark, odd_docs, no_docs, monkeypatch):
    import base64

    import public_tokenizers as p
    import tiktoken

    monkeypatch.setattr(token_counts, "BLOCK_TOKENS", 64)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(token_counts.VOCABULARY, "rb"))}
    own = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = odd_docs.collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(own.encode_ordinary(r.text or ""))) for r in rows)
    got = token_counts.count_tokens(odd_docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(no_docs).count() == 0


def test_scan_of_foreign_files(spark, tmp_path, monkeypatch):
    """Documents over many blocks, empty ones, a rest without an end, an empty file."""
    monkeypatch.setattr(token_counts, "BLOCK_TOKENS", 7)
    rng = random.Random(3)
    want, sizes = {}, []
    for f in range(4):
        docs = [[rng.randrange(5) for _ in range(rng.choice((0, 1, 6, 7, 8, 40)))] for _ in range(12)]
        flat = [x for d in docs for x in [*d, 9]] + ([1, 2, 3] if f % 2 else [])
        data = np.array([] if f == 2 else flat, "<u4").tobytes()
        (tmp_path / f"{f}.u32").write_bytes(data)
        sizes.append((str(tmp_path / f"{f}.u32"), len(data)))
        at = 0
        for i, d in enumerate([] if f == 2 else docs + ([[1, 2, 3]] if f % 2 else [])):
            want[sizes[-1][0], i] = (at, len(d))
            at += len(d) + 1
    got = token_counts.scan(spark, spark.createDataFrame(sizes, "shard string, bytes long"), eod=9, width="<u4").collect()
    assert {(r.shard, r.ordinal): (r.first_token, r.n_tokens) for r in got} == want


# --- 3 ----


def windows(items, n=10):
    out = {}
    for i, text in items:
        w = words(text)
        m = min(n, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            out.setdefault(tuple(w[k : k + m]), set()).add("" if i is None else str(i))
    return out


def brute(text, table):
    w, hit, found = words(text), set(), set()
    for m in {len(k) for k in table}:
        for k in range(len(w) - m + 1):
            if own := table.get(tuple(w[k : k + m])):
                found |= own
                hit |= set(range(k, k + m))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [128 << 20, 6000])
@pytest.mark.parametrize("short", [False, True])
def test_decontaminate(spark, block, short):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, say(rng.randrange(10, 25))) for i in range(12)] + [(50, None), (51, "..."), (52, "W1, w2!")][: 3 if short else 2] + [(None, say(11))]
    docs = []
    for i in range(60):
        planted = rng.choice([t for _, t in items if t])
        docs.append((i, say(rng.randrange(60)) + (" - " + planted.upper() + "; é " if i % 2 else " ") + say(rng.randrange(30))))
    docs += [(90, None), (91, ""), (92, "w1 w2")]
    table = windows(items)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(df, bench, block_bytes=block).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == {i: brute(t, table) for i, t in docs}
    for r in got:
        assert len(words(r.cleaned)) == r.n_words - r.n_hit and (r.text is None) == (r.cleaned is None)
        assert r.over_limit == (r.n_hit > 0 and r.n_hit * 2 >= r.n_words)


def test_decontaminate_odd(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    got = decontaminate.decontaminate(odd_docs, bench)
    assert got.count() == odd_docs.count() and got.where("contaminated").count() == 1
    assert decontaminate.decontaminate(odd_docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(no_docs, bench).count() == 0


# --- 5 ----


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark):
    rng = random.Random(6)
    say = lambda n: "".join(rng.choices("abcdeé fghi", k=n)).strip() + "x"
    base = [say(rng.randrange(18, 60)) for _ in range(12)]
    docs = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            if rng.random() < 0.2:
                lines.append(rng.choice(["}", "", "share", "menu", "a 日本語の行", "日本語の文です。"]))
            line = list(rng.choice(base) if rng.random() < 0.7 else say(30))
            for _ in range(rng.choice((0, 0, 1, 2, 3))):
                at = rng.randrange(len(line))
                line[at : at + rng.randrange(2)] = rng.choice(["", "q", "zé"])[: rng.randrange(2)]
            lines.append("".join(line))
        docs.append((i, "\n".join(lines)))
    first = {}
    for i, t in docs:
        for k, line in enumerate(t.split("\n")):
            first.setdefault(line.strip(" "), (i, k))
    keep = [x for x in first if len(x) >= 20]
    near = {b for b in keep for a in keep if first[a] < first[b] and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2}
    want = {i: [k for k, x in enumerate(y.strip(" ") for y in t.split("\n")) if len(x) >= 5 and (x in near or first[x] != (i, k))] for i, t in docs}
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.removed for r in got} == want and near
    for r in got:
        assert r.kept == "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in r.removed)


@pytest.mark.parametrize("most", [1, 2, 4])
def test_bit_parallel_distance(spark, most):
    rng = random.Random(most)
    pairs = []
    for _ in range(600):
        a = rng.choices("abcé日", k=rng.randrange(0, 75))
        b = list(a)
        for _ in range(rng.randrange(most + 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "x"])
        pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.filter(F.split("a", ""), lambda c: c != "").alias("x"), F.filter(F.split("b", ""), lambda c: c != "").alias("y"))
    got = df.select("a", "b", line_dedup._close(F.col("x"), F.col("y"), most).alias("near")).collect()
    assert all(r.near == (distance(r.a, r.b) <= most) for r in got) and 0 < sum(r.near for r in got) < len(got)


def test_line_dedup_odd(spark, odd_docs, no_docs):
    rows = {(r.doc_id, (r.text or "")[:5]): r for r in line_dedup.dedup_lines(odd_docs).collect()}
    assert rows[None, ""].n_lines == 0 and rows[None, ""].kept is None and rows[1, ""].n_lines == 1
    assert rows[3, "w0 w1"].n_removed == 0 and rows[4, "w0 w1"].n_removed == 1
    assert line_dedup.report(no_docs).count() == 0


# --- 6 ----


def test_targets_and_taken(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(["w"] * rng.choice((0, 1, 5, 30, 200))), rng.choice([None, "a", "b", "b", "b", "c", "é"])) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 2 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-4 and r.source_size == sizes[r.source] and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 200 for s in order)
    rates = {s: {r["size"]: r.rate for r in got if r.source == s} for s in order}
    for s in order:
        own = np.array([len(t.split()) for _, t, x in docs if x == s])
        if target[s] >= 2 * sizes[s] - 1e-9:
            assert set(rates[s].values()) == {2.0}
            continue
        # the dual's root by halving, and the rates that it gives
        mean, low, high = own[own > 0].mean(), -50.0, 50.0
        for _ in range(200):
            x = (low + high) / 2
            gradient = (own * np.minimum(2, np.exp(np.minimum(x * own / mean, 5)))).sum() - target[s]
            low, high = (x, high) if gradient < 0 else (low, x)
        assert abs(gradient) < 1e-6 * target[s]
        assert all(abs(rate - min(2, np.exp(x * n / mean))) < 1e-5 for n, rate in rates[s].items())
    again = mixing.mix(spark.createDataFrame(docs[::-1], "doc_id long, text string, source string"))
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_slices_of_a_hot_size(spark, monkeypatch):
    """A third of all rows have one source and size: slices of the hash settle which are taken, the least first, as the SQL does."""
    monkeypatch.setattr(mixing, "TOGETHER", 16)
    rng = random.Random(9)
    docs = [(i, "w " * (7 if i % 3 else rng.randrange(1, 90)), "b" if i % 3 else rng.choice("abc")) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(df).collect()}
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert got == {r[0]: r[1:] for r in con.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.oracle()})").fetchall()}


def test_names_of_an_operators_own(spark):
    """Extra columns may have any name that an operator uses inside."""
    names = ["_d", "_t", "row", "data", "spans", "near", "removed", "slice_size", "_hash", "_slice", "o", "s", "z", "base", "line", "_n", "_data", "_spans", "_items", "root", "best", "n"]
    rows = [(i, "one two three four five six seven eight nine ten eleven " * 3 + "\nline %d" % (i % 3), "a", "b", *range(len(names))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names))
    bench = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    for out in (substring_dedup.dedup(docs), decontaminate.decontaminate(docs, bench), jaccard_join.join(docs), line_dedup.dedup_lines(docs), mixing.mix(docs)):
        got = out.collect()
        assert len(got) == 4 and all(r[n] == k for r in got for k, n in enumerate(names) if n not in ("removed",))


def test_mix_odd(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs)
    assert got.count() == odd_docs.count() and mixing.mix(no_docs).count() == 0
    assert {r["size"] for r in got.where("text IS NULL OR text = ''").collect()} == {0}
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0.0, 0), (0.0, 0)]


# --- 7 ----


def test_terms_are_words_and_their_beginnings():
    texts = [b"", b"Stupid stupids, x!", "é stupid STUPIDE x x".encode() * 3, b" " * 9, b"longer " * 60_000 + b"tail", b"a" * 1_200_000 + b" b"]
    text, term, n = shingles.term_counts(texts, 5)
    for k, data in enumerate(texts):
        words = data.translate(WORD_BYTES).split()
        want = Counter(words + [w[:5] + b"*" for w in words if len(w) > 5])
        assert sorted(n[text == k]) == sorted(want.values()) and len(set(term[text == k])) == len(want)
    own = {k: set(term[text == k]) for k in range(len(texts))}
    assert len(own[1] & own[2]) == 3  # x, stupid, stupi*
    assert sum(map(len, shingles.pieces(texts))) > 2 and b"".join(t for _, g in shingles.pieces(texts) for t in g) == b"".join(texts)


def test_nearest_is_exact():
    rng = np.random.default_rng(4)
    index = toxicity.Index(np.arange(30, dtype=np.uint64), rng.uniform(1, 4, 30), np.arange(500), rng.integers(0, 2, 500), 9, size=16)
    example = np.repeat(np.arange(500), rng.integers(0, 12, 500))
    pairs, tf = np.unique(example * 30 + rng.integers(0, 30, len(example)), return_counts=True)
    example, term = pairs // 30, pairs % 30
    w = toxicity.weighted(example, index.idf[term] * (1 + np.log(tf)), 500)
    dense = np.zeros((500, 30))
    dense[example, term] = w
    index.build(example, term, w)
    vectors = [(term[example == i], w[example == i]) for i in range(500)]
    skip = np.arange(500)[::-1].copy()
    for own, found in ((None, index.neighbours(vectors)), (skip, index.neighbours(vectors, skip))):
        for q, (score, rows) in enumerate(found):
            full = dense @ dense[q]
            if own is not None:
                full[own[q]] = 0
            want = np.sort(full[full > 1e-12])[::-1][:9]
            assert np.allclose(score, want) and np.allclose(full[rows], score)
    assert index.opened < index.met


def test_scores_are_those_of_all_cosines(spark):
    """The whole query against dense cosines of all examples; ids of documents and their order are of no account."""
    rng = random.Random(3)
    bad, plain = ["nasty", "vileness", "rotten"], [f"w{i}" for i in range(60)]
    learning = [r.id for r in spark.range(2000).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0).collect()]
    texts = [" ".join(rng.choices(plain, k=rng.randrange(1, 30)) + rng.choices(bad, k=rng.randrange(3)) * (i % 4 == 0)) for i in range(700)]
    texts += texts[:20]  # equal cosines
    toxic = [int(i % 4 == 0) for i in range(720)]

    def rated(ids):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        lab = spark.createDataFrame(list(zip(ids, toxic)), "doc_id long, toxic int")
        model = toxicity.learn(df, lab)
        return model, model.index(), {r.doc_id: r.score for r in toxicity.rate(df, lab).collect()}

    ids = learning[:720]
    model, index, got = rated(ids)
    dense = np.zeros((len(index.ids), len(index.terms)))
    for t in range(len(index.terms)):
        own = slice(index.starts[t], index.starts[t + 1])
        dense[index.rows[own], t] = index.weights[own]
    for i, text in zip(ids, texts):
        t, w = index.vectors([text.encode()])[0]
        cos = np.round(dense[:, t] @ w, 9)
        best = [r for r in np.lexsort((np.arange(len(cos)), -cos)) if cos[r] > 0][: index.k]
        vote = np.average(index.labels[best], weights=1 / (1.05 - cos[best]))
        assert abs(got[i] - 1 / (1 + np.exp(-(model.slope * vote + model.offset)))) < 1e-6
    assert len(set(got.values())) > 20
    other = ids[::-1]
    _, _, again = rated(other)
    assert all(abs(got[a] - again[b]) < 1e-9 for a, b in zip(ids, other))


def test_toxicity(spark, odd_docs, no_docs):
    rng = random.Random(7)
    bad, plain = ["nasty", "vileness", "rotten"], [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(600):
        toxic = int(i % 5 == 1)
        own = rng.choices(plain, k=40) + (rng.choices(bad, k=3) if toxic else [])
        rng.shuffle(own)
        docs.append((i, " ".join(own).capitalize()))
        if i % 10 < 7:
            labels.append((i, 1, toxic))
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.rate(df, lab).collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert sum(r.predicted == int(r.doc_id % 5 == 1) for r in got) == 600
    flipped = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(got) == sorted(toxicity.rate(df, flipped).collect())  # held-out labels are of no account
    index = toxicity.learn(df, lab)
    assert toxicity.score(odd_docs, index).count() == odd_docs.count()
    assert toxicity.rate(no_docs, lab).count() == 0 and toxicity.rate(odd_docs, lab.limit(0)).count() == odd_docs.count()


def test_rare_toxic_wording(spark):
    """A family of toxic wording in five examples, of 1 % of them; and toxic examples beyond the first by hash."""
    rng = random.Random(11)
    plain, rare = [f"w{i}" for i in range(400)], [f"r{i}" for i in range(12)]
    bad = ["nasty", "vileness", "rotten"]
    docs, labels, family = [], [], []
    for i in range(1500):
        own = rng.choices(plain, k=30) + (rng.choices(bad, k=4) if i % 3 == 0 else [])
        docs.append((i, " ".join(own)))
        labels.append((i, int(i % 3 == 0)))
    learning = {r.id for r in spark.range(1500, 1600).where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0).collect()}
    for i in sorted(learning)[:5] + sorted(set(range(1500, 1600)) - learning)[:5]:
        family.append(i)
        docs.append((i, " ".join(rng.sample(rare, k=9))))
        labels.append((i, 1))
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.rate(df, lab).collect()}
    assert all(got[i].predicted == 1 and set(got[i].evidence) <= set(family) for i in family)
    few = lab.where((F.col("doc_id") % 60 == 0) | (F.col("toxic") == 0))
    known = few.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    assert toxicity.learn(df, few, examples=100).index().labels.sum() == known.where("toxic = 1").count()


# --- 8 ----


def test_urls(spark):
    urls = ["http://A.Example.com/en/1", "https://www.example.com/en/x?y", "http://x.net/es/", "http://x.net:80/es/", "http://y.org", "nothing", None, "", "a://b://c/d", "http://user@n.net/fr/#z", "http://com/", "http://com", "http://notexample.com/en/", "http://x.net?/es/"]
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert len(rows) == len(urls) and all(r.verdict in ("allow", "block") for r in rows)
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/") and got[1] == ("www.example.com", "/en/x", "www.example.com/en/") and got[2][2] == "net/es/"
    assert got[3] == ("x.net:80", "/es/", None) and got[5] == ("", "", None) and got[6] == ("", "", None) and got[8] == ("b:", "//c/d", None)
    assert got[9] == ("user@n.net", "/fr/", "net/fr/") and got[10][2] == "com/" and got[11] == ("com", "", None) and got[12][2] == "com/" and got[13] == ("x.net", "", None)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_reputation(spark):
    """Hosts with blocked pages are blocked where no rule falls; the rest are allowed."""
    urls = [f"http://bad.net/es/{i}" for i in range(30)] + ["http://bad.net/other"] + [f"http://good.com/{i}" for i in range(60)] + ["http://fresh.org/x"]
    rows = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert rows[30] == "block" and rows[len(urls) - 1] == "allow"


def test_reputations_of_hosts(spark):
    """Ports and users don't split a host, repeated pages count, suffixes may come as a table, addresses are their own domain; as the SQL has it."""
    rng = random.Random(6)
    names = ["bad.net", "bad.net:80", "u:p@bad.net", "a.shop.co.uk", "b.shop.co.uk:8080", "other.co.uk", "10.0.0.1", "10.0.0.1:81", "[::1]:80", "x.github.io", "fresh.org", "", "www.example.com", "en.example.com"]
    urls = [(rng.randrange(200), f"http://{rng.choice(names)}/{rng.choice(['es/', 'fr/', 'en/', ''])}{rng.randrange(9)}") for _ in range(600)] + [(7, None), (7, None), (None, "http://bad.net/q")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = url_filter.judge(pages)
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({url_filter.oracle()})").fetchall()
    key = lambda r: tuple(map(str, r))
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)
    assert len({r[5] for r in rows if "bad.net" in r[1]}) == 1 and len(rows) == len(urls)
    table = spark.createDataFrame([(x,) for x in url_filter.TWO_LABEL_SUFFIXES] + [(None,)], "suffix string")
    assert sorted((tuple(r) for r in url_filter.judge(pages, suffixes=table).collect()), key=key) == sorted(rows, key=key)


# --- 9 ----


def test_decoding_and_features_by_hand():
    """Counts of n-grams one by one; the nearest codeword by a loop over languages and bits."""
    texts = ["Ähm, the 2 cats.", "", "x", "zz top zz"]
    got = language.ngram_counts([t.lower().encode() for t in texts], 64)
    for row, text in zip(got, texts):
        data = b"  " + bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()) + b" "
        want = np.zeros(64)
        for end in range(2, len(data)):
            for n in (1, 2, 3):
                gram = sum(data[end - j] << 8 * j for j in range(n)) + (n << 24)
                want[(gram * 2654435761 & 0xFFFFFFFF) >> 26] += 1
        assert (row == want).all()
    rng = np.random.default_rng(5)
    for langs in (2, 4, 9):
        code = language.codewords(langs, 31)
        assert len(np.unique(code, axis=0)) == langs
        bits = code.shape[1]
        trust = rng.uniform(0.1, 1, bits)
        model = language.Model([f"l{i}" for i in range(langs)], code, rng.normal(size=(16, bits)), rng.normal(size=bits), trust / trust.sum(), 0.2)
        x = rng.normal(size=(20, 16))
        best, share, vague = model.decode(x)
        for i in range(20):
            f = [max(-3, min(3, float(x[i] @ model.weights[:, b] + model.bias[b]))) for b in range(bits)]
            loss = [sum(model.trust[b] * np.exp(-f[b] * code[k, b]) for b in range(bits)) for k in range(langs)]
            p = np.exp(-4 * (np.array(loss) - min(loss)))
            p = np.sort(p / p.sum())
            assert best[i] == int(np.argmin(loss)) and abs(share[i] - p[-1]) < 1e-5 and vague[i] == (p[-1] - p[-2] < 0.2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_language(spark, odd_docs, no_docs):
    rng = random.Random(9)
    stems = {"en": ["the", "ing", "and", "tion"], "de": ["ein", "sch", "ung", "ß"], "fr": ["eau", "é", "les", "que"], "qq": ["zx", "kj", "vv"]}
    docs = [(i, " ".join("".join(rng.choices(stems[lang], k=2)) for _ in range(30)), lang if i % 7 else None) for i in range(400) for lang in [list(stems)[i % 4]]]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == list(stems)[i % 4] and 0 <= got[i].score <= 1 for i in range(400))
    odd = language.identify(odd_docs).collect()
    assert len(odd) == 10 and {r.lang_pred for r in odd if r.doc_id in (1, 2)} == {"und"}
    assert language.identify(no_docs).count() == 0
    assert {r.lang_pred for r in language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_all_languages(spark):
    """More than 100 languages, of which the last 20 are rarer; fitted by either matrix alike."""
    rng = random.Random(12)
    words = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(4)] for k in range(120)}
    names = [n for k, n in enumerate(words) for _ in range(9 if k < 100 else 5)]
    docs = [(i, " ".join(rng.choices(words[n], k=25)), n) for i, n in enumerate(names)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert language.learn(df).langs == sorted(words)
    got = {r.doc_id: r.lang_pred for r in language.identify(df).collect()}
    rare = [(got[i], n) for i, n in enumerate(names) if n >= "l100"]
    assert sum(a == b for a, b in rare) >= 0.9 * len(rare)
    x, y = language.features([t.encode() for _, t, _ in docs[:300]], 256), np.array([int(n[1:]) for n in names[:300]])
    assert np.allclose(language.fit(x, y, list(words)[:34]).weights, language.fit(np.pad(x, ((0, 0), (0, 256))), y, list(words)[:34]).weights[:256], atol=1e-4)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language.codewords(n, 31)
    assert len({tuple(c) for c in code.tolist()}) == n


# --- 10 ----


def test_topk(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, (rng.normal(size=20) * (1 + i % 3)).tolist()) for i in range(700)]
    vectors += [(700 + i, vectors[3][1]) for i in range(40)] + [(800, None), (801, [1.0, None]), (802, [float("nan")] * 20), (803, [float("inf")] * 20), (None, [1.0] * 20), (850, [1.0, 2.0]), (851, [3.0, 4.0]), (900, []), (901, []), (950, [3e6, 3e6]), (951, [3e6, 6e6])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(5)
    got = [tuple(r) for r in topk.top_k(df, query_block=6).orderBy("query_id", "rank").collect()]
    live = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in live if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(live[q], v)), i) for i, v in live.items() if i != q and len(v) == len(live[q]))[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == want
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("query_block", [1, 4096])
def test_topk_of_repeated_ids(spark, query_block):
    """Ids repeated more than k times, with one vector and with several, as candidates and as queries: as the SQL has it."""
    import duckdb

    from seqsluice.llm import catalog

    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-9, 10, 6).astype(float).tolist()) for i in range(160)]
    rows += [(7, [40.0] * 6)] * 9 + [(100, rows[100][1])] + [(50, rng.integers(-9, 10, 6).astype(float).tolist()) for _ in range(3)]
    rows += [(9, rng.integers(-9, 10, 6).astype(float).tolist()) for _ in range(8)] + [(150, [90.0] * 6)] * 8
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    embeddings = df.toArrow()  # noqa: F841
    want = duckdb.sql(f"SELECT * FROM ({catalog.oracle_sql()['op10_exact_topk']})").fetchall()
    for n in (1, 3, 7):
        assert sorted(tuple(r) for r in topk.top_k(df.repartition(n), query_block=query_block).collect()) == sorted(want)
