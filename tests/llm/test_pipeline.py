import random

import corpus_pipeline
from seqsluice.llm import catalog, common, decontaminate
from seqsluice.llm.common import words_of


def world(tmp_path, spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    item = say(30)
    texts = {i: "\n".join(say(25) for _ in range(4)) for i in range(300)}
    for i in range(0, 300, 6):
        texts[i] += " nasty rotten vileness nasty"
    boiler = say(12)
    for i in range(1, 300, 12):
        texts[i] += "\n" + boiler
    texts[301] = texts[2]  # an exact copy: its lines go, and so does it
    own = texts[4].split()
    for k in (50,):  # a near copy, in one line
        own[k] = "replacement"
    texts[302] = " ".join(own)
    texts[303] = say(60) + " " + item + " " + say(60)
    texts[304] = item
    texts[305] = ""
    docs = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in texts.items()] + [(306, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return texts, item, boiler


def test_stages_and_run(spark, tmp_path):
    texts, item, boiler = world(tmp_path, spark)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in docs.collect())
    toxic = set(range(0, 300, 6))
    assert set(texts) | {306} - toxic >= set(kept["toxicity"]) and not toxic & set(kept["toxicity"]) and len(kept["toxicity"]) == len(texts) + 1 - len(toxic)
    assert set(kept["toxicity"]) - set(kept["line_dedup"]) == {301}
    assert sum(boiler in (t or "") for t in kept["line_dedup"].values()) == 1
    assert set(kept["line_dedup"]) - set(kept["jaccard_join"]) == {302}
    assert set(kept["jaccard_join"]) - set(kept["decontamination"]) == {304}
    assert item not in kept["decontamination"][303] and len(words_of(kept["decontamination"][303].encode())) == 120
    assert {305, 306} <= set(kept["decontamination"])
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(kept["decontamination"]) and all(r.taken == r.copies * r["size"] for r in rows)


def test_one_of_every_class_stays(spark):
    """Classes whose least ids are equal, null ids, rows equal in id and text, extra columns with an operator's names."""
    rng = random.Random(2)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(4))
    rows = [(7, a), (8, a), (7, b), (9, b), (None, c), (None, c), (None, d), (3, d), (7, None), (7, None), (5, "alone")]
    docs = spark.createDataFrame([(i, t, k, "x", "y") for k, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long, root string, best string")
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(t for t in (r.text for r in got.collect()) if t) == sorted([a, b, c, d, "alone"])
    assert got.where("text IS NULL").count() == 2
    assert {(r.doc_id, r.text) for r in got.collect()} >= {(7, a), (7, b), (None, c), (None, d)}


def test_decontamination_takes_long_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """2,000 texts of 20 KB in one task: Python gets no batch beyond the bound and a row, and each text once."""
    item = " ".join(f"i{k}" for k in range(12))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", f"concat(repeat('Ab, ', 5000), IF(id % 500 = 0, '{item}', 'z')) AS text", "'s' AS source", "20001L AS n_chars")
    sizes, real = str(tmp_path / "sizes"), decontaminate._report

    def spied(*args):
        inner = real(*args)

        def run(batches):
            def seen():
                for b in batches:
                    with open(sizes, "a") as f:
                        f.write(f"{b.nbytes}\n")
                    yield b

            yield from inner(seen())

        return run

    monkeypatch.setattr(decontaminate, "_report", spied)
    before = spark.conf.get(common.BATCH)
    spark.conf.unset(common.BATCH)
    try:
        got = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path)).collect()
    finally:
        spark.conf.set(common.BATCH, before)
    assert len(got) == 2000 and all(r.text == "Ab, " * 5000 + ("" if r.doc_id % 500 == 0 else "z") for r in got)
    seen = [int(x) for x in open(sizes)]
    assert max(seen) < common.BATCH_BYTES + 100_000 and sum(seen) < 1.2 * 2000 * 20_001


def test_catalog():
    assert len([q for q in catalog.queries() if q.startswith("op")]) == 10 and "pipeline" in catalog.queries()
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
