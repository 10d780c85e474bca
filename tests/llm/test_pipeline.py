"""The pipeline's stages, each judged on its own input, against brute force."""

import os
import random
import sys

import corpus_pipeline
from reelrec.llm import langid

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from brute import docs_of  # noqa: E402, F401


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{brute.SF_SMALL}/documents.parquet")
    seen = [[tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]]
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(scratch, name)
        stage(spark, docs, brute.SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append([tuple(r) for r in docs.collect()])
        if name != "mixing":
            assert docs.columns == corpus_pipeline.COLUMNS
    start, languages, near, cut, clean, mixed = seen
    assert set(languages) <= set(start) and len(languages) >= 0.97 * len(start)
    groups = brute.components([r[:2] for r in languages])
    assert sorted(near) == sorted(r for r, (i, _, c) in zip(languages, groups) if i == c)
    places = brute.repeated([r[:2] for r in near])
    assert {r[0] for r in near if not places[r[0]]} >= {r[0] for r in near} - {r[0] for r in cut} - {i for i, p in places.items() if p}
    assert not any(brute.repeated([r[:2] for r in cut], 60).values())
    clean_before = {r for r in near if not brute.repeated([x[:2] for x in near], 12)[r[0]]}
    assert clean_before <= set(cut)
    items = [tuple(r) for r in spark.read.parquet(f"{brute.SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination([r[:2] for r in cut], items) if r[5]}
    assert sorted(clean) == sorted(r for r in cut if r[0] not in bad)
    sources = {}
    for doc_id, source, size, source_size, target, taken in mixed:
        t = sources.setdefault(source, [0, target])
        t[0] += taken
        assert 0 < taken <= 2 * size
    assert all(abs(a - b) <= 0.5 for a, b in sources.values())


def test_run_equals_the_stages(spark, scratch):
    docs = spark.read.parquet(f"{brute.SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(scratch, f"run-{name}")
        stage(spark, docs, brute.SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    first = sorted(map(str, docs.collect()))
    assert first and first == sorted(map(str, corpus_pipeline.run(spark, brute.SF_SMALL).collect()))


def test_stages_on_an_empty_table_and_odd_rows(spark, docs_of, scratch):
    rows = [(1, None, "en", "a"), (2, "", None, None), (None, "some words here", "en", "b"), (3, "the same text of words", "en", "a"),
            (4, "the same text of words", "en", "a"), (4, "the same text of words", "en", "a"), (5, "others über", "de", None)]
    # only one language has a clear document in the first stage; of 3 and 4, copies, the smaller id stays
    for k, docs in enumerate((docs_of(rows).limit(0), docs_of(rows))):
        for name, stage in corpus_pipeline.STAGES:
            path = os.path.join(scratch, f"{k}-{name}")
            stage(spark, docs.withColumn("size", docs["doc_id"]) if name != "mixing" else docs, brute.SF_SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
        assert {r["doc_id"] for r in docs.collect()} <= (set() if k == 0 else {None, 3, 5})


def test_rows_of_one_id_are_documents_of_their_own(spark, docs_of):
    r = random.Random(7)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    a, b, c = text(120), text(300), text(80)
    rows = [(1, a, "en", "x"), (5, a, "en", "x"), (5, b, "en", "x"), (8, b + " end", "en", "y"), (9, c, "en", "y"), (9, c, "en", "y"), (None, a, "en", "y")]
    docs = docs_of(rows)
    near = corpus_pipeline.near_duplicates(spark, docs, brute.SF_SMALL)
    assert near.columns == corpus_pipeline.COLUMNS
    got = sorted(((r["doc_id"], r["text"]) for r in near.collect()), key=str)
    assert got == sorted([(1, a), (5, b), (9, c), (9, c), (None, a)], key=str)
    half = " ".join(b.split(" ")[:60])
    cut = corpus_pipeline.repeated_passages(spark, docs_of([(1, half + " " + c, "en", "x"), (5, half + " tail", "en", "x"), (5, text(300), "en", "x")]), brute.SF_SMALL)
    sizes = sorted((r["doc_id"], len(r["text"].split())) for r in cut.collect())
    assert sizes == [(1, 140), (5, 1), (5, 300)]
