import random

from llm_data import documents, sentence

import corpus_pipeline
from monthtide import shared
from monthtide.llm import registry, sql

SF_DIR = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources",
    ]
    assert {name.split("_")[0] for name in registry.registered()} == {f"op{n}" for n in range(1, 14)}
    assert set(sql.sql()) <= set(registry.registered())


def test_every_decision_takes_effect(spark):
    rng = random.Random(6)
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first().text
    base = sentence(rng, 60)
    clean = [(i, f"{sentence(rng, 40)} the and of", "en", f"s{i % 3}") for i in range(10, 30)]
    rows = clean + [
        (1, base, "en", "s0"), (2, base.upper(), "en", "s0"), (3, base + " end", "en", "s1"),
        (4, f"{sentence(rng, 30)}\n{bench}\n{sentence(rng, 5)}", "en", "s2"), (5, "12 34", "en", "s0"), (6, None, "en", None),
    ]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_DIR)
        if name != "mixing sources":
            assert docs.columns == before.columns
    ids = {r.doc_id for r in docs.collect()}
    # each source takes half as much again at most, so a few documents may be left undrawn
    assert ids <= {1, *range(10, 30)} and len(ids) > 15
    kept = corpus_pipeline.decontamination(spark, before, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == {1, *range(10, 30)}


def test_run_and_empty_documents(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100
    docs = documents(spark, [(1, "a")]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_nulls_ties_repeats_clashing_names_and_long_texts(spark):
    rng = random.Random(8)
    long = sentence(rng, 60_000)
    rows = [(i, f"{sentence(rng, 40)} the and of", "en", "s0") for i in range(10, 40)]
    rows += [
        (1, long, "en", None), (2, long + " tail", "en", "s0"), (None, sentence(rng, 50), "en", "s1"),
        (3, sentence(rng, 45), None, None), (3, sentence(rng, 45), None, "s1"), (4, "Same words", "en", "s1"),
        (4, "Same words", "en", "s1"), (5, "same WORDS", "en", "s1"), (6, None, None, None), (7, "", "en", "s0"),
        (8, " \n", "en", "s0"), (None, None, None, None),
    ]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    assert docs.columns == documents(spark, rows).columns
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(left, key=str) == sorted(
        [(i, t) for i, t, _, _ in rows if i is None and t or i in (1, 3) or i and i >= 10] + [(4, "Same words")], key=str
    )
    mixed = corpus_pipeline.mixing(spark, docs, SF_DIR)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= set(left)


def test_a_run_leaves_its_stages_results_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda *_: str(tmp_path))
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100
    assert len(list((tmp_path / "monthtide").iterdir())) == len(corpus_pipeline.STAGES)
