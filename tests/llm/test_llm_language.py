import zlib

import numpy as np
from llm_data import documents

from monthtide.llm.frames import table
from monthtide.llm.language_id import (
    Machine,
    Model,
    _grams,
    _margins,
    fit,
    identify,
    keep_identified,
    predicted_languages,
)
import pyarrow as pa

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    got = {r.doc_id: r for r in predicted_languages(docs).collect()}
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(true)
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in true if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == true[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark):
    from pyspark.sql import functions as F

    from monthtide.llm.language_id import held_out

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    wrong = docs.withColumns(
        {"lang": F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")),
         "source": F.lit("other")}
    )
    assert sorted(map(tuple, predicted_languages(docs).collect())) == sorted(
        map(tuple, predicted_languages(wrong).collect())
    )


ROWS = [
    (1, "the quick brown fox and the dog", "en"), (2, "der schnelle braune Fuchs und der Hund", "de"),
    (3, "le renard brun et le chien", "fr"), (4, None, "en"), (6, "123 !!", "de"), (7, "", None),
    (8, "the fox", None), (None, "der Hund", "de"), (9, "the quick brown fox and the dog", "en"),
    (11, "x" * 200_000, "fr"), (12, "ΑΒΓ", None), (13, "voilà", "=odd"),
]


def test_rows_without_letters_labels_or_identifier(spark):
    rows = [(*r, "s") for r in ROWS]
    got = predicted_languages(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got}
    assert {i for i, r in of.items() if r.lang_pred == "und"} == {4, 6, 7}
    assert all(of[i].score == 0 for i in (4, 6, 7))
    assert of[None].held_out and of[1].lang_pred == of[9].lang_pred
    learned = {"en", "de", "fr", "=odd"}
    assert {r.lang_pred for r in got} - {"und"} <= learned


def test_rejected_documents_go(spark):
    docs = documents(spark, [(*r, "s") for r in ROWS])
    got = keep_identified(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {1, 2, 3, 8, None, 9, 11, 12, 13}
    only = keep_identified(docs, languages=["de"]).collect()
    assert 2 in {r.doc_id for r in only} and 3 not in {r.doc_id for r in only}


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some text", None, None), (2, None, "en", None)])
    got = predicted_languages(docs).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert keep_identified(docs).count() == 2
    assert predicted_languages(docs.where("false")).count() == 0
    assert keep_identified(docs.where("false")).count() == 0


def test_one_language(spark):
    docs = documents(spark, [(i, f"text {i}", "en", None) for i in range(20)] + [(50, "7", "en", None)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in predicted_languages(docs).collect()}
    assert got[3] == ("en", 1.0) and got[50] == ("und", 0.0)


def test_sample_is_bounded_and_repeatable(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    one, two = fit(docs, per_language=10), fit(docs.repartition(5), per_language=10)
    assert one.machines == two.machines and (one.weights == two.weights).all()


def test_margins_are_mean_weights():
    rng = np.random.default_rng(1)
    model = Model({"f": ["a", "b"]}, [Machine("a", "b", 0.5)], rng.normal(size=(4096, 1)).astype("f"))
    texts = pa.array(["Hello, World  x", "", "àé", "a"])
    together = _margins(model, texts)
    for i, t in enumerate(texts.to_pylist()):
        bins = np.concatenate([b for b, _ in _grams(pa.array([t]))] or [np.zeros(0, int)])
        mean = model.weights[bins, 0].mean() if len(bins) else 0
        assert abs(together[i, 0] - mean - 0.5) < 1e-5


def test_several_languages_of_a_family(spark):
    texts = {"de": "der die und das", "nl": "het een van de", "sv": "och att det som"}
    rows = [(i * 3 + k, f"{t} {t} {i}", lang, None) for i in range(30) for k, (lang, t) in enumerate(texts.items())]
    docs = documents(spark, rows)
    model = fit(docs)
    assert model.families == {"germanic": ["de", "nl", "sv"]} and len(model.machines) == 3
    got = identify(docs.select("lang", "text"), model).collect()
    assert all(r["_c0"] == r.lang_pred for r in got)


def test_every_label_is_learned(spark):
    """Seventy labels, one of them mostly copies of three texts."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: letters[k % 26] + letters[k // 26] * 2 + letters[(7 * k) % 26]
    rows = [(k * 50 + i, f"{word(k)} {word(k)} {i}", f"l{k:02d}", None) for k in range(70) for i in range(6)]
    rows += [(10_000 + i, f"copied text number {letters[i % 3]}", "l69", None) for i in range(2_000)]
    model = fit(documents(spark, rows), families={}, sample=400)
    assert model.languages == [f"l{k:02d}" for k in range(70)]
    got = identify(documents(spark, rows[:420]).select("lang", "text"), model).collect()
    assert all(r["_c0"] == r.lang_pred for r in got)
