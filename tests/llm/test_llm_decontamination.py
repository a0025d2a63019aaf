import random

import pytest
from llm_data import documents, sentence

from monthtide.llm.decontamination import (
    LITERAL,
    NAME,
    NOTHING,
    NUMBER,
    UNIT,
    best_occurrence,
    classify,
    contaminated,
    drop_contaminated,
)

ITEM = "If Anna buys 12 apples and then Anna gives 5 kg to her friend Bob how many are left"
OTHER = "If Maria buys 30 apples and then Maria gives 7 lb to her friend Tom how many are left"
LOOSE = "If Maria buys 30 apples and then Lisa gives 7 lb to her friend Tom how many are left"


def items(spark, texts):
    return spark.createDataFrame(
        list(enumerate(texts)), "item_id long, text string"
    )


@pytest.mark.parametrize(
    ("word", "kind", "ends"),
    [("12", NUMBER, False), ("3.5kg.", NUMBER, True), ("seven", NUMBER, False), ("kg", UNIT, False),
     ("Anna", NAME, False), ("(Bob),", NAME, False), ("NASA", LITERAL, False), ("apples!", LITERAL, True),
     ("|", NOTHING, False), ("...", NOTHING, True), ("A", LITERAL, False), ("élan", LITERAL, False)],
)
def test_tokens(word, kind, ends):
    assert (classify(word)[0], classify(word)[2]) == (kind, ends)


def test_reparameterised_questions(spark):
    rng = random.Random(1)
    noise = [sentence(rng, 50) for _ in range(5)]
    docs = documents(spark, [
        (1, ITEM), (2, f"{noise[0]}. {OTHER}. {noise[1]}"), (3, LOOSE), (4, noise[2]),
        (5, f"{noise[3]}\n{ITEM.upper()}"), (6, " ".join(ITEM.split()[:9])), (7, None), (8, ""),
        (None, f"x {ITEM}"), (2, noise[4]), (1, ITEM), (9, ITEM.replace("apples", "very ripe green apples")),
    ])
    bench = items(spark, [ITEM, None, "", "a few words only"])
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (None, 0), (9, 0)}
    assert got[1, 0].coverage == 1 and not got[1, 0].reparameterised
    assert got[2, 0].coverage == 1 and got[2, 0].reparameterised
    assert got[2, 0].bindings == {"12": "30", "anna": "maria", "5": "7", "kg": "lb", "bob": "tom"}
    # where the slots disagree, the windows with the other name don't count
    assert got[3, 0].coverage < got[2, 0].coverage
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [4, 5, 6, 7, 8, 2]))


MARIA = "Maria has 12 red marbles in a box. Maria gives 5 of them to Pedro. Maria then buys 8 more."


def test_names_that_open_sentences(spark):
    docs = documents(spark, [
        (1, MARIA.replace("Maria", "Lucia").replace("12", "31")), (2, MARIA.replace("Maria", "Mary Ann")),
        (3, "Nobody has seen the old red barn since. Then it rained for days and all the hay was lost."),
    ])
    got = {r.doc_id: r for r in contaminated(docs, items(spark, [MARIA])).collect()}
    assert set(got) == {1, 2}
    assert got[1].coverage == 1 and got[1].reparameterised
    assert got[1].bindings["maria"] == "lucia" and got[1].bindings["12"] == "31"
    assert got[2].coverage == 1 and got[2].bindings["maria"] == "mary ann"


def test_copies_in_any_case(spark):
    docs = documents(spark, [(1, ITEM.lower()), (2, f"so: {ITEM.upper()}"), (3, ITEM.title()), (4, OTHER.lower())])
    got = {r.doc_id: r for r in contaminated(docs, items(spark, [ITEM]), any_case=True).collect()}
    assert {1, 2, 3} <= set(got) and all(got[i].coverage == 1 for i in (1, 2, 3))
    assert not any(got[i].reparameterised for i in (1, 2, 3))
    back = contaminated(documents(spark, [(1, ITEM)]), items(spark, [ITEM.lower()]), any_case=True)
    assert [r.coverage for r in back.collect()] == [1]


def test_against_whole_passages(spark):
    """Every planted passage is found, and nothing else."""
    rng = random.Random(2)
    bench = [sentence(rng, rng.randrange(8, 50), 10**6) for _ in range(20)]
    bench += [sentence(rng, 7, 10**6), bench[0]]
    rows = []
    for i in range(150):
        parts = [sentence(rng, rng.randrange(0, 80), 10**6)]
        if i % 3 == 0:
            parts.append(rng.choice(bench))
        parts.append(sentence(rng, rng.randrange(0, 80), 10**6))
        rows.append((i, "\n".join(parts)))
    rows.append((999, " ".join([bench[3]] * 200) + sentence(rng, 20_000, 10**6)))
    got = {(r.doc_id, r.item_id) for r in contaminated(documents(spark, rows), items(spark, bench)).collect()}
    want = {
        (i, k) for i, t in rows for k, b in enumerate(bench)
        if f" {b} " in f" {' '.join(t.split())} "
    }
    assert got == want and len(want) > 40


def test_tables_of_numbers_match_by_value(spark):
    numbers = "1 2 3 4 5 6 7 8 9 10 11 12"
    docs = documents(spark, [(1, numbers), (2, "21 22 23 24 25 26 27 28 29 30 31 32")])
    got = contaminated(docs, items(spark, [numbers])).collect()
    assert [(r.doc_id, r.coverage) for r in got] == [(1, 1.0)]


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, ITEM)]), items(spark, [ITEM])
    assert contaminated(docs.where("false"), bench).count() == 0
    assert contaminated(docs, bench.where("false")).count() == 0
    assert drop_contaminated(docs, bench.where("false")).count() == 1
    assert drop_contaminated(docs.where("false"), bench).count() == 0


def test_occurrences_are_judged_apart():
    def match(doc, pos, mine, theirs):
        return {"doc_pos": doc, "pos": pos, "size": 8, "slots": [mine], "doc_slots": [theirs]}

    twice = [match(p, p, "5", "6") for p in range(3)] + [match(100 + p, p, "5", "7") for p in range(5)]
    best = best_occurrence(twice, 12)
    assert (best["covered"], best["start"], best["bindings"]) == (12, 100, [("5", "7")])
