import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import ascii_lower, documents, sentence, words

from monthtide.llm.components import components
from monthtide.llm.jaccard_join import (
    COUNTERS,
    Similarity,
    _short_lists,
    drop_near_copies,
    jaccard_components,
)
from monthtide.llm.words import slices, split, word_hashes


def shingles(text):
    w = words(ascii_lower(text or ""))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows):
    sets = defaultdict(list)
    for i, text in rows:
        if i is not None:
            sets[i].append(shingles(text))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(
                x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]
            ):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return Counter((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows)


def near_copies(rng, n):
    """Families of near copies of all degrees, texts that share a passage, chains, short texts."""
    rows = []
    passage = sentence(rng, 60)
    for family in range(n):
        base = sentence(rng, rng.choice([6, 20, 80, 200])).split()
        for _ in range(rng.randrange(1, 7)):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(999)}"
            rows.append(" ".join(text))
        rows.append(f"{sentence(rng, rng.choice([3, 15, 60]))} {passage}")
    chain = sentence(rng, 120).split()
    for i in range(12):
        chain[i * 9] = f"c{i}"
        rows.append(" ".join(chain))
    rows += ["a b", "A  b", "b a", "", None, " \n", "one two three four five", sentence(rng, 9000)]
    rows.append(rows[-1] + " more words")
    rng.shuffle(rows)
    return list(enumerate(rows, 3))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = near_copies(random.Random(seed), 40)
    rows += [(None, rows[0][1]), (None, None), (rows[5][0], rows[5][1]), (7, "seven has two texts here")]
    got = jaccard_components(documents(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_frequent_shingles_and_hot_group(spark):
    """Frequent shingles take the other way; copies and near copies are most of the rows."""
    rng = random.Random(3)
    base = sentence(rng, 100).split()
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(100)] = f"e{rng.randrange(9999)}"
        rows.append((i, " ".join(text)))
    rows += [(500 + i, " ".join(base[:60]) + " " + sentence(rng, 60)) for i in range(100)]
    got = jaccard_components(documents(spark, rows).coalesce(2)).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_bridged_clusters(spark):
    """Two clusters of near copies, with one pair near the bound between them, many times."""
    rng = random.Random(6)
    rows, want, base_id = [], Counter(), 0
    for _ in range(400):
        base = sentence(rng, 24, 10**6).split()
        other = list(base)
        other[-2] = "bridge"
        family = [" ".join(base), " ".join(other)]
        for whole in (base, other):
            for _ in range(rng.randrange(2, 7)):
                text = list(whole)
                text[rng.choice([0, 1, -1])] = f"e{rng.randrange(10**6)}"
                family.append(" ".join(text))
        rng.shuffle(family)
        family = list(enumerate(family, base_id))
        base_id += len(family)
        rows += family
        want += brute(family)
    got = Counter(map(tuple, jaccard_components(documents(spark, rows)).collect()))
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(4)
    rows = near_copies(rng, 8) + [(None, "no identifier at all here")]
    docs = documents(spark, rows)
    got = drop_near_copies(docs)
    assert got.columns == docs.columns
    want = {c for (i, _, c), _ in brute(rows).items()}
    assert {r.doc_id for r in got.collect()} == want


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).where("false")
    assert jaccard_components(docs).count() == 0 and drop_near_copies(docs).count() == 0


def test_no_links(spark):
    got = jaccard_components(documents(spark, [(2, "a b c d e f"), (1, "g h i j k l m")])).collect()
    assert sorted(map(tuple, got)) == [(1, 3, 1), (2, 2, 2)]


def test_lists_are_made_in_one_pass_over_the_texts(spark):
    """Rare and frequent tokens together: splitting and hashing the texts is most of the work."""
    text = sentence(random.Random(5), 20)
    # a text without partners leaves rows only where its tokens are frequent
    rows = [(1, text), (2, text + " more"), (3, "a lonely text of eight quite different words")]
    texts = spark.createDataFrame(rows, "doc long, text string")
    rep_of = texts.selectExpr("doc", "doc as rep", "20L as n")
    for level, docs in ((0, [1, 2]), (1, [1, 2, 3])):
        frequent = spark.sparkContext.broadcast(np.full(COUNTERS, level, np.uint8))
        lists = _short_lists(texts, Similarity(), frequent, rep_of)
        assert sorted(r.rep for r in lists.select("rep").distinct().collect()) == docs
        assert lists._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1


def test_bounds_are_exact():
    s = Similarity()
    for m in range(1, 60):
        for n in range(1, 60):
            least = min((k for k in range(min(m, n) + 1) if 100 * k >= 75 * (m + n - k)), default=None)
            assert least is None or least == s.overlap(m, n)
            assert least is None or least >= s.least(n)


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)]
    links += [(50, 51), (51, 52), (52, 50), (60, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {
        **{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 30)}, 50: 50, 51: 50, 52: 50
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_and_hashes():
    texts = pa.array(["  A b\x0bC \n", "", None, " ", "a\x1cb\x85c D", "x" * 1000])
    flat, ends = split(texts, lower=True)
    assert flat.to_pylist() == ["a", "b", "c", "a\x1cb\x85c", "d", "x" * 1000]
    assert ends.tolist() == [3, 3, 3, 3, 5, 6]
    many = pa.array([f"{i:0{1 + i % 40}d}" for i in range(20_000)] + ["y" * 999, "y" * 998])
    assert len(set(word_hashes(many).tolist())) == len(set(many.to_pylist()))
    assert word_hashes(many.slice(7, 5)).tolist() == word_hashes(many)[7:12].tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "x" * 50, "", "de"])], ["t"])
    parts = list(slices([batch, batch.slice(0, 0)], "t", most=10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows for p in parts) and np.size(word_hashes(pa.array([], pa.string()))) == 0
