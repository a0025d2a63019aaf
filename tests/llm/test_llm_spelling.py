import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import ascii_lower, documents

from monthtide.llm.spelling_variants import SLIP, near_words, spelling_variants


def counted(rows, slip):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, slip=SLIP):
    n = counted(rows, slip)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def text_of(rng, words):
    return rng.choice([" ", ", ", "9", "\n"]).join(w if rng.random() < 0.8 else w.upper() for w in words)


def vocabulary(rng, letters, n):
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(n)]
    for w in words[: n // 2]:
        at = rng.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]]
    return words


@pytest.mark.parametrize("letters, crowd", [("abcdefghijklmnopqrstuvwxyzéß", 128), ("abé", 128), ("abé", 3)])
def test_against_all_pairs(spark, letters, crowd):
    """Few letters crowd the signatures, which then go the other exact way."""
    rng = random.Random(len(letters) + crowd)
    words = vocabulary(rng, letters, 120)
    weights = [1 / (1 + i % 17) for i in range(len(words))]
    rows = [(i, text_of(rng, rng.choices(words, weights, k=60))) for i in range(90)]
    rows += [(None, rows[0][1]), rows[1], rows[1], (200, None), (201, ""), (202, "1234 ___"), (203, "ÀÉÖ×÷ ÀÉÖ×÷ ÀÉÖ×÷ ÀÉÖ×÷")]
    got = spelling_variants(documents(spark, rows), slip=SLIP, crowd=crowd).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_forms_are_followed_to_the_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    rows = [(i, " ".join([w] * (3 * 2**i))) for i, w in enumerate(chain)]
    got = {r.word: r for r in spelling_variants(documents(spark, rows)).collect()}
    assert {r.root for r in got.values()} == {"bbbbb"} and got["aaaaa"].form == "aaaab"
    assert sorted(map(tuple, got.values())) == brute(rows, None)


def test_ties_take_the_first_by_code_point(spark):
    rows = [(1, "colour " * 3 + "colouré " * 6 + "colours " * 6)]
    got = {r.word: r.form for r in spelling_variants(documents(spark, rows)).collect()}
    assert got == {"colour": "colours", "colouré": None, "colours": None}


def test_swapped_letters_are_not_near(spark):
    rows = [(1, "teher " * 3 + "there " * 9)]
    assert {r.n_near for r in spelling_variants(documents(spark, rows)).collect()} == {0}


def test_long_words_and_empty_table(spark):
    long = "ab" * 50_000
    rows = [(1, f"{long} {long} {long}x {long}x {long} {long}x " + "word " * 100_000)]
    got = {len(r.word): r.n_near for r in spelling_variants(documents(spark, rows)).collect()}
    assert got == {100_000: 1, 100_001: 1}
    empty = spelling_variants(documents(spark, rows).where("false"))
    assert empty.columns == ["word", "n", "n_near", "form", "form_n", "root"] and empty.count() == 0


@pytest.mark.parametrize("crowd", [2, 128])
def test_words_around_the_length_that_is_long(spark, crowd):
    rng = random.Random(crowd)
    words = set()
    for length in (255, 256, 257, 400):
        base = "".join(rng.choice("abc") for _ in range(length))
        words.add(base)
        for at in (0, 1, length // 2, length - 1):
            words |= {base[:at] + base[at + 1 :], base[:at] + "z" + base[at:], base[:at] + "z" + base[at + 1 :]}
        words |= {base + "z", base[1:] + "z", base[::-1]}
    near = near_words(spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long"), crowd)
    got = {(r.word, r.other) for r in near.collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)} and len(got) > 100


def test_all_variants_of_a_word_are_found(spark):
    word = "planet"
    letters = "abcdefghijklmnopqrstuvwxyz"
    others = {word[:i] + word[i + 1 :] for i in range(6)}
    others |= {word[:i] + x + word[i:] for i in range(7) for x in letters}
    others |= {word[:i] + x + word[i + 1 :] for i in range(6) for x in letters} - {word}
    rows = [(w, 3) for w in sorted(others | {word})]
    for crowd in (3, 10_000):
        near = near_words(spark.createDataFrame(rows, "word string, n long"), crowd)
        got = defaultdict(set)
        for r in near.collect():
            got[r.word].add(r.other)
        assert got[word] == others
        assert all(got[w] == {x for x in others | {word} if one_edit(w, x)} for w in list(others)[:40])
