"""Spelling variants of a corpus's words, found by PartEnum signatures of letter multisets.

Words that differ by one inserted, deleted or replaced letter have multisets that differ by one
or two letters. A multiset is a binary vector with a dimension for each (letter, occurrence);
the dimensions are dealt by hash over a few parts. Vectors within distance k agree in all but k
parts, so words that share no signature, the projection on some choice of all parts but k,
cannot be near. Signatures are made once for each kind of edit:

* a replaced letter keeps the length and changes two dimensions: k = 2 of ``SAME_PARTS`` parts,
  among words of one length;
* an inserted letter adds one dimension: k = 1 of ``LONGER_PARTS`` parts, among words of a
  length and those one letter longer.

Signatures meet by equijoin, and every pair is verified on the words themselves, within the
join. The signatures are exact: they never miss a pair.

Letters alone don't tell words apart that are written with few of them, so a signature may
belong to very many words. Signatures of more than ``CROWD`` words are not paired up: their
words meet by what is left of them when one letter is deleted, which a word shares with all its
variants and with at most one word for each place and letter of the alphabet. That way is exact
too, and bounds what one key can hold.

The corpus is only read to count its words, combined before the shuffle; all else works on the
distinct words that occur often enough.

Defined results:

* A null or empty text has no words. A null identifier counts as the empty text where words
  depend on it. Rows that repeat an identifier or a text count each time.
* A text or word may have any length. Of forms with the same count the one first by code point
  is taken. A form has at least ``RATIO`` times the word's count, so forms make no circle.
* An empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.frames import ascii_lower, settle
from monthtide.llm.words import mix

#: Fixed value: a word is a run of these.
RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
#: Fixed value: of so many runs, one by hash loses a letter.
SLIP = 97
SAME_PARTS, LONGER_PARTS = 6, 4
CROWD = 128
#: The edit distance of words of more letters would take the square of their length.
LONG = 256
#: Words that a task signs at a time.
SLICE = 2_000


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip: int | None = None,
    crowd: int = CROWD,
) -> DataFrame:
    """A row for each word: word, n, n_near, form, form_n, root.

    ``slip``: of that many pairs of a document and a run, one by hash loses a letter.
    """
    words = settle(word_counts(docs, id_col, text_col, slip))
    near = settle(near_words(words, crowd))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other"))).alias("best"),
    )
    formed = settle(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(-F.col("best.rank") >= RATIO * F.col("n"), F.col("best.other")).alias("form"),
            F.when(-F.col("best.rank") >= RATIO * F.col("n"), -F.col("best.rank")).alias("form_n"),
        )
    )
    return formed.join(_roots(formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def word_counts(docs: DataFrame, id_col: str, text_col: str, slip: int | None = None) -> DataFrame:
    """word, n: the words long enough that occur often enough."""
    run = F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col).cast("string")), F.lit(RUN), F.lit(0)))
    identifier = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(identifier.alias("doc"), run.alias("run"))
    word: Column = F.col("run")
    if slip:
        # a named step, so that the checksum is worked out once
        runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.char_length("run") + 1).cast("int")
        word = F.when(F.col("h") % slip == 0, F.overlay("run", F.lit(""), at, F.lit(1))).otherwise(word)
    return (
        runs.select(word.alias("word"))
        .where(F.char_length("word") >= MIN_LETTERS)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= MIN_COUNT)
    )


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """word, other, other_n: each word with each word one edit away.

    Very long words are compared in another way, in time in proportion to their length.
    """
    length = F.char_length("word")
    usual = _near(words.where(length <= LONG), crowd, _one_edit)
    # one of the usual ones may be a letter shorter than a long one
    long = _near(words.where(length >= LONG), crowd, _one_edit_of_long)
    return usual.union(long)


def _near(
    words: DataFrame, crowd: int, one_edit: Callable[[str, str], Column]
) -> DataFrame:
    """The near words, by signatures or, in crowds, by what is left of them.

    Signing a word costs less than moving its signatures, so it is done wherever they are used.
    """
    signed = words.mapInArrow(
        _signatures, "signature long, longer boolean, length int, word string, n long"
    )
    sizes = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("size"))
    crowds = settle(sizes.where(F.col("size") > crowd).select("signature"))
    few = signed.join(crowds, "signature", "left_anti")
    one, two = few.alias("one"), few.alias("two")
    # of equal lengths under the first kind of signature, one longer under the second; the kind
    # is part of the signature
    fits = (
        (F.col("one.signature") == F.col("two.signature"))
        & (F.abs(F.col("one.length") - F.col("two.length")) == F.col("one.longer").cast("int"))
        & one_edit("one.word", "two.word")
    )
    by_letters = one.hint("merge").join(two, fits).select(
        "one.word", F.col("two.word").alias("other"), F.col("two.n").alias("other_n")
    )
    crowded = signed.join(crowds, "signature", "left_semi").select("word", "n").distinct()
    return by_letters.union(_by_rests(settle(crowded), one_edit)).distinct()


def _one_edit(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def _one_edit_of_long(a: str, b: str) -> Column:
    """The same of words one of which is long: after the common beginning all but a letter agrees.

    The beginning's length is found bit by bit.
    """
    x, y = F.col(a), F.col(b)
    m, n = F.char_length(x), F.char_length(y)

    def longer(known: Column, bit: Column) -> Column:
        more = known + bit
        same = F.substring(x, F.lit(1), more) == F.substring(y, F.lit(1), more)
        return F.when((more <= F.least(m, n)) & same, more).otherwise(known)

    bits = F.array(*[F.lit(1 << k) for k in reversed(range(30))])
    common = F.aggregate(bits, F.lit(0), longer)
    rest = lambda w, skip: F.substring(w, common + F.lit(1) + skip, F.lit((1 << 31) - 1))
    agrees = rest(x, F.when(m < n, 0).otherwise(1)) == rest(y, F.when(n < m, 0).otherwise(1))
    return (x != y) & (F.greatest(m, n) > LONG) & (F.abs(m - n) <= 1) & agrees


def _by_rests(words: DataFrame, one_edit: Callable[[str, str], Column]) -> DataFrame:
    """As ``near_words``, by what is left of words without one letter, or with all of them."""
    places = F.sequence(F.lit(1), F.char_length("word"))
    rests = F.transform(places, lambda i: F.overlay("word", F.lit(""), i, F.lit(1)))
    left = words.select(
        F.explode(F.array_union(F.array("word"), rests)).alias("left"), "word", "n"
    )
    keyed = left.withColumn("left", F.xxhash64("left"))
    others = keyed.select(
        F.col("left").alias("other_left"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    both = (F.col("left") == F.col("other_left")) & one_edit("word", "other")
    return keyed.hint("merge").join(others, both).select("word", "other", "other_n")


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All signatures of every word, a few thousand words at a time."""
    same = list(combinations(range(SAME_PARTS), SAME_PARTS - 2))
    longer = list(combinations(range(LONGER_PARTS), LONGER_PARTS - 1))
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            owner, hashed, length = _dimensions(part.column("word").to_pylist())
            by_six = _dealt(owner, hashed, len(length), SAME_PARTS)
            by_four = _dealt(owner, hashed, len(length), LONGER_PARTS)
            made = [(False, length, by_six, same)]
            made += [(True, length + more, by_four, longer) for more in (0, 1)]
            signatures, kinds = [], []
            for kind, told, parts, choices in made:
                for number, choice in enumerate(choices):
                    chosen = parts[:, choice].sum(axis=1, dtype=np.uint64)
                    seed = mix((2 * told + kind).astype(np.uint64) * np.uint64(64) + np.uint64(number))
                    signatures.append(mix(chosen ^ seed).view(np.int64))
                    kinds.append(np.full(len(length), kind))
            at = pa.array(np.tile(np.arange(len(length)), len(signatures)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(signatures)),
                    pa.array(np.concatenate(kinds)),
                    pa.array(length.astype(np.int32)).take(at),
                    part.column("word").take(at),
                    part.column("n").take(at),
                ],
                ["signature", "longer", "length", "word", "n"],
            )


def _dimensions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every letter of every word: the word's place and a hash of (letter, occurrence).

    Then the words' lengths.
    """
    known: dict[tuple[str, int], int] = {}
    flat = []
    for word in words:
        times: dict[str, int] = {}
        for letter in word:
            k = times.get(letter, 0)
            times[letter] = k + 1
            flat.append(known.setdefault((letter, k), len(known)))
    names = np.fromiter(
        (xxhash.xxh3_64_intdigest(f"{letter}{k}") for letter, k in known), np.uint64, len(known)
    )
    length = np.fromiter(map(len, words), np.int64, len(words))
    return np.repeat(np.arange(len(words)), length), names[np.array(flat, np.int64)], length


def _dealt(owner: np.ndarray, hashed: np.ndarray, words: int, parts: int) -> np.ndarray:
    """For each word and part the sum of the hashes of its dimensions there."""
    out = np.zeros(words * parts, np.uint64)
    part = ((hashed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    np.add.at(out, owner * parts + part, mix(hashed ^ (part + 1).astype(np.uint64)))
    return out.reshape(words, parts)


def _roots(formed: DataFrame) -> DataFrame:
    """word, root of the words that have a form, by doubling the way followed at each round."""
    ways = settle(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = settle(ways.join(onward, "root", "left").select("word", "root", "next"))
        if further.where("next is not null").isEmpty():
            return ways
        ways = further.select("word", F.coalesce("next", "root").alias("root"))
