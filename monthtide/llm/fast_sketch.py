"""Near duplicates by fast similarity sketching, banding and exact verification.

The sketch of a set of word shingles has ``bins`` coordinates. In a round every shingle is
placed by hash into one bin, and a bin that is still empty takes the least hash placed there.
The first ``bins`` rounds choose bins freely; should some be empty after that, each further
round fills one given bin with the least hash of all, so that after 2 x ``bins`` rounds every
coordinate is filled, however small the set. A set of as many shingles as bins needs a few
rounds instead of a hash of every shingle for every coordinate. Two sets agree in a coordinate
with a chance equal to their similarity, and the share that agrees is concentrated around it
more closely than with independent minima.

1. One pass over the texts makes a digest and the keys of the bands (``rows`` coordinates each)
   of every set. Equal sets are one class from here on, stood for by its smallest identifier.
2. Classes with a band in common are candidates. With 48 bands of 6, two sets of similarity
   0.8 have none with a chance below 5e-7, more similar ones with a far lower one.
3. Every class is compared with the first class of each of its bands, on full sets. The
   components of these links are parts; groups of near copies, however large, are pulled
   together without writing out their pairs.
4. Where a band still joins several parts, all pairs across parts are compared, if it has no
   more than ``CROWD`` classes. Larger bands come from passages that many documents share.
   Their classes go the exact way of prefixes instead: shingles are ordered with the frequent
   ones last, and two sets that are similar enough share one of their first ``n - least + 1``,
   so early in both that what follows is enough for the overlap they need. A long passage in
   common, which comes last, joins no others.

Every link is confirmed on full sets, of 64-bit hashes of the shingles.

Defined results: a null or blank text has no shingles and no links; a text with fewer words
than a shingle is one shingle. Texts are taken whole, whatever their length. A row without
identifier takes no part in links, has no component, and is kept. Rows that repeat an
identifier are one document, which has the links of all its texts; they are kept or dropped
together. An empty table gives an empty result; other columns, whatever their names, are
ignored by ``sketch_components`` and returned untouched by ``keep_first_of_kind``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.llm.components import components
from monthtide.llm.frames import batches_of, seal, settle
from monthtide.llm.words import mix, slices, split, window_hashes, word_hashes

#: Classes of a band that are paired with each other; above it goes the exact way.
CROWD = 8
#: A class with more than this share of the rows is told to all tasks: 1,000 at most.
HOT_SHARE = 0.001
#: Bits of the filter that tells whose sets are needed: an eighth in bytes.
FILTER_BITS = 1 << 23
#: Counters of frequent shingles, which order them and decide nothing.
COUNTERS = 1 << 20
TEXT_ROWS = 2_000

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Nearness:
    """Jaccard similarity of at least ``percent`` / 100 on shingles of ``size`` words."""

    size: int = 2
    percent: int = 80
    bands: int = 48
    rows: int = 6

    @property
    def bins(self) -> int:
        return self.bands * self.rows

    def shingles(self, values: np.ndarray) -> np.ndarray:
        """The sorted distinct shingles of a text's words."""
        return np.unique(window_hashes(values, min(self.size, len(values)) or 1))

    def sizes_fit(self, m: Column, n: Column) -> Column:
        return 100 * F.least(m, n) >= self.percent * F.greatest(m, n)

    def overlap_fits(self, most: Column, m: Column, n: Column) -> Column:
        """Are ``most`` common shingles enough for sets of m and n?"""
        return (100 + self.percent) * most >= self.percent * (m + n)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` coordinates for each set; those of an empty set stay ``EMPTY``."""
    out = np.full(len(sets) * bins, EMPTY)
    unfilled = np.ones(len(out), bool)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for round_ in range(2 * bins):
        if not len(values):
            break
        seed = mix(np.full(1, round_ + 1, np.uint64))
        placed = mix(values ^ seed)
        if round_ < bins:
            chosen = ((placed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            chosen = round_ - bins
        at = owner * bins + chosen
        new = unfilled[at]
        np.minimum.at(out, at[new], placed[new])
        unfilled[at[new]] = False
        wanting = unfilled.reshape(-1, bins).any(axis=1)[owner]
        values, owner = values[wanting], owner[wanting]
    return out.reshape(-1, bins)


def band_keys(drawn: np.ndarray, bands: int) -> np.ndarray:
    """A key for each band of each sketch; bands differ in their keys."""
    of_band = drawn.reshape(len(drawn), bands, -1)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), of_band.shape[:2])
    for k in range(of_band.shape[2]):
        keys = mix(keys ^ of_band[:, :, k]) + np.uint64(k + 1)
    return keys


def sketch_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    nearness: Nearness = Nearness(),
    crowd: int = CROWD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    with batches_of(docs.sparkSession, TEXT_ROWS):
        seen = settle(texts.mapInArrow(_sketched(nearness), SKETCHED))
    classes = settle(
        seen.where("n > 0 and doc is not null")
        .groupBy("n", "high", "low")
        .agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("keys").alias("keys"))
    )
    links = _links(classes, texts, nearness, crowd)
    return _with_component(seen.drop("keys"), classes.drop("keys"), links)


def keep_first_of_kind(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    nearness: Nearness = Nearness(),
) -> DataFrame:
    """``docs`` with one document of each component: all rows of its smallest identifier."""
    judged = sketch_components(docs, id_col, text_col, nearness)
    gone = settle(judged.where("not kept").select(F.col("doc_id").alias("doc")).distinct())
    sealed = seal(docs)
    same = sealed.frame[sealed.column(id_col)] == F.col("doc")
    return sealed.restore(sealed.frame.join(gone, same, "left_anti"))


SKETCHED = "doc long, n long, high long, low long, keys array<long>"


def _sets_of(part: pa.RecordBatch, nearness: Nearness) -> list[np.ndarray]:
    words, ends = split(part.column("text"), lower=True)
    return [nearness.shingles(x) for x in np.split(word_hashes(words), ends[:-1])]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *rows])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sketched(nearness: Nearness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = _sets_of(part, nearness)
            keys = band_keys(sketches(sets, nearness.bins), nearness.bands)
            codes = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            halves = np.frombuffer(b"".join(codes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    _lists(list(keys)),
                ],
                ["doc", "n", "high", "low", "keys"],
            )

    return run


def _links(classes: DataFrame, texts: DataFrame, nearness: Nearness, crowd: int) -> DataFrame:
    """a, b: links that connect all classes that are linked, through others or directly."""
    met = _met(classes.select("rep", "n", F.explode("keys").alias("key")))
    sets = _sets(texts, met, nearness)
    near = _verified(_with_first(met, nearness), sets, nearness)
    apart = _in_parts(met, components(near))
    far = _verified(_across(apart.where(F.col("size") <= crowd), nearness), sets, nearness)
    links = near.union(far)
    crowded = settle(apart.where(F.col("size") > crowd).select("rep").distinct())
    if crowded.isEmpty():
        return links
    held = _in_parts(_met(_prefixes(crowded, sets, nearness)), components(links))
    near = _verified(_with_first(held, nearness), sets, nearness)
    links = settle(links.union(near))
    apart = _in_parts(held.drop("part"), components(links))
    return links.union(_verified(_across(apart, nearness), sets, nearness))


def _met(keyed: DataFrame) -> DataFrame:
    """The rows whose key several documents have, with size, first, first_n of the key.

    What is known of the keys is written first, so that Spark knows its size when it chooses
    how to join.
    """
    keyed = settle(keyed)
    shared = settle(
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("rep", "n")).alias("first"),
             F.max("rep").alias("last"))
        .where("first.rep <> last")
        .select("key", "size", F.col("first.rep").alias("first"), F.col("first.n").alias("first_n"))
    )
    return settle(keyed.join(shared, "key"))


def _in_parts(met: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows whose key joins several parts, with their part."""
    named = parts.select(F.col("node").alias("rep"), F.col("component").alias("part"))
    rows = settle(met.join(named, "rep", "left").withColumn("part", F.coalesce("part", "rep")))
    several = settle(
        rows.groupBy("key")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low <> high")
        .select("key")
    )
    return settle(rows.join(several, "key"))


def _with_first(met: DataFrame, nearness: Nearness) -> DataFrame:
    """a, b: each document and the first one of its keys."""
    fits = nearness.sizes_fit(F.col("n"), F.col("first_n"))
    pairs = met.where("rep <> first").where(fits)
    return pairs.select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()


def _across(apart: DataFrame, nearness: Nearness) -> DataFrame:
    """a, b: the pairs of a key whose parts differ; those with its first are known already.

    Keys that are shingles have ``at``, their place in the order. Of the first one that two sets
    share, all others they share come later in both.
    """
    rows = apart.where("rep <> first")
    at = F.col("at") if "at" in apart.columns else F.lit(0)
    one = rows.select(
        "key", F.col("rep").alias("a"), F.col("n").alias("m"), F.col("part").alias("of_a"),
        at.alias("at_a"),
    )
    two = rows.select(
        F.col("key").alias("other"), F.col("rep").alias("b"), "n", "part", at.alias("at_b")
    )
    m, n = F.col("m"), F.col("n")
    left = F.least(m - F.col("at_a"), n - F.col("at_b"))
    fits = (
        (F.col("key") == F.col("other"))
        & (F.col("of_a") < F.col("part"))
        & nearness.sizes_fit(m, n)
        & nearness.overlap_fits(left, m, n)
    )
    return one.join(two, fits).select("a", "b").distinct()


def _sets(texts: DataFrame, met: DataFrame, nearness: Nearness) -> DataFrame:
    """doc, set: the full sets of the documents that have a candidate, and a few more."""
    place = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS).cast("long"))
    needed = met.select(F.col("rep").alias("doc")).select(place.alias("place"))
    # one row for each 64 bits of the filter, however many documents there are
    filled = (
        needed.groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        .toArrow()
    )
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[filled.column("word").to_numpy()] = filled.column("bits").to_numpy()
    sent = texts.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(sent.value.view(np.uint8), bitorder="little").astype(bool)
        chosen = (b.filter(pa.array(flags[b.column("place").to_numpy()])) for b in batches)
        for part in slices(chosen, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), _lists(_sets_of(part, nearness))], ["doc", "set"]
            )

    rows = texts.where("doc is not null").select("doc", "text", place.alias("place"))
    with batches_of(texts.sparkSession, TEXT_ROWS):
        sets = settle(rows.mapInArrow(run, "doc long, set array<long>"))
    sent.destroy()
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, nearness: Nearness) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    pairs = settle(pairs)
    one = sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    all_ = F.size("set_a") + F.size("set_b") - both
    linked = (both > 0) & (100 * both >= nearness.percent * all_)
    return settle(pairs.join(one, "a").join(two, "b").where(linked).select("a", "b"))


def _prefixes(crowded: DataFrame, sets: DataFrame, nearness: Nearness) -> DataFrame:
    """key, rep, n, at: of each set, the shingles of which any partner has one among its own."""
    own = settle(sets.join(crowded, sets["doc"] == crowded["rep"]).select("rep", "set"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            flat = batch.column("set").flatten().to_numpy().view(np.uint64)
            counters += np.bincount((flat % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        out = np.flatnonzero(counters >= 8 + 4 * counters.mean())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out.astype(np.int32)), pa.array(counters[out])], ["counter", "times"]
        )

    counted = own.select("set").mapInArrow(count, "counter int, times long")
    often = counted.groupBy("counter").agg(F.sum("times").alias("times"))
    often = often.select("counter", F.floor(F.log2("times")).cast("int").alias("level")).toArrow()
    known = np.zeros(COUNTERS, np.uint8)
    known[often.column("counter").to_numpy()] = often.column("level").to_numpy()
    sent = own.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sent.value
        for batch in batches:
            column = batch.column("set")
            firsts, sizes = [], []
            for i in range(batch.num_rows):
                x = column[i].values.to_numpy().view(np.uint64)
                order = np.argsort(levels[x % np.uint64(COUNTERS)], kind="stable")
                least = -(-nearness.percent * len(x) // 100)
                firsts.append(x[order[: len(x) - least + 1]])
                sizes.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array(sizes, pa.int64()), _lists(firsts)], ["rep", "n", "keys"]
            )

    with batches_of(own.sparkSession, TEXT_ROWS):
        found = settle(own.mapInArrow(run, "rep long, n long, keys array<long>"))
    sent.destroy()
    return found.select("rep", "n", F.posexplode("keys").alias("at", "key"))


def _with_component(seen: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Every row with its document's component."""
    key = ["n", "high", "low"]
    total = seen.count()
    hot = classes.where(F.col("members") > max(1.0, HOT_SHARE * total))
    rows = seen.where("doc is not null")
    # a document's texts that differ tie their classes together
    several = rows.groupBy("doc").agg(
        F.min(F.struct(*key)).alias("one"), F.max(F.struct(*key)).alias("other")
    ).where("one <> other").select("doc")
    tied = settle(_named(rows.join(several, "doc"), classes, hot))
    ties = tied.select(F.col("doc").alias("a"), F.coalesce("rep", "doc").alias("b"))
    found = settle(components(links.union(ties)))
    of_class = settle(
        classes.join(found, classes["rep"] == found["node"], "left").select(
            *key, "members", F.coalesce("component", "rep").alias("rep")
        )
    )
    hot = of_class.where(F.col("members") > max(1.0, HOT_SHARE * total))
    full = _named(rows.where("n > 0"), of_class, hot).select("doc", "n", F.col("rep").alias("component"))
    of_doc = found.select(F.col("node").alias("doc"), "component")
    blank = (
        rows.where("n = 0")
        .join(of_doc, "doc", "left")
        .select("doc", "n", F.coalesce("component", "doc").alias("component"))
    )
    nameless = seen.where("doc is null").select("doc", "n", F.lit(None).cast("long").alias("component"))
    return full.union(blank).union(nameless).select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _named(rows: DataFrame, classes: DataFrame, hot: DataFrame) -> DataFrame:
    """doc, n, rep of each row. ``hot`` are the few classes that hold many rows each."""
    key = ["n", "high", "low"]
    told = F.broadcast(hot.select(*key, F.col("rep").alias("hot_rep")))
    marked = rows.select("doc", *key).join(told, key, "left")
    cold = marked.where("hot_rep is null").join(classes.select(*key, "rep"), key, "left")
    return cold.select("doc", "n", "rep").union(
        marked.where("hot_rep is not null").select("doc", "n", F.col("hot_rep").alias("rep"))
    )
