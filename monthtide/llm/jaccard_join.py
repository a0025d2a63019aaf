"""Self-join of texts on the Jaccard similarity of their word n-grams, by T-occurrence search.

Two texts of m and n shingles that are similar enough share at least ``overlap(m, n)`` of
them. DivideSkip divides the inverted lists of a text in two: as many of the longest as it
may have without losing a partner are set aside, the others, the short ones, are merged, and
only documents that occur often enough in the short lists are looked up, by binary search, in
the long ones. Here:

1. One pass over the texts makes a digest of each shingle set (equal sets are one class from
   here on, stood for by its smallest doc_id) and finds which shingles are frequent, in a
   fixed number of counters. The counters only order the lists: a shingle they take for
   frequent wrongly, or miss, costs time and never a link.
2. A second pass emits, of every document, the ``n - T + 1`` shingles with the shortest lists,
   ``T`` being the least overlap with any partner. Their inverted lists are built by one
   shuffle; lists of one document go.
3. Every document is compared with the smallest document of the list pattern it shares most
   with. The components of these links pull groups of near copies together, so that their
   pairs need not be written out: only links between different components matter below.
4. Lists within one component go. The components are put in one order, and each document gets
   of its lists what belongs to later components, so that all that two documents share is
   counted on one side; a heap merges a document's short lists, and candidates that occur less
   often than ``T`` less the number of long lists are dropped.
5. The surviving pairs probe each other's sorted whole sets by binary search.

Shingles are compared by 64-bit hashes of their words.

Defined results: a null or blank text has no shingles and no links. A row without identifier
takes no part in links and has no component. Rows that repeat an identifier are the same
document: it has the links of all its texts. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.components import components
from monthtide.llm.frames import batches_of, seal, settle
from monthtide.llm.words import slices, split, window_hashes, word_hashes

#: Counters of frequent shingles: 4 bytes each in a task, 1 in the broadcast.
COUNTERS = 1 << 20
#: Rows of texts, and of sets or lists, that a task hands to Python at a time.
TEXT_ROWS, SET_ROWS = 2_000, 250
#: Bits of the filter that tells which documents a verification needs: an eighth in bytes.
FILTER_BITS = 1 << 23
#: Documents of a list that one row may hold; longer lists are dealt out by document.
LIST_ROWS = 100_000
#: The largest components, told to all tasks; the others are ordered by identifier alone.
LARGE = 10_000


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` / 100 on shingles of ``size`` words."""

    size: int = 5
    percent: int = 75

    def least(self, n):
        """The least overlap of a set of n with any partner."""
        return -(-self.percent * n // 100)

    def overlap(self, m, n):
        """The least overlap of sets of m and n that are similar enough."""
        return -(-self.percent * (m + n) // (100 + self.percent))

    def shingles(self, values: np.ndarray) -> np.ndarray:
        """The sorted distinct shingles of a text's words."""
        return np.unique(window_hashes(values, min(self.size, len(values)) or 1))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: Similarity = Similarity(),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    digests, links = _search(docs, id_col, text_col, similarity)
    return _with_component(digests, components(links)).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: Similarity = Similarity(),
) -> DataFrame:
    """``docs`` with one document of each component: all rows of its smallest identifier.

    Rows without identifier stay.
    """
    digests, links = _search(docs, id_col, text_col, similarity)
    gone = (
        _with_component(digests, components(links))
        .where("component_id <> doc")
        .select("doc")
        .distinct()
    )
    sealed = seal(docs)
    # The identifiers to drop are far fewer than the rows; written first, their size is known
    # when Spark chooses how to join.
    stay = sealed.frame.join(
        settle(gone), sealed.frame[sealed.column(id_col)] == F.col("doc"), "left_anti"
    )
    return sealed.restore(stay)


def _with_component(digests: DataFrame, found: DataFrame) -> DataFrame:
    key = ["n", "high", "low"]
    least = digests.where("n > 0").groupBy(*key).agg(F.min("doc").alias("rep"))
    classes = least.join(found, least["rep"] == found["node"], "left").select(
        *key, F.coalesce("component", "rep").alias("of_class")
    )
    joined = digests.join(settle(classes), key, "left")
    # a document whose rows differ belongs to one component: that of its identifier
    return joined.select(
        "doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("of_class", "doc")).alias("component_id")
    )


def _search(
    docs: DataFrame, id_col: str, text_col: str, similarity: Similarity
) -> tuple[DataFrame, DataFrame]:
    """The digest of every row, and links (a, b) that connect all documents that are linked."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    spark = docs.sparkSession
    with batches_of(spark, TEXT_ROWS):
        seen = settle(texts.mapInArrow(_digests(similarity), DIGEST))
    digests = seen.where("counter is null").select("doc", "n", "high", "low")
    frequent = _frequent(seen)

    named = digests.where("n > 0 and doc is not null")
    reps = named.groupBy("n", "high", "low").agg(F.min("doc").alias("rep"))
    rep_of = settle(named.join(reps, ["n", "high", "low"]).select("doc", "rep", "n").distinct())

    with batches_of(spark, TEXT_ROWS):
        short = settle(_short_lists(texts, similarity, frequent, rep_of))
    near = _verified(settle(_nearest(short, similarity)), texts, similarity)
    parts = settle(components(near))
    far = _verified(_candidates(short, parts, similarity), texts, similarity)
    return digests, near.union(far)


DIGEST = "doc long, n long, high long, low long, counter int, count long"


def _digests(similarity: Similarity):
    """A row for each text, and at the end of a task one for each counter that stands out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        for part in slices(batches, "text"):
            words, ends = split(part.column("text"), lower=True)
            values = word_hashes(words)
            sets = [similarity.shingles(x) for x in np.split(values, ends[:-1])]
            every = np.concatenate(sets)
            counters += np.bincount(every % COUNTERS, minlength=COUNTERS).astype(np.uint32)
            codes = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            halves = np.frombuffer(b"".join(codes), "<i8").reshape(-1, 2)
            none = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    none,
                    none.cast(pa.int64()),
                ],
                ["doc", "n", "high", "low", "counter", "count"],
            )
        out = np.flatnonzero(counters >= 8 + 4 * counters.mean())
        none = pa.nulls(len(out), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none] * 4 + [pa.array(out.astype(np.int32)), pa.array(counters[out].astype(np.int64))],
            ["doc", "n", "high", "low", "counter", "count"],
        )

    return run


def _frequent(seen: DataFrame):
    """Broadcast: the logarithm of each counter, 0 where no task found it to stand out."""
    sums = seen.where("counter is not null").groupBy("counter").agg(F.sum("count").alias("n"))
    rows = sums.select("counter", F.floor(F.log2("n")).cast("int").alias("level")).toArrow()
    levels = np.zeros(COUNTERS, np.uint8)
    levels[rows.column("counter").to_numpy()] = rows.column("level").to_numpy()
    return seen.sparkSession.sparkContext.broadcast(levels)


def _short_lists(
    texts: DataFrame, similarity: Similarity, frequent, rep_of: DataFrame
) -> DataFrame:
    """token, rep, n: the inverted lists of the short kind that hold two classes or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = frequent.value
        for part in slices(batches, "text"):
            words, ends = split(part.column("text"), lower=True)
            tokens, often = [], []
            for x in np.split(word_hashes(words), ends[:-1]):
                x = similarity.shingles(x)
                level = levels[x % COUNTERS]
                if level.any():
                    order = np.argsort(level, kind="stable")
                    x, level = x[order], level[order]
                take = len(x) - similarity.least(len(x)) + 1 if len(x) else 0
                tokens.append(x[:take].view(np.int64))
                often.append(level[:take] > 0)
            docs = part.column("doc").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(docs, [len(x) for x in tokens]), pa.int64()),
                    pa.array(np.concatenate(tokens), pa.int64()),
                    pa.array(np.concatenate(often), pa.bool_()),
                ],
                ["doc", "token", "often"],
            )

    held = texts.where("doc is not null").mapInArrow(run, "doc long, token long, often boolean")
    # Of the rare tokens most have one document and go at once. Frequent tokens may have any
    # number of documents: their rows are dealt by document too, so that they never meet.
    dealt = F.when(F.col("often"), F.xxhash64("token", "doc")).otherwise(F.col("token"))
    docs_of = F.count(F.lit(1)).over(Window.partitionBy(dealt))
    named = (
        held.select("token", "doc", "often", docs_of.alias("docs"))
        .where("often or docs > 1")
        .join(rep_of, "doc")
        .select("token", "rep", "n")
        .distinct()
    )
    return named


def _nearest(short: DataFrame, similarity: Similarity) -> DataFrame:
    """a, b: each class, and of the first classes of its lists that which it shares most with."""
    first = short.groupBy("token").agg(F.min(F.struct("rep", "n")).alias("first"))
    shared = (
        short.join(first, "token")
        .where("rep <> first.rep")
        .groupBy("rep", "n", "first")
        .agg(F.count(F.lit(1)).alias("shared"))
        .where(_enough(similarity, F.col("n"), F.col("first.n"), F.col("shared")))
    )
    return shared.groupBy("rep").agg(
        F.max_by("first.rep", F.struct("shared", -F.col("first.rep"))).alias("b")
    ).select(F.col("rep").alias("a"), "b")


def _enough(similarity: Similarity, m, n, shared):
    """Can sets of m and n reach the overlap, ``shared`` of their short lists being common?"""
    p = similarity.percent
    need = F.ceil(p * (m + n) / (100 + p))
    long = F.greatest(F.ceil(p * m / 100), F.ceil(p * n / 100)) - 1
    return (shared + long >= need) & (100 * F.least(m, n) >= p * F.greatest(m, n))


def _candidates(short: DataFrame, parts: DataFrame, similarity: Similarity) -> DataFrame:
    """a, b: classes of different components that occur in each other's short lists often enough."""
    # Any order of the components gives each pair one side that asks for all lists they share;
    # with the largest last, the members of large components seldom ask.
    large = settle(
        parts.groupBy("component").count().orderBy(F.desc("count"), "component").limit(LARGE)
        .select(F.col("component").alias("part"), F.col("count").alias("members"))
    )
    rows = short.join(parts, short["rep"] == parts["node"], "left").select(
        "token", "rep", "n", F.coalesce("component", "rep").alias("part")
    )
    split_up = (
        rows.groupBy("token")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low <> high")
        .select("token")
    )
    place = F.struct(F.coalesce("members", F.lit(0)).alias("members"), "part")
    rows = settle(
        rows.join(split_up, "token")
        .join(F.broadcast(large), "part", "left")
        .select("token", "rep", "n", place.alias("part"))
    )
    last = rows.groupBy("token").agg(F.max("part").alias("last"))
    asking = rows.join(last, "token").where("part <> last").drop("last")
    dealt = max(1, -(-rows.select("rep").distinct().count() // LIST_ROWS))
    lists = (
        rows.groupBy("token", "part", F.pmod(F.xxhash64("rep"), F.lit(dealt)).alias("deal"))
        .agg(F.sort_array(F.collect_list(F.struct("rep", "n"))).alias("members"))
        .groupBy("token", "deal")
        .agg(F.collect_list(F.struct(F.col("part").alias("of"), "members")).alias("lists"))
    )
    joined = asking.join(lists, "token")
    # What can't be a partner, by component or size, goes before the lists move.
    percent = F.lit(similarity.percent)
    later = F.flatten(
        F.transform(F.filter("lists", lambda x: x["of"] > F.col("part")), lambda x: x["members"])
    )
    partners = F.sort_array(
        F.filter(
            later,
            lambda x: 100 * F.least(x["n"], F.col("n")) >= percent * F.greatest(x["n"], F.col("n")),
        )
    )
    asked = (
        joined.select("rep", "n", "deal", partners.alias("list"))
        .where(F.size("list") > 0)
        .select("rep", "n", "deal", *[F.col(f"list.{c}").alias(f"{c}s") for c in ("rep", "n")])
        .groupBy("rep", "n", "deal")
        .agg(F.collect_list("reps").alias("reps"), F.collect_list("ns").alias("ns"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c) for c in ("rep", "n", "reps", "ns")]
            for row in range(batch.num_rows):
                rep, n, reps, ns = (c[row].as_py() for c in columns)
                for other in _merged(similarity, n, reps, ns):
                    if other != rep:
                        a.append(rep)
                        b.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    pairs = asked.mapInArrow(run, "a long, b long")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with batches_of(pairs.sparkSession, SET_ROWS):
        return settle(pairs)


def _merged(
    similarity: Similarity, n: int, reps: list[list[int]], ns: list[list[int]]
) -> Iterator[int]:
    """Documents that occur often enough in the short lists of a set of n.

    Lists are merged by heap. A document has the same size in all lists, or is looked for
    with each of its sizes.
    """
    last, times = None, 0
    for entry in [*heapq.merge(*[list(zip(*x)) for x in zip(reps, ns)]), None]:
        if entry == last:
            times += 1
            continue
        if last is not None:
            beyond = max(similarity.least(last[1]), similarity.least(n)) - 1
            if times + beyond >= similarity.overlap(last[1], n):
                yield last[0]
        last, times = entry, 1


def _verified(pairs: DataFrame, texts: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b), a written table, whose whole sets are similar enough."""
    bit = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS)).cast("int")
    needed = pairs.select(F.col("a").alias("doc")).union(pairs.select("b"))
    bits = needed.select(bit.alias("bit")).distinct().toArrow().column("bit").to_numpy()
    flags = np.zeros(FILTER_BITS, bool)
    flags[bits] = True
    filter_ = pairs.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(filter_.value).astype(bool)
        chosen = (b.filter(pa.array(held[b.column("bit").to_numpy()])) for b in batches)
        for part in slices(chosen, "text"):
            words, ends = split(part.column("text"), lower=True)
            found = [similarity.shingles(x) for x in np.split(word_hashes(words), ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array([x.tobytes() for x in found], pa.binary())],
                ["doc", "set"],
            )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("set_a"), batch.column("set_b")
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(s[i].as_py(), np.uint64) for s in (one, two))
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(many, few)
                same = np.count_nonzero(many[np.minimum(at, len(many) - 1)] == few) if len(few) else 0
                good[i] = same > 0 and same >= similarity.overlap(len(x), len(y))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    all_sets = (
        texts.where("doc is not null")
        .select("doc", "text", bit.alias("bit"))
        .mapInArrow(sets, "doc long, set binary")
    )
    left = all_sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a"))
    right = all_sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b"))
    full = pairs.join(left, "a").join(right, "b")
    with batches_of(pairs.sparkSession, SET_ROWS):
        return settle(full.mapInArrow(probe, "a long, b long").distinct())
