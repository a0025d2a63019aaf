"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

The documents of a source are dealt by hash over permuted blocks of about ``block_words``
words. A source's stream is its blocks in a permuted order, then again in another order, up to
``epochs`` times; its quota is the number of leading blocks of the stream that hold the words
of its target. The last one is cut, document by document, so that the words taken are the
target's to the word.

The quotas of all sources are divided among the output shards by a binary tree: a node that
stands for some shards draws, without replacement, the blocks that go to its left half. Each
node's draw is seeded by its place in the tree, so any shard finds its own share and where it
starts in every stream by walking down from the root: shards take disjoint blocks, and no
table of the draws is ever needed in one place. Within a shard, rows are ordered by hash.

Only one row for each source and one for each block is aggregated or joined; texts don't move
unless the shards are written out.

Defined results:

* The size of a null, empty or blank text is 0: it is in no shard, and takes nothing.
* A null source is a source of its own, last in the order of weights. A source of size 0 has
  target 0. Null identifiers are mixed like others. Repeated rows each count; rows that are
  alike in identifier and text are always taken alike, except in a block that is cut.
* An empty table gives an empty result. Extra columns are ignored or carried untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthtide.llm.frames import seal, settle

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
BLOCK_WORDS = 200_000
SHARDS = 64
SEED = 20_260
#: A word is a run of anything but these.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float):
    """Targets by weight, none above ``most`` times its size, the excess reshared by weight."""
    caps = [most * s for s in sizes]
    targets = [0.0] * len(sizes)
    open_ = [i for i, c in enumerate(caps) if c > 0]
    left = min(total, sum(caps))
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / weight > caps[i]]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in above:
            targets[i] = caps[i]
            left -= caps[i]
        open_ = [i for i in open_ if i not in above]
    return targets


def _hash(*parts) -> Column:
    return F.xxhash64(*[F.lit(p) if isinstance(p, (int, str)) else p for p in parts])


def words_in(text: Column) -> Column:
    """The number of words, counted where the text is: each becomes one mark, blanks go."""
    marks = F.regexp_replace(text, WORD, "#")
    return F.coalesce(F.char_length(F.translate(marks, BLANKS, "")), F.lit(0)).cast("long")


def with_sizes(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` under internal column names and ``size``, the number of words."""
    sealed = seal(docs)
    text = F.col(sealed.column(text_col)).cast("string")
    return sealed.frame.withColumn("size", words_in(text))


def mix(
    sized: DataFrame,
    id_name: str,
    source_name: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The draws of a mix, and a row for each source.

    ``sized`` has ``size``. Draws: its columns and source_size, target, epoch (0 and up),
    shard, place (orders the rows of a shard) and words, the words taken. A document is drawn
    at most once an epoch. Sources: source, source_size, target, taken.
    """
    source = F.col(source_name).cast("string")
    keyed = sized.withColumns(
        {
            "_source": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
            "_draw": F.pmod(_hash(seed, F.col(id_name), "block"), F.lit(1 << 40)),
        }
    )
    spark = sized.sparkSession
    sources = _sources(keyed, weights, share, epochs, block_words)
    if not sources:
        empty = spark.createDataFrame([], "source string, source_size long, target double, taken long")
        extra = {
            "source_size": F.lit(0).cast("long"), "target": F.lit(0.0), "epoch": F.lit(0),
            "shard": F.lit(0), "place": F.lit(0).cast("long"), "words": F.lit(0).cast("long"),
        }
        return sized.withColumns(extra).where(F.lit(False)), empty
    # Written, so that Spark knows its size when it chooses how to join the rows.
    of_source = settle(
        spark.createDataFrame(
            sources, "_source string, source_size long, target double, blocks long, goal long, number int"
        ).coalesce(1)
    )
    keyed = keyed.join(of_source, "_source").withColumn("_block", F.pmod("_draw", "blocks"))
    # one row for each block and epoch, with the words before it in its source's stream
    blocks = keyed.groupBy("_source", "number", "blocks", "goal", "_block").agg(
        F.sum("size").alias("held")
    )
    stream = blocks.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    ).withColumn("order", F.struct("epoch", _hash(seed, F.col("epoch"), F.col("_block"), "stream"), "_block"))
    ahead = Window.partitionBy("_source").orderBy("order")
    taken = settle(
        stream.withColumns(
            {
                "before": F.sum("held").over(ahead) - F.col("held"),
                "rank": (F.row_number().over(ahead) - 1).cast("long"),
            }
        )
        .where((F.col("before") < F.col("goal")) & (F.col("held") > 0))
        .select("_source", "number", "_block", "epoch", "rank", "held",
                (F.col("goal") - F.col("before")).alias("room"))
    )
    quotas = {r["number"]: r["quota"] for r in taken.groupBy("number").agg((F.max("rank") + 1).alias("quota")).collect()}
    shares = _shares(spark, quotas, shards, seed)
    # Written first, so that Spark knows the size when it chooses how to join the rows.
    drawn = settle(
        taken.join(shares, ["number", "rank"]).select(
            "_source", "_block", "epoch", "shard", "room", "held"
        )
    )
    rows = keyed.join(drawn, ["_source", "_block"]).where("size > 0")
    whole = rows.where("room >= held").withColumn("words", F.col("size"))
    inside = Window.partitionBy("_source", "_block", "epoch").orderBy(
        _hash(seed, F.col(id_name), F.col("epoch"), "cut"), F.col(id_name)
    )
    cut = (
        rows.where("room < held")
        .withColumn("_until", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("words", F.least("size", F.col("room") - F.col("_until") + F.col("size")))
        .where("words > 0")
        .drop("_until")
    )
    draws = whole.unionByName(cut).withColumn(
        "place", _hash(seed, F.col("shard"), F.col("epoch"), F.col(id_name), "place")
    )
    draws = draws.select(
        *sized.columns, "source_size", "target", "epoch", "shard", "place", "words"
    )
    reported = of_source.select(
        F.when(F.col("_source") != "", F.substring(F.col("_source"), 2, 1 << 30)).alias("source"),
        "source_size", "target", F.col("goal").alias("taken"),
    )
    return draws, reported


def _sources(keyed: DataFrame, weights, share, epochs, block_words) -> list[tuple]:
    """One row for each source; what a mix is given targets for is a list of its sources."""
    found = keyed.groupBy("_source").agg(F.sum("size").alias("size")).collect()
    # by code point as UTF-8 sorts, null ("") last
    found.sort(key=lambda r: (r["_source"] == "", r["_source"].encode()))
    sizes = [r["size"] for r in found]
    each = [float(weights[i % len(weights)]) for i in range(len(found))]
    targets = water_fill(sizes, each, share * sum(sizes), float(epochs))
    return [
        (r["_source"], s, t, max(1, -(-s // block_words)), min(int(t + 0.5), epochs * s), i)
        for i, (r, s, t) in enumerate(zip(found, sizes, targets))
    ]


def _shares(spark: SparkSession, quotas: dict[int, int], shards: int, seed: int) -> DataFrame:
    """number, shard, rank: the ranks of each source's stream that a shard takes."""
    numbers = sorted(quotas)
    counts = [quotas[k] for k in numbers]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                start, stop = share_of(shard, counts, shards, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers, pa.int32()), pa.array([shard] * len(numbers), pa.int32()),
                        pa.array(start, pa.int64()), pa.array(stop, pa.int64()),
                    ],
                    ["number", "shard", "start", "stop"],
                )

    ids = spark.range(0, shards, 1, min(shards, max(1, shards * len(numbers) // 10_000)))
    runs = ids.mapInArrow(walk, "number int, shard int, start long, stop long")
    return runs.where("stop > start").select(
        "number", "shard", F.explode(F.sequence("start", F.col("stop") - 1)).alias("rank")
    )


def share_of(shard: int, quotas: Sequence[int], shards: int, seed: int) -> tuple[list[int], list[int]]:
    """Where a shard's blocks start and stop in each source's stream.

    At every node the left half of its shards draws its blocks, as many as its part of them,
    from those of all sources (multivariate hypergeometric); the right half has the rest.
    """
    start = np.zeros(len(quotas), np.int64)
    own = np.array(quotas, np.int64)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        total = int(own.sum())
        left = _hypergeometric(rng, own, total * (middle - low) // (high - low))
        if shard < middle:
            own, high = left, middle
        else:
            start, own, low = start + left, own - left, middle
    return start.tolist(), (start + own).tolist()


def _hypergeometric(rng: np.random.Generator, counts: np.ndarray, draw: int) -> np.ndarray:
    out = np.zeros(len(counts), np.int64)
    rest = int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        rest -= n
        if draw:
            out[i] = draw if not rest else _drawn(rng, n, rest, draw)
            draw -= int(out[i])
    return out


def _drawn(rng: np.random.Generator, good: int, bad: int, draw: int) -> int:
    """The generator's own range ends at 1e9; beyond it the normal curve is as good."""
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, draw)) if good else 0
    all_ = good + bad
    mean = draw * good / all_
    deviation = (mean * (bad / all_) * ((all_ - draw) / max(1, all_ - 1))) ** 0.5
    return int(np.clip(round(rng.normal(mean, deviation)), max(0, draw - bad), min(good, draw)))


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """A row for each document: doc_id, size, source_size, target, taken, first_shard, shards.

    ``first_shard`` is the output shard of its first draw, null if it is never drawn, and
    ``shards`` in how many shards it is: what the tree deals.
    """
    rows = docs.select(F.col(id_col), F.col(text_col), F.col(source_col))
    sized = settle(with_sizes(rows, text_col).select("_c0", "_c2", "size"))
    draws, sources = mix(sized, "_c0", "_c2", **options)
    dealt = F.struct("epoch", "shard").alias("dealt")
    taken = draws.select("_c0", "_c2", "size", "words", dealt, F.lit(0).alias("row"))
    none = sized.select(
        "_c0", "_c2", "size", F.lit(0).cast("long").alias("words"),
        F.lit(None).cast(taken.schema["dealt"].dataType).alias("dealt"), F.lit(1).alias("row"),
    )
    # A document's rows meet by identifier; rows that repeat all three are told apart by count.
    per = taken.union(none).groupBy("_c0", "_c2", "size").agg(
        F.sum("words").alias("taken"), F.sum("row").alias("rows"),
        F.min("dealt").alias("first"), F.collect_set("dealt.shard").alias("shards"),
    )
    each = per.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    part = F.floor(F.col("taken") / F.col("rows"))
    rest = F.col("taken") - part * F.col("rows")
    of_source = sources.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_key"), "source_size", "target"
    )
    return (
        each.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("_c2").cast("string")), F.lit("")))
        .join(of_source, "_key")
        .select(
            F.col("_c0").alias("doc_id"),
            "size",
            "source_size",
            "target",
            (part + F.when(F.col("nth") <= rest, 1).otherwise(0)).cast("long").alias("taken"),
            F.col("first.shard").cast("int").alias("first_shard"),
            F.size("shards").alias("shards"),
        )
    )


def mixed_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The mix itself: the columns of ``docs``, then mix_epoch, mix_shard, mix_place, mix_words.

    A row for each draw, together by shard and shuffled within it. Names that ``docs`` already
    has get a trailing underscore.
    """
    sealed = seal(docs)
    sized = with_sizes(docs, text_col)
    draws, _ = mix(sized, sealed.column(id_col), sealed.column(source_col), **options)
    own = {x.lower() for x in docs.columns}
    names = []
    for name in ("mix_epoch", "mix_shard", "mix_place", "mix_words"):
        while name.lower() in own:
            name += "_"
        names.append(name)
    laid = draws.select(*sealed.frame.columns, "epoch", "shard", "place", "words")
    laid = laid.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return laid.toDF(*docs.columns, *names)
