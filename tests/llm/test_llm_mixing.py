import random
from collections import defaultdict

import numpy as np
import pytest
from llm_data import documents, sentence, words
from pyspark.sql import functions as F

from monthtide.llm.mixing import (
    SEED,
    _hash,
    _hypergeometric,
    mixed_documents,
    mixed_shards,
    share_of,
    water_fill,
)


def corpus(n=150):
    rng = random.Random(5)
    rows = [
        (i, sentence(rng, rng.randrange(1, 80)), "en", f"s{rng.choice([0, 0, 0, 1, 2, 3])}")
        for i in range(n)
    ]
    rows += [(n, None, None, "s1"), (n + 1, "", None, None), (n + 2, " one\ntwo\x0b", None, None)]
    rows += [(n + 3, None, "en", "empty"), (3, rows[3][1], "en", rows[3][3]), (None, "a b c", None, "É")]
    return rows


def test_water_fill():
    assert water_fill([100, 100, 100], [3, 1, 2], 450, 2) == pytest.approx([200, 250 / 3, 500 / 3])
    assert water_fill([10, 1000], [3, 1], 1515, 2) == pytest.approx([20, 1495])
    assert water_fill([0, 10], [3, 1], 15, 2) == [0, 15]
    assert water_fill([], [], 0, 2) == []


@pytest.mark.parametrize("block_words", [10, 200_000])
def test_contract(spark, block_words):
    rows = corpus()
    docs = documents(spark, rows)
    got = mixed_documents(docs, block_words=block_words).collect()
    assert sorted((r.doc_id, r["size"]) for r in got if r.doc_id is not None) == sorted(
        (i, len(words(t))) for i, t, *_ in rows if i is not None
    )
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None]
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    want = dict(zip(order, water_fill([sizes[s] for s in order], weights, 1.5 * sum(sizes.values()), 2)))
    source = {i: s for i, _, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= 0.5
    again = mixed_documents(docs.repartition(7), block_words=block_words).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_shards(spark):
    docs = documents(spark, corpus())
    got = mixed_shards(docs, block_words=20, shards=8)
    assert got.columns == [*docs.columns, "mix_epoch", "mix_shard", "mix_place", "mix_words"]
    rows = got.collect()
    assert {r.mix_shard for r in rows} <= set(range(8)) and len({r.mix_shard for r in rows}) > 4
    assert all(0 < r.mix_words <= len(words(r.text)) for r in rows)
    # a document once an epoch, but for the row that is there twice
    seen = [(r.doc_id, r.mix_epoch) for r in rows]
    assert len(seen) - len(set(seen)) <= 2
    clash = docs.withColumnRenamed("words", "MIX_shard")
    assert mixed_shards(clash).columns[-3:] == ["mix_shard_", "mix_place", "mix_words"]


def test_shares_are_disjoint_and_whole():
    quotas = [17, 0, 250, 3]
    for shards in (1, 2, 7, 64):
        at = [0] * 4
        for shard in range(shards):
            start, stop = share_of(shard, quotas, shards, 1)
            assert start == at
            at = stop
        assert at == quotas
        sizes = [sum(b - a for a, b in zip(*share_of(k, quotas, shards, 1))) for k in range(shards)]
        assert max(sizes) - min(sizes) <= shards.bit_length()


def test_draws_are_hypergeometric():
    rng = np.random.default_rng(0)
    draws = np.array([_hypergeometric(rng, np.array([30, 10, 60]), 20) for _ in range(4000)])
    assert (draws.sum(1) == 20).all() and (draws <= [30, 10, 60]).all()
    assert draws.mean(0) == pytest.approx([6, 2, 12], abs=0.15)
    assert draws[:, 0].var() == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.1)
    big = _hypergeometric(rng, np.array([4 * 10**9, 6 * 10**9]), 10**9)
    assert big.sum() == 10**9 and abs(big[0] - 4 * 10**8) < 10**6


def test_empty_tables(spark):
    docs = documents(spark, corpus())
    assert mixed_documents(docs.where("false")).count() == 0
    assert mixed_shards(docs.where("false")).count() == 0
    nothing = documents(spark, [(1, None), (2, " ")])
    assert [r.taken for r in mixed_documents(nothing).collect()] == [0, 0]
    assert mixed_shards(nothing).count() == 0


@pytest.mark.parametrize("shards", [1, 5, 64])
def test_shards_of_documents_follow_from_the_tree(spark, shards):
    """Worked out anew: blocks by hash, streams in order, quotas by target, ranks by the tree."""
    rows = [r for r in corpus(400) if r[0] is not None and r[0] < 400 and r[0] != 3]
    docs = documents(spark, rows)
    block_words, epochs = 60, 2
    got = {r.doc_id: r for r in mixed_documents(docs, block_words=block_words, shards=shards).collect()}

    size = {i: len(words(t)) for i, t, *_ in rows}
    sizes = defaultdict(int)
    for i, _, _, s in rows:
        sizes[s] += size[i]
    order = sorted(sizes, key=lambda s: s.encode())
    targets = water_fill([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)
    blocks = {s: max(1, -(-sizes[s] // block_words)) for s in order}
    frame = spark.createDataFrame([(i, blocks[s]) for i, _, _, s in rows], "id long, blocks long")
    place = F.pmod(F.pmod(_hash(SEED, F.col("id"), "block"), F.lit(1 << 40)), "blocks")
    block_of = {r.id: r.block for r in frame.select("id", place.alias("block")).collect()}
    held = defaultdict(int)
    for i, _, _, s in rows:
        held[s, block_of[i]] += size[i]
    keys = [(e, b) for e in range(epochs) for b in range(max(blocks.values()))]
    hashed = spark.createDataFrame(keys, "epoch int, block long").select(
        "epoch", "block", _hash(SEED, F.col("epoch"), F.col("block"), "stream").alias("h")
    )
    h = {(r.epoch, r.block): r.h for r in hashed.collect()}
    streams = {}
    for s, target in zip(order, targets):
        goal, before, stream = min(int(target + 0.5), epochs * sizes[s]), 0, []
        own = [b for t, b in held if t == s]
        for e, b in sorted(((e, b) for e in range(epochs) for b in own), key=lambda x: (x[0], h[x], x[1])):
            if before < goal:
                stream.append((e, b))
            before += held[s, b]
        while stream and not held[s, stream[-1][1]]:
            stream.pop()
        streams[s] = stream
    shard_of = {}
    for shard in range(shards):
        start, stop = share_of(shard, [len(streams[s]) for s in order], shards, SEED)
        for s, a, b in zip(order, start, stop):
            for e, block in streams[s][a:b]:
                shard_of[s, e, block] = shard
    for i, _, _, s in rows:
        drawn = [(e, shard_of[s, e, block_of[i]]) for e in range(epochs) if (s, e, block_of[i]) in shard_of]
        r = got[i]
        last = streams[s][-1]
        cut = any((e, block_of[i]) == last for e, _ in drawn)
        if size[i] and drawn and not cut:
            assert r.first_shard == min(drawn)[1] and r.shards == len({x for _, x in drawn})
        elif not drawn or not size[i]:
            assert r.first_shard is None and r.shards == 0 and r.taken == 0
    assert {r.first_shard for r in got.values()} - {None} <= {*shard_of.values()}
