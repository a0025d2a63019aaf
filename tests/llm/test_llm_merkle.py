import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_data import documents
from pyspark.sql import functions as F

from monthtide.llm import merkle_manifest
from monthtide.llm.merkle_manifest import FIELDS, build_manifest, fold, manifest_audit


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests, arity):
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, x in enumerate(at):
            low = x - x % arity
            paths[i].append(("".join(digests[low:x]), "".join(digests[x + 1 : low + arity])))
        digests = [sha("".join(digests[i : i + arity])) for i in range(0, len(digests), arity)]
        at = [x // arity for x in at]
    return digests[0], paths


def brute(rows, arity=3):
    """(row, leaf, subroot, root, path) of every row (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((leaf_of(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[g] = tree([leaf for leaf, _ in groups[g]], arity)
    root, upper = tree([trees[g][0] for g in order], arity)
    for g, onward in zip(order, upper):
        for (leaf, row), path in zip(groups[g], trees[g][1]):
            yield row, leaf, trees[g][0], root, path + onward


def audited(rows):
    out = []
    for row, leaf, subroot, root, path in brute(rows):
        text = row[4]
        if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        node = leaf_of((*row[:4], text))
        for left, right in path:
            node = sha(left + node + right)
        proof = sha("".join(a + b for a, b in path))
        out.append((row[0], leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*FIELDS).collect()]


def some_documents(spark, n, sources):
    rng = random.Random(n)
    text = lambda: rng.choice([None, "", "a\nb\n", "ü\n" * 5, "plain", "-", "0:"])
    rows = [(i, text(), rng.choice(["en", None]), rng.choice(sources)) for i in range(n)]
    rng.shuffle(rows)
    # rows that repeat, wholly or in their identifier; rows without identifier
    rows += [rows[0], rows[0], (rows[-1][0], "other\n", None, rows[-1][3]), (None, "x\ny", "en", "s"), (None, None, None, None)]
    return documents(spark, rows)


@pytest.mark.parametrize(
    "n, sources, small",
    [(1, ["s"], 20_000), (40, ["s", None, "", "é", "Z", "=", "one"], 20_000), (200, [f"s{i}" for i in range(30)], 10)],
)
def test_audit(spark, monkeypatch, n, sources, small):
    monkeypatch.setattr(merkle_manifest, "SMALL", small)
    docs = some_documents(spark, n, sources).repartition(5)
    got = sorted(map(tuple, manifest_audit(docs).collect()), key=str)
    assert got == audited(rows_of(docs))


@pytest.mark.parametrize("arity", [2, 4])
def test_other_arities(spark, arity):
    docs = some_documents(spark, 60, ["a", "b", "c"])
    made = build_manifest(docs, arity=arity)
    want = sorted((leaf, subroot) for _, leaf, subroot, _, _ in brute(rows_of(docs), arity))
    assert sorted(map(tuple, made.rows.select("leaf", "subroot").collect())) == want
    assert made.root == next(brute(rows_of(docs), arity))[3]
    folded = made.rows.select(fold(F.col("leaf"), F.col("path")).alias("top")).distinct().collect()
    assert [r.top for r in folded] == [made.root]
    made.work.remove()
    with pytest.raises(ValueError):
        build_manifest(docs, arity=1)


def test_lone_row_and_empty_table(spark):
    docs = documents(spark, [(1, "a\n")])
    row = manifest_audit(docs).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
    empty = manifest_audit(docs.where("false"))
    assert empty.columns == manifest_audit(docs).columns and empty.count() == 0


def test_null_and_empty_differ_and_long_text(spark):
    docs = documents(spark, [(1, None), (1, ""), (2, "é\n" * 2_000_000)])
    got = sorted(map(tuple, manifest_audit(docs).collect()), key=str)
    assert got == audited(rows_of(docs)) and len({r[1] for r in got}) == 3
