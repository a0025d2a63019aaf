import hashlib
from collections import defaultdict

import pytest
from llm_data import ascii_lower, documents

from monthtide.llm.exact_dedup import content_sort, drop_copies

ROWS = [
    (1, "Same text"), (2, "same TEXT"), (3, "same  text"), (4, None), (5, ""), (6, None),
    (7, "É"), (8, "é"), (9, "x" * 300_000), (10, "X" * 300_000), (10, "X" * 300_000),
    (None, "same text"), (None, "only"), (None, "only"), (11, "\x00a"), (12, " "),
]


def expected(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[ascii_lower(text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("hot_share", [0.001, 0.3])
def test_against_groups(spark, keep, hot_share):
    got = content_sort(documents(spark, ROWS), keep=keep, hot_share=hot_share).collect()
    assert sorted([(r[0], r[1], r[2], r[4]) for r in got], key=str) == expected(ROWS, keep == "largest")
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_hot_text_is_salted(spark):
    rows = [(i, "hot") for i in range(500)] + [(1000 + i, f"t{i}") for i in range(500)]
    got = content_sort(documents(spark, rows), hot_share=0.01)
    hot = got.where("group_size > 1")
    assert hot.count() == 500 and hot.where("kept").count() == 1
    assert hot.select("keep_id", "group_size").distinct().collect() == [(0, 500)]
    assert got.where("kept").count() == 501


@pytest.mark.parametrize("ids", [[None], [7], [7, None], [3, 3, 9, 9, None]])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_a_hot_text_whose_identifiers_repeat_or_lack(spark, ids, keep):
    rows = [(ids[i % len(ids)], "hot") for i in range(600)] + [(1000 + i, f"t{i}") for i in range(300)]
    got = content_sort(documents(spark, rows), keep=keep, hot_share=0.01)
    hot = got.where("group_size > 1").collect()
    known = [i for i in ids if i is not None]
    want = (max if keep == "largest" else min)(known) if known else None
    assert len(hot) == 600 and {(r.keep_id, r.group_size) for r in hot} == {(want, 600)}
    assert [r.doc_id for r in hot if r.kept] == [want]


def test_dropping_keeps_columns_and_rows(spark):
    docs = documents(spark, ROWS)
    got = drop_copies(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(
        [1, 3, 4, 7, 8, 9, None, 11, 12], key=str
    )
    assert got.where("doc_id = 1").first().text == "Same text"


def test_empty_table(spark):
    docs = documents(spark, ROWS).where("false")
    assert content_sort(docs).count() == 0 and drop_copies(docs).count() == 0


def test_native_and_one_range_exchange(spark, capsys):
    plan = content_sort(documents(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    with pytest.raises(ValueError):
        content_sort(documents(spark, ROWS), keep="any")
    with pytest.raises(ValueError):
        content_sort(documents(spark, ROWS), hot_share=0)
