import hashlib
import re
from collections import Counter

import pytest

from pulsegrid.llm import sharding as S
from pulsegrid.llm.settings import SHARDS


def number(key):
    text = "" if key is None else str(key)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_shares_follow_the_weights():
    table = S.fill_table(SHARDS)
    sizes = Counter(table)
    share = S.TABLE_SIZE / sum(SHARDS.values())
    assert len(table) == S.TABLE_SIZE
    for shard, weight in SHARDS.items():
        assert abs(sizes[shard] - weight * share) <= weight


def test_few_slots_move_when_a_shard_leaves():
    shards = {f"s{i}": 1 for i in range(20)}
    before = S.fill_table(shards, 10007)
    after = S.fill_table({s: w for s, w in shards.items() if s != "s7"}, 10007)
    moved = sum(a != b for a, b in zip(before, after) if a != "s7")
    assert moved < 0.1 * len(before) and "s7" not in after


@pytest.mark.parametrize("shards, size", [({}, 7), ({"a": 0}, 7), ({"a": 1}, 8), ({"a": 8}, 7)])
def test_bad_parameters(shards, size):
    with pytest.raises(ValueError):
        S.fill_table(shards, size)


def test_placement(stored_docs, capsys):
    table = S.fill_table({"a": 1, "b": 2}, 101)
    named = stored_docs.withColumnRenamed("id", "slot").withColumnRenamed("words", "shard")
    placed = S.place(named, "doc_id", table)
    assert sorted(placed.columns) == sorted(named.columns)
    rows = placed.collect()
    assert len(rows) == stored_docs.count()
    for r in rows:
        assert r.slot == number(r.doc_id) % 101 and r.shard == table[r.slot]
    placed.explain("formatted")
    assert not re.search("Python|Pandas|Arrow|SortMergeJoin", capsys.readouterr().out)


def test_null_keys_can_be_spread(spark):
    table = S.fill_table({f"s{i}": 1 for i in range(8)}, 1009)
    df = spark.createDataFrame([(None, f"text {i}") for i in range(400)], "doc_id long, text string")
    assert S.place(df, "doc_id", table).select("slot").distinct().count() == 1
    assert S.place(df, "doc_id", table, spread="text").select("shard").distinct().count() == 8


def test_empty_table(no_docs):
    assert S.place(no_docs, "doc_id", S.fill_table({"a": 1}, 7)).collect() == []
