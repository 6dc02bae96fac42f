import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_compare import as_bag
from pulsegrid.llm import exact_search as X

SCHEMA = "vec_id long, embedding array<double>, dims int, score string"


def by_hand(rows, top, every=10):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    valid = [(i, whole(v)) for i, v in rows if whole(v) is not None]
    out = []
    for q, a in valid:
        if q is None or q % every:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in valid
                       if i != q and len(a) == len(b))
        out += [(q, k + 1, None if absent else i, -s) for k, (s, absent, i) in enumerate(found[:top])]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(4)


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0, 1) * spread ** d for d in range(dims)] for _ in range(n)]


@pytest.mark.parametrize("dims, spread", [(20, 1.0), (64, 0.9), (3, 1.0)])
def test_random(spark, dims, spread):
    rows = list(enumerate(vectors(dims, 700, dims, spread)))
    out = X.top_matches(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert as_bag(out.collect()) == as_bag(by_hand(rows, 5))


def test_ties_copies_and_odd_rows(spark):
    base = vectors(1, 40, 12)
    rows = list(enumerate(base + base + [base[0]] * 300))
    rows += [(1000, None), (1010, []), (1020, []), (1030, [float("nan")] * 12), (1040, [None] + [1.0] * 11),
             (1050, [float("inf")] * 12), (1060, [0.0] * 12), (1070, [-0.001] * 12), (1080, [1.0] * 5),
             (None, base[3]), (None, None), (20, base[5]), (20, base[5]), (31, base[6])]
    out = X.top_matches(table(spark, rows), F.col("vec_id") % 10 == 0, top=7)
    assert as_bag(out.collect()) == as_bag(by_hand(rows, 7))


def test_several_passes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_ROWS", 16)
    rows = list(enumerate(vectors(4, 300, 16)))
    out = X.top_matches(table(spark, rows), F.col("vec_id") % 10 == 0, pass_values=100)
    assert as_bag(out.collect()) == as_bag(by_hand(rows, 5))


def test_large_numbers_are_exact_or_refused(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 20 for _ in range(9)]) for i in range(120)]
    out = X.top_matches(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert as_bag(out.collect()) == as_bag(by_hand(rows, 5))
    huge = table(spark, [(0, [1e30, 1.0]), (1, [1.0, 1.0])])
    with pytest.raises(Exception, match="too large|64 bits"):
        X.top_matches(huge, F.col("vec_id") % 10 == 0).collect()


def test_candidates_are_dropped_early():
    """Most candidates go before their last dimensions are read, and none that belongs to the best."""
    rng = np.random.default_rng(1)
    data = np.floor(256 * rng.normal(size=(5000, 64)) * 0.95 ** np.arange(64)).astype(np.int64)
    ids = np.arange(5000)
    block = X.Block(ids, np.zeros(5000, bool), data.T)
    search = X.Search(X.Block(ids[:20], np.zeros(20, bool), data[:20].T), 5)
    merged = []
    inner = search._merge
    search._merge = lambda q, s, i, a: (merged.append(len(s)), inner(q, s, i, a))
    search.add(block)
    assert sum(merged) < 0.2 * 20 * 5000
    scores = data[:20] @ data.T
    for q in range(20):
        scores[q, q] = -1 << 60
        want = np.lexsort((ids, -scores[q]))[:5]
        assert search.best[q][1].tolist() == want.tolist()


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert X.top_matches(none, F.col("vec_id") % 50 == 0).collect() == []
    few = spark.createDataFrame([(1, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert X.top_matches(few, F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert X.top_matches(one, F.col("vec_id") % 50 == 0).collect() == []
