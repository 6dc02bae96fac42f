import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from llm_compare import as_bag, sentence
from pulsegrid.llm import resampling as R


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in runs]


def by_hand(docs, goals, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(grams(text)[1])
    for text in goals:
        t.update(grams(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows, able = [], []
    for i, text in docs:
        n, codes = grams(text)
        weight = sum(gain[c] for c in codes)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(codes), weight, score))
        if n >= least:
            able.append((-score, i is None, i or 0, len(rows) - 1))
    drawn = {row: k + 1 for k, (*_, row) in enumerate(sorted(able)[:percent * len(able) // 100])}
    return [(*r, drawn.get(k)) for k, r in enumerate(rows)]


@pytest.fixture(scope="module")
def goals(spark):
    import random
    rng = random.Random(8)
    texts = [sentence(rng, 30) for _ in range(9)] + [None, "", "The RIVER, the river!"]
    return texts, spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, features long")


def test_ngrams():
    pattern = R.ngram_pattern(3)
    for text in ("", " ", "a", "Ab  cD", "x,y;z 1é\x7f2 漢字\x00ÄÖ", "a b c d e f", "K K", "__" * 9, "w " * 5000):
        n, codes = R.hashed_ngrams(text, pattern, 10000)
        want_n, want = grams(text)
        assert n == want_n and sorted(codes.tolist()) == sorted(want)


def test_spans_are_overlapped():
    spans = [m.span() for m in R.ngram_pattern(2).finditer(b"ab c def", overlapped=True)]
    assert spans == [(0, 4), (3, 8), (5, 8)]


def test_rows(docs, corpus, goals):
    rows = corpus + corpus[:1]
    out = R.resample(docs, goals[1], percent=60)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got, want = [tuple(r) for r in out.collect()], by_hand(rows, goals[0], 60)
    assert as_bag(r[:4] for r in got) == as_bag(r[:4] for r in want)
    assert as_bag(got) == as_bag(want)
    assert sum(r[4] is not None for r in got) > 20


def test_ties_go_to_smaller_ids(spark, goals, monkeypatch):
    text = "one two three four five six " * 5
    docs = spark.createDataFrame([(7, text)] * 40 + [(3, text)] * 40 + [(None, text)] * 20, "doc_id long, text string")
    rows = R.resample(docs.repartition(7), goals[1], percent=70).collect()
    ranks = sorted(r.rank for r in rows if r.rank)
    assert ranks == list(range(1, 71)) and len(rows) == 100
    best = sorted(rows, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))[:70]
    assert Counter(r.doc_id for r in best) == Counter(r.doc_id for r in rows if r.rank)


def test_other_sizes(spark, goals):
    docs = spark.createDataFrame([(f"d{i}", f"river stone {i} light") for i in range(30)], "name string, body string")
    out = R.resample(docs, goals[1], "name", "body", buckets=1 << 17, max_words=1, min_words=1, percent=50)
    rows = out.collect()
    assert {r.n_features for r in rows} == {4} and sorted(r.rank for r in rows if r.rank) == list(range(1, 16))


def test_empty_tables(spark, no_docs, goals, docs):
    assert R.resample(no_docs, goals[1]).collect() == []
    none = spark.createDataFrame([], "text string")
    assert R.resample(docs, none).count() == docs.count()
    assert R.resample(no_docs, none).collect() == []


def test_query(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op13_resampling"](spark, sf)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert as_bag(got.collect()) == as_bag(by_hand(docs, texts))
