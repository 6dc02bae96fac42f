import random
import re

import pytest

from llm_compare import as_bag, sentence
from pulsegrid.llm import decontamination as D


def shingles(text, size=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    n = max(len(words) - size + 1, min(len(words), 1))
    return {" ".join(words[i:i + size]) for i in range(n)}


def brute(docs, items, threshold=0.8):
    out = set()
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            need = shingles(item)
            if need and len(need & have) >= threshold * len(need) - 1e-9:
                out.add((d, i, len(need & have), len(need)))
    return out


@pytest.fixture(scope="module")
def items():
    rng = random.Random(11)
    texts = [sentence(rng, n) for n in (5, 6, 9, 12, 20, 33, 64, 65, 100, 3)]
    return list(enumerate(texts)) + [(20, texts[0]), (21, None), (22, ""), (23, "a b c d"), (None, texts[4])]


@pytest.fixture(scope="module")
def tainted(corpus, items):
    rng = random.Random(12)
    out = []
    for n, (_, item) in enumerate(items):
        words = (item or "").split()
        if not words:
            continue
        for k, cut in enumerate((0, 1, 2, len(words) // 5, len(words) // 4, len(words) // 2)):
            text = f"{sentence(rng, 40)} {' '.join(words[cut:]).upper()}, {sentence(rng, 40)}"
            out.append((10_000 + 10 * n + k, text))
        out.append((20_000 + n, " ".join(words)))
        holes = words[:]
        holes[len(words) // 2] = "changed"
        out.append((30_000 + n, sentence(rng, 9) + " " + " ".join(holes)))
    return corpus + out


def frame(spark, rows, id_col):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], f"{id_col} long, text string, item string, hash int")


def test_against_all_pairs(spark, tainted, items):
    got = D.contained(frame(spark, tainted, "doc_id"), frame(spark, items, "item_id"))
    got = got.select("doc_id", "item_id", "n_shared", "n_item").collect()
    want = brute(tainted, items)
    assert {tuple(r) for r in got} == want and len(want) > 30


def test_shuffled_when_the_benchmark_is_large(spark, tainted, items, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    got = D.contained(frame(spark, tainted, "doc_id"), frame(spark, items, "item_id"))
    assert {tuple(r)[:2] for r in got.collect()} == {w[:2] for w in brute(tainted, items)}


def test_clean_keeps_the_rest(spark, tainted, items):
    docs = frame(spark, tainted, "doc_id")
    got = D.clean(docs, frame(spark, items, "item_id"))
    assert got.columns == docs.columns
    found = {tuple(sorted(shingles(t))) for d, t in tainted if brute([(d, t)], items)}
    want = [(d, t, "x", 1) for d, t in tainted if tuple(sorted(shingles(t))) not in found]
    assert as_bag(got.collect()) == as_bag(want)


def test_main_path_is_native(stored_docs, spark, items, tmp_path, capsys):
    frame(spark, items, "item_id").write.parquet(f"{tmp_path}/items")
    D.contained(stored_docs, spark.read.parquet(f"{tmp_path}/items")).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_empty_tables(spark, no_docs, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contained(docs, none).collect() == []
    assert D.contained(no_docs, none).collect() == []
    assert D.clean(docs, none).count() == docs.count()
