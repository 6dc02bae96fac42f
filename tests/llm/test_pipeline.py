import random
import re

import corpus_pipeline
import pytest

from llm_compare import as_bag, sentence
from pulsegrid.llm.queries import QUERIES
from test_decontamination import brute as leaks
from test_repetition import brute as quality
from test_secret_scan import slow_spans
from test_simhash import slow_groups, slow_print


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and benchmark, and their rows."""
    rng = random.Random(21)
    items = [(i, sentence(rng, 30)) for i in range(5)]
    texts = [sentence(rng, rng.randrange(40, 200)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[4] + " end", "bad " * 80, "short text", None, ""]
    texts += [f"{sentence(rng, 60)} {item} {sentence(rng, 60)}" for _, item in items[:3]]
    texts += [f"{sentence(rng, 60)} password=abcdef12345{i} {sentence(rng, 30)}" for i in range(4)]
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("tables"))
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def brute(rows, items):
    rows = [r for r in rows if quality(r[1])[-1]]
    groups = slow_groups([slow_print(r[1]) for r in rows], 4)
    first = {}
    for r, g in zip(rows, groups):
        first[g] = min(r, first.get(g, r), key=lambda x: x[0])
    rows = [r for r in first.values() if not leaks([(r[0], r[1])], items)]
    out = {}
    for doc, text, *_ in rows:
        parts, at = [], 0
        for a, _, b, _ in slow_spans(text):
            if a >= at:
                parts += [text[at:a], "[secret]"]
            at = max(at, b)
        out[doc] = "".join(parts) + text[at:]
    return out


def test_stages_against_brute_force(spark, tables):
    folder, rows, items = tables
    want = brute(rows, items)
    assert 30 < len(want) < len(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert [t for _, t in docs.dtypes] == ["bigint", "string", "string", "string", "bigint"], name
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_run(spark, tables):
    import numpy as np
    import public_tokenizers
    from pulsegrid.llm.bpe import Codec
    from pulsegrid.llm.settings import BPE_FILE

    folder, rows, items = tables
    coder = Codec(public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)
    got = corpus_pipeline.run(spark, folder).collect()
    assert all(r.intact and r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in got)
    assert as_bag((r.doc_id, coder.decode(bytes(r.ids)).decode()) for r in got) == as_bag(brute(rows, items).items())


def test_stages_take_empty_tables(spark, tables, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables[0])
        assert docs.collect() == []


def test_names():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES] == list(range(1, 11))
