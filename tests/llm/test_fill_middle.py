import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_compare import as_bag
from pulsegrid.llm import fill_middle as M


def by_hand(key, text, transformed=90, suffix_first=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < suffix_first:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9, 64, 1000, 30_000])
def test_every_rank_is_reached(size):
    rng = random.Random(size)
    widths = [rng.choice((1, 1, 1, 4, 300)) for _ in range(size)]
    ends = np.cumsum(widths, dtype=np.int64)
    chain = M.SkipList(ends)
    for rank in {0, size, *(rng.randrange(size + 1) for _ in range(200))}:
        assert chain.offset(rank) == sum(widths[:rank])
    assert len(chain.units[-1]) < M.TOP_LANE or size < M.TOP_LANE
    if size > 1000:
        steps = [len(u) for u in chain.units]
        assert len(steps) > 4 and sum(steps) < 1.4 * size


def test_units():
    for text in ("", "a", "ab cd", "é1a2\n\n🙂Zz漢字x", "<P", "A" * 5000 + " b", "ſKKa"):
        ends = M.unit_ends(text).tolist()
        cuts = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
        assert ends == cuts


def test_rows(docs, corpus):
    out = M.transform(docs)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = [(i, *by_hand("" if i is None else i, t)) for i, t in corpus + corpus[:1]]
    assert as_bag(out.collect()) == as_bag(want)


def test_restored(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("<PSM> ab\né🙂") for _ in range(rng.randrange(40))) for _ in range(400)]
    texts += ["<", "<<", "P>", "<P>x", "a<M>", "<S", "S><P", "", None, "x" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = M.transform(docs).withColumn("again", M.restore(F.col("output"), F.col("form")))
    rows = out.collect()
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert r.again == (texts[r.doc_id] or "")


def test_parameters_and_text_ids(spark):
    docs = spark.createDataFrame([(f"k{i}", "one two three") for i in range(300)], "name string, body string")
    out = M.transform(docs, "name", "body", transformed=100, suffix_first=100)
    assert out.columns[0] == "name" and {r.form for r in out.collect()} == {"spm"}
    plain = M.transform(docs, "name", "body", transformed=0)
    assert {(r.form, r.output, r.prefix_chars) for r in plain.collect()} == {("plain", "one two three", None)}


def test_empty_table(no_docs):
    assert M.transform(no_docs).collect() == []
