import re
import zlib
from collections import Counter
from math import exp, isclose, log, log10

import public_tokenizers
import pytest

from pulsegrid.llm import lattice_lm as L
from pulsegrid.llm.settings import LM_FILE

PATH = public_tokenizers.path(LM_FILE)


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [L.END]


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0


def slow_marginal(data, weights):
    """Sum over all segmentations, by recursion over the first piece."""
    if not data:
        return 1.0
    return sum(exp(w) * slow_marginal(data[len(p):], weights) for p, w in weights.items() if data.startswith(p))


@pytest.mark.parametrize("common", [0, 20, 1 << 18])
def test_base_and_score(docs, corpus, common):
    rows = corpus + corpus[:1]
    got = L.score(docs, PATH, common_words=common).collect()
    train = Counter(t for d, x in rows if not held(d) for t in tokens(x))
    n, v = sum(train.values()), len(train)
    pieces = Counter()
    for word, c in train.items():
        if word != L.END:
            for p in L._processor(PATH).encode(word):
                pieces[p] += c
    weights, end = L.piece_weights(pieces, train[L.END], PATH)
    assert isclose(sum(map(exp, weights.values())) + exp(end), 1, rel_tol=1e-9)
    longest = max(map(len, weights))
    want = []
    for d, x in rows:
        words = tokens(x)
        base = sum(log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in words)
        score = end + sum(L.log_marginal(("▁" + t).encode(), weights, longest) for t in words[:-1])
        want.append((d, held(d), len(words), sum(train[t] > 0 for t in words), n, base, score / log(10)))
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert tuple(a[:5]) == b[:5]
        assert isclose(a[5], b[5], rel_tol=1e-9) and isclose(a[6], b[6], rel_tol=1e-9)


def test_marginal_is_the_sum_over_segmentations():
    weights = {b"a": log(0.2), b"b": log(0.1), b"ab": log(0.3), b"aba": log(0.05), b"ba": log(0.15)}
    for data in (b"a", b"ab", b"aba", b"abab", b"bbaabab", b"abababababa"):
        assert isclose(exp(L.log_marginal(data, weights, 3)), slow_marginal(data, weights))


def test_long_words_do_not_underflow():
    weights = {b"a": log(0.001), b"aa": log(0.002)}
    assert -100_000 < L.log_marginal(b"a" * 10_000, weights, 2) < -10_000


def test_a_known_text_scores_better(spark):
    rows = [(i, "the house by the river stands in green light") for i in range(50)]
    rows += [(9001, "the house by the river"), (9002, "qzx vvkj wwpq ggh xxz")]
    got = {r.doc_id: r for r in L.score(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    assert got[9001].score > got[9002].score


def test_empty_table(no_docs):
    assert L.score(no_docs, PATH).collect() == []
