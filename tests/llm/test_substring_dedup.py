import re
from collections import Counter

import numpy as np
import pytest

from llm_compare import as_bag
from pulsegrid.llm import substring_dedup as S
from pulsegrid.llm import words as W


def brute(corpus, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in corpus]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(corpus, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, kept, len(w), len(gone)))
    return as_bag(out)


@pytest.mark.parametrize("window", [35, 12])
def test_against_all_windows(docs, corpus, window):
    got = S.remove_repeats(docs, window=window).select("doc_id", "text", "n_words", "n_removed")
    assert as_bag(got.collect()) == brute(corpus + corpus[:1], window)


def test_empty_table(no_docs):
    assert S.remove_repeats(no_docs).collect() == []


def test_equal_windows_choose_equal_stretch_offsets():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 5, 400).astype(np.uint64)
    lo, n, anchor, _ = S.stretches(hashes, np.array([0, 150, 150, 400]), 10)
    starts = np.concatenate([np.arange(a, a + b) for a, b in zip(lo, n)])
    assert sorted(starts) == [*range(141), *range(150, 391)]
    by_window = {}
    for a, b, h in zip(lo, n, anchor):
        for i in range(a, a + b):
            by_window.setdefault(tuple(hashes[i:i + 10]), set()).add(int(h))
    assert all(len(x) == 1 for x in by_window.values())


def test_segments_do_not_change_words(monkeypatch):
    data = np.frombuffer("the quick\n\tbrown é fox runs \n".encode() * 50, dtype=np.uint8)
    whole = W.split_words(data)
    monkeypatch.setattr(W, "segments", lambda d: _cuts(d, 37))
    for a, b in zip(whole, W.split_words(data)):
        assert np.array_equal(a, b)


def _cuts(data, size):
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data) and not W.SPACE[data[end - 1]]:
            end += 1
        yield start, end
        start = end
