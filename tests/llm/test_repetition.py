import random
import re
from collections import Counter

import numpy as np

from llm_compare import as_bag
from pulsegrid.llm import repetition as R


def brute(text, min_repeat=R.MIN_REPEAT):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)

    def covered(size):
        seen = Counter(tuple(words[i:i + size]) for i in range(n - size + 1))
        at = set()
        for i in range(n - size + 1):
            if seen[tuple(words[i:i + size])] > 1:
                at.update(range(i, i + size))
        return at

    longest = 0
    while longest < n and covered(longest + 1):
        longest += 1
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, words))
    repeat_chars = sum(len(words[i]) for i in covered(min_repeat))
    repeats = len(covered(3))
    failed = n < 50 or 100 * repeats > 50 * n
    kept = not failed and repeat_chars <= R.MAX_COVERED * chars and longest <= R.MAX_REPEAT
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (n, chars, symbols, len(lines) - len(set(lines)), repeats, longest, repeat_chars, failed, kept)


EXTRA = [
    "a b c # d\n" * 3 + "*é* |x| " * 20, "one two three four five six seven eight nine ten " * 2 + "z " * 55,
    " ".join(str(i) for i in range(200)) + " " + " ".join(str(i) for i in range(120)) + " "
    + " ".join(str(i) for i in range(500, 800)),
]


def test_against_windows(spark, docs, corpus):
    short = [(i, t) for i, t in corpus if len(t or "") < 12000] + [(900 + i, t) for i, t in enumerate(EXTRA)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in short], "doc_id long, text string, n_words string")
    got = R.measure(df).select("doc_id", *R.MEASURES, "base_failed", "kept").collect()
    want = [(i, *brute(t)) for i, t in short]
    assert as_bag(got) == as_bag(want)
    assert any(w[-1] for w in want)
    assert R.measure(docs).count() == len(corpus) + 1


def test_longest_limit_alone_rejects():
    m = brute(EXTRA[2])
    assert not m[-2] and not m[-1] and m[5] == 120


def numbers(first, n):
    return " ".join(str(i) for i in range(first, first + n))


def test_each_limit_rejects_alone(spark):
    line = numbers(100, 20)
    covered = "".join(f"{line}\n{numbers(1000 + 100 * i, 30)}\n" for i in range(5))
    repeat = f"{numbers(100, 60)} {numbers(1000, 400)} {numbers(100, 60)}"
    boilerplate = f"{numbers(100, 12)}\n{numbers(1000, 30)}\n{numbers(100, 12)}"
    texts = [covered, repeat, boilerplate, numbers(1000, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in R.measure(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [got[i].kept for i in range(4)] == [False, False, True, True]
    assert got[0].longest_repeat == 20 and got[0].covered_chars == 300 and 0.3 < 300 / got[0].word_chars < 0.5
    assert got[1].longest_repeat == 60 and got[1].covered_chars < 0.3 * got[1].word_chars
    assert got[2].covered_chars > 0.3 * got[2].word_chars
    assert {r.doc_id for r in R.accepted(df).collect()} == {2, 3}


def test_accepted_keeps_all_columns(docs, corpus):
    got = R.accepted(docs)
    assert got.columns == docs.columns
    judged = {r.doc_id: r.kept for r in R.measure(docs).collect() if r.doc_id is not None}
    assert {r.doc_id for r in got.collect()} - {None} == {i for i, k in judged.items() if k}


def test_suffix_ranks_of_repetitive_symbols():
    rng = random.Random(2)
    for n in (1, 2, 50, 300):
        for letters in (1, 2, 5):
            s = [rng.randrange(letters) for _ in range(n)] + [99]
            got = R.longest_repeats(np.array(s))
            for i in range(n + 1):
                best = 0
                for j in range(n + 1):
                    k = 0
                    while i != j and max(i, j) + k <= n and s[i + k] == s[j + k]:
                        k += 1
                    best = max(best, k)
                assert got[i] == best


def test_empty_table(no_docs):
    assert R.measure(no_docs).collect() == []
    assert R.accepted(no_docs).collect() == []
