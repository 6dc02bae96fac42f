import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm_compare import as_bag
from pulsegrid.llm import bpe
from pulsegrid.llm.settings import BPE_FILE

PATH, PATTERN = public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(seed, n):
    rng = random.Random(seed)
    letters = "abcdeth  in\n\t'sré漢語🙂019.,!ß Ａ"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(n)]


def test_like_the_library(coder, library, corpus):
    for text in fuzz(1, 300) + ["a" * 700, "the" * 300, "<|endoftext|> x"] + [t or "" for _, t in corpus]:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_appends_extend_the_table(coder, library):
    for text in fuzz(2, 40):
        data, rng = text.encode(), random.Random(len(text))
        table = bpe.PrefixTable(coder.vocabulary)
        at = 0
        while at < len(data):
            step = rng.randrange(1, 9)
            table.append(data[at:at + step])
            at += step
            assert table.tokens() == bpe.PrefixTable(coder.vocabulary, data[:at]).tokens()


def test_edits_stay_local(coder):
    rng = random.Random(8)
    table = bpe.PrefixTable(coder.vocabulary, (" ".join(fuzz(9, 20))).encode())
    for _ in range(60):
        a = rng.randrange(len(table.data))
        b = min(len(table.data), a + rng.randrange(6))
        new = rng.choice([b"", b"the", b"x", "é".encode(), b"  "])
        done = table.replace(a, b, new)
        assert table.last == bpe.PrefixTable(coder.vocabulary, table.data).last
        assert done <= len(new) + 40 * coder.vocabulary.longest


def test_every_row(docs, corpus, library):
    got = bpe.encode(docs, PATH, PATTERN).collect()
    want = []
    for i, t in corpus + corpus[:1]:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert as_bag((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in got) == as_bag(want)


def test_cache_limit_changes_nothing(monkeypatch, coder):
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 3)
    small = bpe.Codec(PATH, PATTERN)
    small.pieces = bpe.Pieces(small.vocabulary, 3000)
    for text in fuzz(4, 30):
        assert small.encode(text) == coder.encode(text)
        assert len(small.pieces) < 20 and small.vocabulary.pairs <= 3


def test_empty_table(no_docs):
    assert bpe.encode(no_docs, PATH, PATTERN).collect() == []
