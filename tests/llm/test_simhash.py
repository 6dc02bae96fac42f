import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from llm_compare import as_bag
from pulsegrid.llm import simhash as S
from pulsegrid.llm.components import components


def slow_print(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    size = min(shingle, len(words))
    grams = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(rows, bits=4):
    prints = [slow_print(t) for _, t in rows]
    groups = slow_groups(prints, bits)
    least = {}
    for (doc, _), g in zip(rows, groups):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [(doc, p, least.get(g)) for (doc, _), p, g in zip(rows, prints, groups)]


def test_against_all_pairs(docs, corpus):
    got = S.near_duplicates(docs).collect()
    want = expected(corpus + corpus[:1])
    assert as_bag((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == as_bag(want)


def random_prints(rng, n):
    """Clusters around a few centres, with chains of few differing bits."""
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            out.add(x)
            for _ in range(rng.randrange(1, 7)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


def check_links(spark, prints, **more):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = dict(components(S.links(df, **more)).collect())
    ours = [roots.get(p, p) for p in signed]
    theirs = slow_groups(prints, more.get("max_bits", 4))
    assert len(set(zip(ours, theirs))) == len(set(ours)) == len(set(theirs))


def test_links_lose_no_group(spark):
    check_links(spark, random_prints(random.Random(1), 600))
    check_links(spark, random_prints(random.Random(2), 300), max_bits=2)


def test_crowded_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL_ROWS", 16)
    rng, centre = random.Random(3), random.Random(4).getrandbits(64)
    near = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)}
    check_links(spark, sorted(near | set(random_prints(rng, 100))))


def test_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch, capsys):
    rng, seen, read = random.Random(8), [], []
    rows = sorted((c, rng.getrandbits(63) >> 60) for c in range(-100, 100) for _ in range(rng.randrange(1, 30)))
    cell, fp = (np.array(x) for x in zip(*rows))
    pairs = S._pairs
    monkeypatch.setattr(S, "_pairs", lambda c, *more: seen.append(c) or pairs(c, *more))

    def batches(size):
        for i in range(0, len(cell), size):
            read.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(cell[i:i + size]), pa.array(fp[i:i + size])], names=["cell", "fp"])

    def stars(size, at_once):
        seen.clear(), read.clear()
        out = S._stars(batches(size), 1, at_once)
        return sorted((r["a"], r["b"]) for batch in out for r in batch.to_pylist())

    whole = stars(len(cell), len(cell) + 1)
    assert whole and len(seen) == 1
    for size, at_once in ((7, 50), (50, 50), (1, 1), (1000, 3)):
        assert stars(size, at_once) == whole
        assert max(map(len, seen)) <= at_once + size + 30 and sum(map(len, seen)) == len(cell)
        assert sum(len(set(c)) for c in seen) == 200  # no cell is cut
    out = S._stars(batches(7), 1, 50)
    read.clear()
    next(out)
    assert len(read) < 20  # the first links come before the rest is read
    S.links(spark.range(5).withColumnRenamed("id", "fp")).explain()
    assert re.search(r"MapInArrow.*\n.*Sort \[cell", capsys.readouterr().out)


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(6)
    values = [rng.getrandbits(64) for _ in range(40)]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    points = [r[0] % (1 << 64) for r in spark.createDataFrame(signed, "fp long").select(S.embed(S.F.col("fp"))).collect()]
    for a, p in zip(values, points):
        counts = [(a >> 2 * i & 3).bit_count() for i in range(32)]
        assert [(p >> 2 * i & 3).bit_count() for i in range(32)] == counts
        for b, q in zip(values, points):
            assert (p ^ q).bit_count() <= (a ^ b).bit_count()


def test_components_of_paths_and_rings(spark):
    path = [(i, i + 1) for i in range(300)]
    ring = [(1000 + i, 1000 + (i + 1) % 50) for i in range(50)]
    edges = path + ring + [(7, 7), (2000, 2001), (2001, 2000)]
    random.Random(1).shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)} | {2000: 2000, 2001: 2000}
    assert got == want


def test_first_of_groups(docs, corpus):
    got = S.first_of_groups(docs)
    assert got.columns == docs.columns
    groups = {}
    prints = [slow_print(t) for _, t in corpus]
    for (doc, text), g in zip(corpus, slow_groups(prints, 4)):
        groups.setdefault(g, []).append((doc is None, doc or 0, doc, text))
    firsts = {g: min(m, key=lambda x: x[:2]) for g, m in groups.items()}
    ids = [x[2] for x in firsts.values()]
    assert as_bag((r.doc_id,) for r in got.collect()) == as_bag((i,) for i in ids)


def test_empty_table(no_docs):
    assert S.near_duplicates(no_docs).collect() == []
    assert S.first_of_groups(no_docs).collect() == []


def test_any_number_of_blocks_gives_the_same(spark):
    for blocks in (8, 10):
        check_links(spark, random_prints(random.Random(blocks), 200), blocks=blocks)


def test_blocks_follow_the_number_of_prints(spark, monkeypatch):
    even = [0.375] * 32
    chosen = [S.choose_blocks(10 ** e, even) for e in range(2, 12)]
    assert chosen[0] == 7 and chosen == sorted(chosen) and chosen[-1] > 9
    assert S.choose_blocks(10 ** 8, [0.6] * 32) > S.choose_blocks(10 ** 8, even)  # coordinates that differ seldom
    assert S.blocks_for(spark.createDataFrame([], "fp long")) == 7
    seen = {}
    monkeypatch.setattr(S, "choose_blocks", lambda n, agree, bits: seen.update(n=n, agree=agree) or 7)
    rng = random.Random(5)
    prints = [rng.getrandbits(64) & rng.getrandbits(64) for _ in range(50)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    S.blocks_for(spark.createDataFrame([(p,) for p in signed], "fp long"))
    points = [[(p >> 2 * i & 3).bit_count() for i in range(32)] for p in prints]
    want = [sum(a[i] == b[i] for a in points for b in points) / 2500 for i in range(32)]
    assert seen["n"] == 50 and np.allclose(seen["agree"], want)


def test_compared_pairs_are_those_of_the_cells(spark):
    prints = random_prints(random.Random(3), 120)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for blocks in (7, 9):
        masks = [m % (1 << 64) for m in S.cell_masks(4, blocks)]
        points = [sum(((1 << (p >> 2 * i & 3).bit_count()) - 1) << 2 * i for i in range(32)) for p in prints]
        want = sum((points[i] ^ points[j]) & m == 0 for m in masks for i in range(len(points)) for j in range(i))
        assert S.pairs_compared(df, 4, blocks) == want > 0
    assert S.pairs_compared(df.limit(0)) == 0
