import pytest

from pulsegrid.llm import language as G

WORDS = {"en": "the house and the river with green light", "de": "das haus und der fluss mit grünem licht",
         "fr": "la maison et la rivière avec une lumière verte"}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"{w} {i} {w}", lang, "x") for lang, w in WORDS.items() for i in range(50)]
    return spark.createDataFrame(rows + [(None, "en", "x"), ("x", None, "x")], "text string, lang string, host string")


def page(lang, text):
    return f"<html lang='{lang}'><script>the the</script><body><p>{text}</p></body></html>"


def identified(spark, rows, labelled):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, p int")
    return {r.page_id: r for r in G.identify(df, labelled).collect()}


def test_text_decides_over_a_wrong_declaration(spark, labelled):
    rows = [(i, f"http://h{i}.example.com/", page("en", WORDS["de"])) for i in range(5)]
    rows += [(10 + i, "http://e.example.com/", page("en", WORDS["en"])) for i in range(20)]
    got = identified(spark, rows, labelled)
    assert {got[i].lang for i in range(5)} == {"de"} and {got[10 + i].lang for i in range(20)} == {"en"}


def test_host_and_suffix_decide_without_text(spark, labelled):
    rows = [(i, "http://a.site.fr/x", page("", WORDS["fr"])) for i in range(20)]
    rows += [(100 + i, "http://b.other.de/x", page("", WORDS["de"])) for i in range(20)]
    rows += [(500, "http://a.site.fr/y", ""), (501, "http://new.site.fr/", None), (502, "http://z.third.de/", "<p>12</p>")]
    got = identified(spark, rows, labelled)
    assert (got[500].lang, got[501].lang, got[502].lang) == ("fr", "fr", "de")
    assert got[500].probability > got[501].probability


def test_declaration_decides_alone(spark, labelled):
    rows = [(i, None, page(lang, WORDS[lang])) for i, lang in enumerate(["en", "de", "fr"] * 10)]
    got = identified(spark, [*rows, (99, None, page("de", ""))], labelled)
    assert got[99].lang == "de" and got[99].declared == "de"


def test_held_out_accuracy(spark, labelled):
    rows = [(i, "http://x.example.com/", page("", f"{w.upper()} {n}")) for n in range(10)
            for i, w in enumerate(WORDS.values(), 3 * n)]
    got = identified(spark, rows, labelled)
    assert [got[i].lang for i in range(30)] == ["en", "de", "fr"] * 10
    assert all(0.9 < r.probability <= 1 for r in got.values())


def test_nulls_repeats_and_empty_tables(spark, labelled):
    rows = [(None, None, None), (1, "no address", ""), (2, "http://h/", "x"), (2, "http://h/", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert G.identify(df, labelled).count() == 4
    unlabelled = G.identify(df, labelled.limit(0)).collect()
    assert len(unlabelled) == 4 and all(r.lang is None for r in unlabelled)
    assert G.identify(df.limit(0), labelled).collect() == []


def test_against_a_plain_posterior(spark, labelled):
    """The same evidence fused page by page in plain loops."""
    import math
    import re
    from collections import defaultdict

    import numpy as np

    pages = [("http://a.site.de/x", page("de", WORDS["de"])), ("http://a.site.de/y", page("en", "lumière und green")),
             ("https://b.site.de:80/fr/q", page("fr", WORDS["fr"])), ("http://other.com", "<p>" + WORDS["en"]),
             ("http://other.com", "<p>" + WORDS["en"]), (None, page("xx", "")), ("ftp", None), ("http://c.fr/en/", "zz")]
    names, share = G.train(labelled)
    size = len(names)
    rows = []
    for url, source in pages:
        host = (re.match(r"[a-zA-Z]+://([^/:?#]+)", url or "") or [None, ""])[1].lower()
        part = (re.match(r"[a-zA-Z]+://[^/?#]+/([a-zA-Z]{2})(?:[/?#]|$)", url or "") or [None, ""])[1].lower()
        said = re.search(G.DECLARED, source or "")
        data = np.frombuffer(G.visible(source or "").encode(), dtype=np.uint8)
        at = G.trigrams(data) if len(data) > 2 else []
        ll = [sum(share[k][i] for i in at) * min(1.0, G.EVIDENCE / max(len(at), 1)) for k in range(size)]
        p = [math.exp(x - max(ll)) for x in ll]
        top = re.search(r"[^.]+$", host)
        # a missing address gives no host, domain or address part, but not an empty suffix text
        ending = [top[0] if top else ""] + ([part] if url is not None else [])
        if url is None:
            keys = {"domain": None, "host": None, "suffix": ""}
        else:
            domain = re.search(r"([^.]+\.)?[^.]+$", host)
            keys = {"domain": domain[0] if domain else "", "host": host, "suffix": "/".join(ending)}
        rows.append({"ll": ll, "p": [x / sum(p) for x in p], "said": said[1].lower() if said else "", **keys})
    sums = {key: defaultdict(lambda: [0.0] * size) for key in ("said", "suffix", "domain", "host")}
    for r in rows:
        for key, table in sums.items():
            table[r[key]] = [a + b for a, b in zip(table[r[key]], r["p"])]
    overall = [sum(r["p"][k] for r in rows) for k in range(size)]
    base = [(x + G.SMOOTH) / (sum(overall) + G.SMOOTH * size) for x in overall]

    def smoothed(counts, less, towards, kappa):
        left = [max(a - b, 0.0) for a, b in zip(counts, less)]
        return [(a + kappa * t) / (sum(left) + kappa) for a, t in zip(left, towards)]

    got = identified(spark, [(i, *x) for i, x in enumerate(pages)], labelled)
    for i, r in enumerate(rows):
        prior = smoothed(sums["domain"][r["domain"]], r["p"], base, G.KAPPA_DOMAIN)
        prior = smoothed(sums["host"][r["host"]], r["p"], prior, G.KAPPA_HOST)
        logs = [a + math.log(b + 1e-12) for a, b in zip(r["ll"], prior)]
        for key in ("said", "suffix"):
            if r[key]:
                logs = [a + math.log((c + G.SMOOTH) / (n + 1.0 + G.SMOOTH))
                        for a, c, n in zip(logs, sums[key][r[key]], overall)]
        post = [math.exp(x - max(logs)) for x in logs]
        post = [x / sum(post) for x in post]
        assert got[i].probability == pytest.approx(max(post), rel=1e-6), i
        assert post[names.index(got[i].lang)] == pytest.approx(max(post), rel=1e-6), i
