"""Language of web pages by Bayesian evidence fusion.

The posterior of a language is the product of four factors, normalised:

* the likelihood of the visible text, a naive Bayes model over letter trigrams trained on labelled
  documents (a sample of about ``SAMPLE_DOCS`` per language, a parameter). Trigrams of a text depend on
  each other, so its log likelihood counts for at most ``EVIDENCE`` independent trigrams;
* the likelihood of the declared markup language (the ``lang`` of the html element);
* the likelihood of the address suffix (top-level domain, and a two-letter first path part);
* a prior of the host, smoothed towards its domain, which is smoothed towards all pages.

The last three are grouped aggregations of the text posteriors over all pages, as sums per key with map-side
combining; a page's own share is taken out of its host and domain. Tables per host, domain and suffix
grow with the pages and are joined by key; only tables over languages are small.

Defined results: null and empty html has no text evidence; a page whose address is null has its own
(null) host; a page without any evidence gets the overall prior; ties go to the first code; repeated
rows give repeated rows. Without labelled documents the language is null with probability null.
Other columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import BYTE_CODE, map_arrow, mix, runs
from pulsegrid.session import cut_lineage

BUCKETS = 1 << 16
SAMPLE_DOCS = 2000
MOST_LANGUAGES = 256
EVIDENCE = 50.0
SMOOTH = 0.5
KAPPA_DOMAIN = 10.0
KAPPA_HOST = 5.0

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1[^>]*>|\Z)|<[^>]*>", re.I | re.S)
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"

# A byte's class: letters keep their (lower) byte, all else is a blank. Bytes above 127 count as letters.
LETTER = np.full(256, 32, dtype=np.uint8)
for _b in range(256):
    if _b >= 128 or chr(_b).isalpha():
        LETTER[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def visible(source: str) -> str:
    return html.unescape(HIDDEN.sub(" ", source))


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of every trigram of bytes that starts with a letter."""
    b = LETTER[data]
    code = BYTE_CODE[b]
    three, nine = np.uint64(3), np.uint64(0x9E3779B97F4A7C15)
    key = (code[:-2] * three) ^ (code[1:-1] * nine) ^ (code[2:] * nine * nine)
    return (mix(key[b[:-2] != 32]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def train(labelled: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities [language, bucket], from (text, lang) rows.

    Each language gives about ``sample`` rows, chosen by a hash of the text.
    """
    rows = labelled.select("text", F.lower("lang").alias("lang")).where("text IS NOT NULL AND lang <> ''")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    found = sorted((r.lang, r.n) for r in sizes.limit(MOST_LANGUAGES + 1).collect())
    if len(found) > MOST_LANGUAGES:
        raise ValueError("too many languages; group the labels first")
    names = [lang for lang, _ in found]
    if not names:
        return [], np.zeros((0, BUCKETS))
    shares = F.create_map(*[F.lit(x) for lang, n in found for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003.0
    chosen = rows.where(draw < F.element_at(shares, F.col("lang")))

    def over(batches):
        counts = np.zeros((len(names), BUCKETS), dtype=np.int64)
        for batch in batches:
            rank = [names.index(x) for x in batch.column("lang").to_pylist()]
            for first, data, offsets in runs(batch.column("text")):
                for i in range(len(offsets) - 1):
                    at = trigrams(data[offsets[i]:offsets[i + 1]]) if offsets[i + 1] - offsets[i] > 2 else []
                    counts[rank[first + i]] += np.bincount(at, minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang * BUCKETS + bucket), pa.array(counts[lang, bucket])], names=["at", "n"]
        )

    total = np.zeros(len(names) * BUCKETS, dtype=np.int64)
    summed = chosen.mapInArrow(over, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    table = summed.toArrow()  # at most languages * BUCKETS rows
    total[table.column("at").to_numpy()] = table.column("n").to_numpy()
    smooth = total.reshape(len(names), BUCKETS) + SMOOTH
    return names, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def text_evidence(pages: DataFrame, log_share: np.ndarray, evidence: float = EVIDENCE) -> DataFrame:
    """``pages`` without ``html``, with ``ll``: the text's log likelihood per language."""
    shared = pages.sparkSession.sparkContext.broadcast(np.ascontiguousarray(log_share.T))

    def over(batch: pa.RecordBatch):
        table, out = shared.value, []
        for source in batch.column("html").to_pylist():
            data = np.frombuffer(visible(source).encode(errors="replace"), dtype=np.uint8)
            at = trigrams(data) if len(data) > 2 else np.zeros(0, dtype=np.int64)
            value = table[at].sum(axis=0)
            out.append(value * min(1.0, evidence / max(len(at), 1)))
        keep = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in keep], pa.array(map(np.ndarray.tolist, out), pa.list_(pa.float64()))],
            names=[*keep, "ll"],
        )

    kept = [f for f in pages.schema.fields if f.name != "html"]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "ll array<double>"])
    return map_arrow(pages, over, schema)


def _normal(ll: Column) -> Column:
    """Probabilities from log values."""
    top = F.array_max(ll)
    raised = F.transform(ll, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(rows: DataFrame, key: str, size: int, out: str) -> DataFrame:
    """Sum of the arrays ``p`` per key."""
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(size)]
    return rows.groupBy(key).agg(*sums).select(key, F.array(*[f"s{i}" for i in range(size)]).alias(out))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _smoothed(counts: Column, less: Column, towards: Column, kappa: float) -> Column:
    """(counts - less + kappa * towards) / sum, at least a little above zero."""
    left = F.zip_with(counts, less, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    return F.zip_with(left, towards, lambda a, t: (a + kappa * t) / (_total(left) + kappa))


def _join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return rows.join(table, rows[key].eqNullSafe(table[key]), "left").drop(table[key])


def identify(
    pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", sample: int = SAMPLE_DOCS,
) -> DataFrame:
    """(id column, url column, declared, host, lang, probability) of every page.

    ``labelled`` has text and lang.
    """
    names, table = train(labelled, sample)
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z]+://([^/:?#]+)", 1))
    part = F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z]+://[^/?#]+/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.)?[^.]+$", 0).alias("domain"),
        F.concat_ws("/", F.regexp_extract(host, r"[^.]+$", 0), part).alias("suffix"),
        F.lower(F.regexp_extract(F.coalesce(html_col, F.lit("")), DECLARED, 1)).alias("declared"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    if not names:
        return rows.select(
            F.col("id").alias(id_col), F.col("url").alias(url_col), "declared", "host",
            F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
        )
    size = len(names)
    texts = cut_lineage(text_evidence(rows, table).withColumn("p", _normal(F.col("ll"))), "language")

    none = F.array(*[F.lit(0.0)] * size)
    overall = _sums(texts.withColumn("all", F.lit(1)), "all", size, "s").first()
    overall = overall.s if overall else [0.0] * size
    spread = [(x + SMOOTH) / (sum(overall) + SMOOTH * size) for x in overall]
    base = F.array(*[F.lit(x) for x in spread])
    # P(key | language), smoothed as if each language had shown one page of an unknown key
    given = F.array(*[F.lit(x + 1.0) for x in overall])

    def likelihood(counts: str) -> Column:
        return F.zip_with(counts, given, lambda c, n: F.log((c + SMOOTH) / (n + SMOOTH)))

    said = _sums(texts, "declared", size, "declared_n")
    ending = _sums(texts, "suffix", size, "suffix_n")
    hosts = _sums(texts, "host", size, "host_n")
    domains = _sums(texts, "domain", size, "domain_n")
    joined = texts
    for one, key in ((said, "declared"), (ending, "suffix"), (domains, "domain"), (hosts, "host")):
        joined = _join(joined, one, key)
    by_domain = _smoothed(F.col("domain_n"), F.col("p"), base, KAPPA_DOMAIN)
    fused = joined.withColumn("domain_prior", by_domain).withColumn(
        "prior", _smoothed(F.col("host_n"), F.col("p"), F.col("domain_prior"), KAPPA_HOST)
    ).withColumn("said", F.when(F.col("declared") != "", likelihood("declared_n")).otherwise(none)
    ).withColumn("ending", F.when(F.col("suffix") != "", likelihood("suffix_n")).otherwise(none))
    logs = F.col("ll")
    for more in (F.col("said"), F.col("ending"), F.transform("prior", lambda x: F.log(x + 1e-12))):
        logs = F.zip_with(logs, more, lambda a, b: a + b)
    done = fused.withColumn("post", _normal(logs)).withColumn("probability", F.array_max("post"))
    codes = F.array(*[F.lit(n) for n in names])
    return done.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "declared", "host",
        F.element_at(codes, F.array_position("post", F.col("probability")).cast("int")).alias("lang"),
        "probability",
    )
