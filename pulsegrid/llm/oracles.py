"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from pulsegrid.llm import decontamination, exact_search, fill_middle, secret_scan, sharding
from pulsegrid.llm.settings import SHARDS


def _sharding_sql() -> str:
    table = sharding.fill_table(SHARDS)
    digits = "".join(s[-2:] for s in table)
    return f"""
WITH placed AS (
    SELECT doc_id,
        (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {len(table)})::INT AS slot
    FROM documents
)
SELECT doc_id, slot, 'shard-' || substr('{digits}', 2 * slot + 1, 2) AS shard FROM placed
"""


def _secret_sql() -> str:
    kinds = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(f"""
    SELECT n, {rank} AS rank, '{rule.kind}' AS kind, gaps, hits, tested, {rule.least} AS least FROM (
        SELECT n, string_split_regex(body, '{pattern}') AS gaps,
            regexp_extract_all(body, '{pattern}') AS hits,
            regexp_extract_all(body, '{pattern}', {rule.group}) AS tested
        FROM texts)""")
    joined = "\n    UNION ALL".join(kinds)
    one = "kind || ':' || first || ':' || (first + size)"
    counts = ", ".join(
        f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0) AS n_{r.kind}" for r in secret_scan.BASE_RULES
    )
    base = len(secret_scan.BASE_RULES)
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents
), matches AS ({joined}
), numbered AS (
    SELECT n, rank, kind, least, gaps, hits, tested, unnest(range(1, len(hits) + 1)) AS i FROM matches
), spans AS (
    SELECT n, rank, kind, length(hits[i]) AS size, length(tested[i]) >= least AS fits,
        list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS first
    FROM numbered
), found AS (
    SELECT n, {counts},
        string_agg({one}, ',' ORDER BY first, rank) FILTER (rank < {base}) AS base,
        string_agg({one}, ',' ORDER BY first, rank) AS spans
    FROM spans WHERE fits GROUP BY n
)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secret_scan.BASE_RULES)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (n)
"""


def _decontamination_sql() -> str:
    gap, size = decontamination.WORD_GAP, decontamination.SHINGLE_WORDS
    return f"""
WITH doc_words AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '{gap}'), lambda w: w <> '') AS w FROM documents
), item_words AS (
    SELECT item_id, list_filter(string_split_regex(lower(text), '{gap}'), lambda w: w <> '') AS w FROM benchmark
), doc_shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {size - 1}, least(len(w), 1)) + 1),
        lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS shingle FROM doc_words
), item_shingles AS (
    SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - {size - 1}, least(len(w), 1)) + 1),
        lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS shingle FROM item_words
), sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM doc_shingles JOIN item_shingles USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= {decontamination.THRESHOLD} * any_value(n_item)
"""


def _fill_middle_sql() -> str:
    marks = f"{fill_middle.PREFIX}|{fill_middle.SUFFIX}|{fill_middle.MIDDLE}"
    p, s, m = (f"'{x}'" for x in (fill_middle.PREFIX, fill_middle.SUFFIX, fill_middle.MIDDLE))
    hashes = ", ".join(f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('{fill_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), units AS (
    SELECT doc_id, body, regexp_extract_all(body, '[A-Za-z]+|[^A-Za-z]') AS u, {hashes} FROM texts
), cuts AS (
    SELECT doc_id, body, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
        greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN body = '' OR regexp_matches(body, '{marks}') OR h3 % 100 >= {fill_middle.TRANSFORMED} THEN 'plain'
            WHEN h4 % 100 < {fill_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM units
), parts AS (
    SELECT doc_id, body, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
        array_to_string(u[b + 1:], '') AS suffix
    FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle
        ELSE {s} || suffix || {p} || prefix || {m} || middle END) AS output_sha256, sha256(body) AS restored_sha256
FROM parts
"""


def _exact_search_sql() -> str:
    return f"""
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({exact_search.SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM valid q JOIN valid c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {exact_search.TOP}
"""


ORACLES: dict[str, str] = {
    "op4_sharding": _sharding_sql(),
    "op7_secret_scan": _secret_sql(),
    "op8_decontamination": _decontamination_sql(),
    "op11_fill_middle": _fill_middle_sql(),
    "op12_exact_search": _exact_search_sql(),
}
