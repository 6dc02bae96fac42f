"""SQL for DuckDB that states the expected result of each registered query.

Written separately from the operators: joins, windows and recursion where those use folds,
partial aggregates and rounds.
"""

from __future__ import annotations

from pulsegrid import schemas as S
from pulsegrid.plans.bindings import KEYWORDS, LEXICON, PROFILE_FIELDS

ORACLES: dict[str, str] = {}

_MENTIONS = "range(0, CASE WHEN k = 97 THEN 14 ELSE k % 5 END)"
_STATUS = f"""
ev AS (SELECT event_id, ts, user_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
st0 AS (SELECT event_id AS status_id, user_id, 'u' || user_id AS screen_name,
    'org' || (user_id % 10) AS original_user, 'u' || user_id AS derived_user,
    'batch' || (user_id % 3) AS batch_name, event_type, ts AS created_at, k,
    CASE event_type WHEN 'error' THEN 'STREAM_TRACKER' WHEN 'view' THEN 'STREAM_TIMELINE'
        WHEN 'purchase' THEN 'STREAM_REFERENCE' ELSE 'BATCH_TIMELINE' END AS filter_type,
    list_slice(['h' || (k % 7), 'h' || (k % 5), 'h' || (k % 3)], 1, k % 4) AS hashtags,
    [(user_id + 3 * i + k) % 150 for i in {_MENTIONS}] AS mention_ids,
    CASE WHEN k % 3 = 0 AND event_id > k THEN event_id - k - 1 END AS retweeted_status_id,
    CASE WHEN k % 5 = 1 AND event_id > k THEN event_id - k - 1 END AS in_reply_to_status_id
    FROM ev),
st AS (SELECT *, event_type || ' by @' || screen_name
        || coalesce(array_to_string([' @u' || m for m in mention_ids], ''), '')
        || coalesce(array_to_string([' #' || h for h in hashtags], ''), '') AS text
    FROM st0)"""
_TAGGED = f"""{_STATUS},
tagged AS (SELECT * EXCLUDE (hashtags), unnest(hashtags) AS hashtag FROM st)"""
_ACCOUNTS = """
accounts AS (SELECT DISTINCT user_id, 'u' || user_id AS screen_name, 'org' || (user_id % 10) AS original_user
    FROM events)"""
_WATCHED = f"""{_ACCOUNTS},
watched AS (SELECT 'batch' || (user_id % 3) AS batch_name, screen_name, user_id FROM accounts WHERE user_id % 4 = 0)"""
_TEXT = "tx AS (SELECT doc_id AS status_id, text, lang, source FROM documents)"
_KEYWORDS = "kw(org_pos, org, kw_pos, der, tag) AS (VALUES {})".format(
    ", ".join(f"({p}, '{o}', {k}, '{d}', '{t}')" for p, o, k, d, t in KEYWORDS)
)
_LEXICON = "lex(word, weight) AS (VALUES {})".format(", ".join(f"('{w}', {n})" for w, n in LEXICON.items()))


def _words(text: str) -> str:
    marks = "'.,;:!?\"()[]#@' || chr(13) || chr(10) || chr(9)"
    return f"[w for w in string_split(translate(lower({text}), {marks}, repeat(' ', 17)), ' ') if w <> '']"


def _row_id(*keys: str) -> str:
    parts = [f"coalesce(replace(replace(CAST({k} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')" for k in keys]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


def _matched(texts: str, keywords: str) -> str:
    """Pairs of text and keyword, ranked: the relational statement of the pattern rule."""
    return f"""
pairs AS (SELECT t.status_id, k.org_pos, k.org, k.kw_pos, k.der, k.tag,
        k.der <> '' AND contains(lower(t.text), lower(k.der)) AS has_der,
        k.tag <> '' AND contains(lower(t.text), lower(k.tag)) AS has_tag
    FROM {texts} t, {keywords} k),
hits AS (SELECT *, has_der AND has_tag AS is_both,
        CASE WHEN has_der AND has_tag THEN der || '+' || tag WHEN has_tag THEN tag ELSE der END AS label
    FROM pairs WHERE has_der OR has_tag),
ranked AS (SELECT *, row_number() OVER (PARTITION BY status_id, is_both, label ORDER BY org_pos, org, kw_pos) AS rn
    FROM hits),
found AS (SELECT status_id, string_agg('(' || label || ')', ' & ' ORDER BY org_pos, org, kw_pos) AS patterns
    FROM ranked WHERE is_both OR rn = 1 GROUP BY status_id),
credited AS (SELECT status_id, string_agg(org, ' & ' ORDER BY org_pos, org) AS orgs
    FROM (SELECT DISTINCT status_id, org_pos, org FROM hits WHERE is_both) GROUP BY status_id),
matched AS (SELECT status_id, patterns, coalesce(orgs, 'STREAM_KEYWORD') AS orgs
    FROM found LEFT JOIN credited USING (status_id))"""


def _top(derived: str = "derived_user", source: str = "tagged") -> str:
    return f"""
counted AS (SELECT original_user, {derived} AS derived_user, hashtag, count(*) AS record_count
    FROM {source} WHERE filter_type <> 'STREAM_TRACKER' AND hashtag IS NOT NULL GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY original_user
        ORDER BY record_count DESC, derived_user, hashtag) AS position FROM counted),
pairs5 AS (SELECT * FROM numbered WHERE position <= 5)"""


_PATTERN_COUNTS = f"""{_TAGGED}, {_top('batch_name')},
counts AS (SELECT derived_user || '+' || hashtag AS pattern, max_by(record_count, original_user) AS record_count
    FROM pairs5 GROUP BY 1)"""

ORACLES["top_hashtags_per_org"] = f"""WITH {_TAGGED}, {_top()}
SELECT original_user, derived_user, hashtag, record_count, position FROM pairs5"""

ORACLES["hashtag_normalize"] = f"""WITH {_STATUS}
SELECT status_id, unnest(CASE WHEN len(hashtags) = 0 THEN [NULL] ELSE hashtags END) AS hashtag FROM st"""

ORACLES["pattern_record_counts"] = f"WITH {_PATTERN_COUNTS} SELECT pattern, record_count FROM counts"

ORACLES["pattern_weights"] = f"""WITH {_PATTERN_COUNTS},
mean AS (SELECT nullif(CAST(sum(record_count) AS BIGINT) // count(*), 0) AS mean_count FROM counts),
weighed AS (SELECT *, record_count * 30 // mean_count AS weight,
    row_number() OVER (ORDER BY record_count DESC, pattern) = 1 AS is_most_used FROM counts, mean)
SELECT pattern, record_count, mean_count, weight,
    CAST(CASE WHEN weight > 50 THEN 50 WHEN weight < 10 THEN 10 ELSE 20 END AS BIGINT) AS font_size, is_most_used
FROM weighed"""

ORACLES["fluctuation_alert"] = f"""WITH {_TAGGED},
daily AS (SELECT original_user || '+' || hashtag AS pattern, strftime(created_at, '%Y-%m-%d') AS day,
    count(*) AS record_count FROM tagged GROUP BY ALL),
lagged AS (SELECT *, lag(record_count) OVER (PARTITION BY pattern ORDER BY day) AS previous_count FROM daily)
SELECT pattern, day, record_count, previous_count FROM lagged
WHERE record_count - previous_count >= 10 AND (record_count - previous_count) * 100 >= previous_count * 100"""

# -- flattening -----------------------------------------------------------------------

_LONG_DATE = "%a %b %d %H:%M:%S UTC %Y"
_BATCH_DATE = "%d/%m/%Y-%H:%M:%S"
_STATUS_WIDE = {
    "statusFilterType": "filter_type",
    "statusOriginalUserFilter": "original_user",
    "statusDerivedUserFilter": "derived_user",
    "systemCreateDt": f"strftime(created_at + INTERVAL 5 MINUTE, '{_BATCH_DATE}')",
    "statusId": "status_id",
    "statusUserId": "user_id",
    "statusCreatedAt": f"strftime(created_at, '{_LONG_DATE}')",
    "statusRefStatusId": "NULL",
    "statusLang": "CASE k % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'de' END",
    "statusSource": "'app' || (k % 4)",
    "statusText": "text",
    "statusFavoriteCount": "k % 9",
    "statusRetweetCount": "k % 6",
    "statusCurrentUserRetweetId": "NULL",
    "statusInReplyToUserId": "parent_user_id",
    "statusInReplyToStatusId": "in_reply_to_status_id",
    "statusIsReply": "in_reply_to_status_id IS NOT NULL",
    "statusInReplyToScreenName": "'u' || parent_user_id",
    "statusIsFavorited": "k % 2 = 0",
    "statusIsPossiblySensitive": "k = 13",
    "statusIsRetweet": "retweeted_status_id IS NOT NULL",
    "statusIsRetweeted": "k % 8 = 7",
    "statusIsTruncated": "k > 95",
    "statusRetweetedStatusId": "retweeted_status_id",
    "statusLatitude": "CASE WHEN k % 10 = 5 THEN CAST(k AS DOUBLE) / 4 END",
    "statusLongitude": "CASE WHEN k % 10 = 5 THEN -CAST(k AS DOUBLE) / 2 END",
    "statusPlaceCountry": "CASE WHEN k % 4 = 0 THEN 'C' || (user_id % 25) END",
    "statusPlaceCountryCode": "CASE WHEN k % 4 = 0 THEN 'c' || (user_id % 25) END",
    "statusPlaceName": "CASE WHEN k % 4 = 0 THEN 'city' || k END",
    "statusPlaceId": "CASE WHEN k % 4 = 0 THEN 'p' || k END",
    "statusPlaceStreetAddress": "NULL",
}
_STATUS_LISTS = {
    "statusContributors": "CASE WHEN k % 11 = 0 THEN [user_id, user_id + 1] ELSE [] END",
    "statusMediaEntities": "CASE WHEN k % 6 = 0 THEN ['http://m/' || k] ELSE [] END",
    "statusSymbolEntities": "CASE WHEN k % 7 = 3 THEN ['S' || k] ELSE [] END",
    "statusURLEntities": "list_slice(['http://l/' || k || '/0', 'http://l/' || k || '/1'], 1, k % 3)",
    "statusUserMentionScreenName": "['u' || m for m in mention_ids]",
    "statusUserMentionId": "mention_ids",
}


def _slots(name: str, values: str, slots: int = S.SLOTS) -> list[str]:
    return [f"CAST(({values})[{i + 1}] AS VARCHAR) AS \"{name}_{i}\"" for i in range(slots)]


_wide = [f"CAST({e} AS VARCHAR) AS \"{n}\"" for n, e in _STATUS_WIDE.items()]
_wide += [s for n, e in _STATUS_LISTS.items() for s in _slots(n, e)]
_FULL = f"""{_STATUS},
full_st AS (SELECT st.*, p.user_id AS parent_user_id FROM st LEFT JOIN events p ON p.event_id = in_reply_to_status_id),
full_tag AS (SELECT *, unnest(CASE WHEN len(hashtags) = 0 THEN [NULL] ELSE hashtags END) AS hashtag FROM full_st)"""
ORACLES["status_flatten"] = f"""WITH {_FULL}
SELECT {', '.join(_wide)}, hashtag AS "statusHashtagEntity" FROM full_tag"""

ORACLES["status_retype"] = f"""WITH {_FULL}
SELECT status_id, user_id, hashtag, strftime(created_at, '{_BATCH_DATE}') AS created_text,
    strftime(created_at + INTERVAL 5 MINUTE, '{_BATCH_DATE}') AS loaded_text,
    coalesce(in_reply_to_status_id, -1) AS in_reply_to_status_id,
    in_reply_to_status_id IS NOT NULL AS is_reply, coalesce(retweeted_status_id, -1) AS retweeted_status_id,
    CAST(CASE WHEN k % 10 = 5 THEN k ELSE -1 END AS BIGINT) AS latitude_quarters,
    CASE WHEN k % 4 = 0 THEN 'city' || k END AS place_name, len(mention_ids) AS mention_count,
    coalesce(mention_ids[1], -1) AS first_mention_id,
    CASE WHEN k % 11 = 0 THEN user_id + 1 ELSE -1 END AS second_contributor,
    array_to_string(list_slice(['http://l/' || k || '/0', 'http://l/' || k || '/1'], 1, k % 3), ' ') AS urls,
    coalesce(array_to_string(['u' || m for m in mention_ids], ' '), '') AS mention_names,
    CASE WHEN k % 13 = 0 THEN 'p' || k || ' p' || (k + 1) END AS scope_place_ids
FROM full_tag"""

ORACLES["wide_overflow"] = f"""WITH {_STATUS},
long_st AS (SELECT status_id, unnest(mention_ids) AS m, unnest(range(0, len(mention_ids))) AS position FROM st),
scoped AS (SELECT status_id, k, unnest([0, 1]) AS position FROM st WHERE k % 13 = 0)
SELECT status_id, 'mentions.screen_name' AS entity, position, 'u' || m AS value FROM long_st WHERE position >= 12
UNION ALL SELECT status_id, 'mentions.id', position, CAST(m AS VARCHAR) FROM long_st WHERE position >= 12
UNION ALL SELECT status_id, 'scope_place_ids', position, 'p' || (k + position) FROM scoped"""

_USER_VALUES = {
    "filter_type": "'BATCH_TIMELINE'", "original_user": "'org' || (user_id % 10)",
    "derived_user": "'u' || user_id", "system_create_ts": "'01/02/2024-00:00:00'",
    "name": "c_name", "id": "user_id", "location": "c_mktsegment",
    "created_at": f"strftime(TIMESTAMP '2010-01-01' + to_days(CAST(user_id AS INT)), '{_LONG_DATE}')",
    "lang": "CASE WHEN user_id % 2 = 0 THEN 'en' ELSE 'fr' END", "screen_name": "'u' || user_id",
    "time_zone": "'tz' || c_nationkey", "url": "CASE WHEN user_id % 3 = 0 THEN 'http://u/' || user_id END",
    "favourites_count": "user_id * 2", "followers_count": "user_id * 3", "friends_count": "user_id + 1",
    "listed_count": "user_id % 7", "statuses_count": "status_count",
    "utc_offset": "(user_id % 24 - 12) * 3600",
}
_USER_VALUES.update({
    f: f"CASE WHEN (user_id + {i}) % 5 <> 0 THEN '{f}/' || user_id END" for i, f in enumerate(PROFILE_FIELDS)
})
_USERS = """
au AS (SELECT user_id, count(*) AS status_count FROM events GROUP BY user_id),
us AS (SELECT au.*, c_name, c_nationkey, c_mktsegment FROM au LEFT JOIN customer ON c_custkey = user_id)"""
_user_cols = [f"CAST({_USER_VALUES[t]} AS VARCHAR) AS \"{w}\"" for w, t in S.USER_SCALARS]
_user_cols += _slots(S.USER_SLOT_GROUP[0], "['http://d/' || user_id || '/' || i for i in range(0, user_id % 4)]")
ORACLES["user_flatten"] = f"WITH {_USERS} SELECT {', '.join(_user_cols)} FROM us"

ORACLES["entities_to_columns"] = f"""WITH tk AS (
    SELECT doc_id AS status_id, string_split(lower(text), ' ') AS tokens FROM documents)
SELECT status_id, {', '.join(_slots('token', 'tokens'))}, greatest(len(tokens) - 12, 0) AS overflow FROM tk"""

ORACLES["scope_places"] = f"""WITH {_STATUS}
SELECT status_id, {', '.join(_slots('statusScopePlaceIds', "['p' || k, 'p' || (k + 1)]"))},
    greatest(len(mention_ids) - 12, 0) AS mention_overflow
FROM st WHERE k % 13 = 0"""

ORACLES["project_by_config"] = f"WITH {_STATUS} SELECT status_id, text, CAST(k % 9 AS BIGINT) AS favorite_count FROM st"
ORACLES["records_limit"] = f"""WITH {_STATUS}
SELECT status_id, screen_name FROM st ORDER BY created_at, status_id LIMIT 700"""

# -- classification and patterns ------------------------------------------------------

_CLASSIFIED = f"""{_STATUS}, {_WATCHED},
classified AS (SELECT st.status_id, st.created_at, st.batch_name,
    CASE WHEN w.user_id IS NULL THEN 'STREAM_REFERENCE' ELSE 'STREAM_TIMELINE' END AS filter_type,
    CASE WHEN w.user_id IS NOT NULL THEN 'org' || (st.user_id % 10) END AS original_user,
    CASE WHEN w.user_id IS NOT NULL THEN st.screen_name
        ELSE coalesce(array_to_string(['u' || m for m in mention_ids], '+'), '') END AS derived_user,
    'STATUS' AS kind
    FROM st LEFT JOIN watched w ON w.batch_name = st.batch_name AND w.screen_name = st.screen_name)"""
ORACLES["status_classify"] = f"WITH {_CLASSIFIED} SELECT * EXCLUDE (created_at) FROM classified"

_MATCHED_TEXTS = f"{_TEXT}, {_KEYWORDS}, {_matched('tx', 'kw')}"
ORACLES["pattern_match"] = f"WITH {_MATCHED_TEXTS} SELECT status_id, patterns, orgs FROM matched"
ORACLES["tracker_reject_split"] = f"""WITH {_MATCHED_TEXTS}
SELECT status_id, 'STREAM_TRACKER' AS filter_type, patterns AS derived_user, orgs AS original_user,
    CASE WHEN orgs = 'STREAM_KEYWORD' THEN 'REJECTED-STATUS' ELSE 'STATUS' END AS kind,
    CASE WHEN orgs = 'STREAM_KEYWORD' THEN 'REJECTED-USER' ELSE 'USER' END AS user_kind
FROM matched"""

_TOKENS = f"""{_TAGGED}, {_top()},
halves AS (SELECT original_user, position AS kw_pos, 0 AS part, derived_user AS token FROM pairs5
    UNION ALL SELECT original_user, position, 1, hashtag FROM pairs5),
firsts AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY original_user, kw_pos, part) AS rn FROM halves),
tracked AS (SELECT row_number() OVER (ORDER BY original_user, kw_pos, part) AS position, token FROM firsts WHERE rn = 1)"""
ORACLES["keyword_tokens"] = f"WITH {_TOKENS} SELECT (position - 1) // 400 AS list_no, position, token FROM tracked"
ORACLES["track_filter"] = f"""WITH {_TOKENS}
SELECT status_id, text FROM st WHERE EXISTS (SELECT 1 FROM tracked WHERE contains(lower(st.text), lower(token)))"""
_LONG_KEYWORDS = """
long_words AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents)
    WHERE length(word) BETWEEN 10 AND 11),
long_kw AS (SELECT 0 AS org_pos, word AS org, 0 AS kw_pos, word AS der,
    CASE WHEN length(word) % 2 = 0 THEN word[1:6] ELSE reverse(word) END AS tag FROM long_words)"""
ORACLES["long_keyword_tokens"] = f"""WITH {_LONG_KEYWORDS},
halves AS (SELECT org, 0 AS part, der AS token FROM long_kw UNION ALL SELECT org, 1, tag FROM long_kw),
firsts AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY org, part) AS rn FROM halves),
placed AS (SELECT token, row_number() OVER (ORDER BY org, part) AS position FROM firsts WHERE rn = 1)
SELECT (position - 1) // 400 AS list_no, position, token FROM placed"""
ORACLES["long_pattern_match"] = f"""WITH {_TEXT}, {_LONG_KEYWORDS}, {_matched('tx', 'long_kw')}
SELECT status_id, patterns, orgs FROM matched"""
ORACLES["long_track_filter"] = f"""WITH {_TEXT}, {_LONG_KEYWORDS}
SELECT status_id FROM tx WHERE EXISTS (
    SELECT 1 FROM long_kw WHERE length(der) >= 11 AND contains(lower(tx.text), der))"""
ORACLES["pattern_tokens"] = f"""WITH {_TAGGED}, {_top()}
SELECT derived_user || '+' || hashtag AS pattern, unnest([derived_user, hashtag]) AS token FROM pairs5"""

# -- users and follow lists -----------------------------------------------------------

_REGISTERED = f"""{_STATUS},
reg AS (SELECT batch_name, screen_name, arg_min(user_id, status_id) AS user_id,
    arg_max('org' || (k % 10), status_id) AS original_user, min(status_id) AS first_status_id,
    max(status_id) AS last_status_id FROM st WHERE filter_type = 'BATCH_TIMELINE' GROUP BY ALL)"""
ORACLES["user_registry"] = f"WITH {_REGISTERED} SELECT * FROM reg"
ORACLES["account_map"] = f"""WITH {_REGISTERED}
SELECT screen_name, arg_max(original_user, last_status_id) AS original_user FROM reg GROUP BY screen_name"""
_FOLLOWED = f"""{_REGISTERED}, {_WATCHED},
cand AS (SELECT batch_name, screen_name, min(origin) AS origin FROM (
    SELECT batch_name, screen_name, 0 AS origin FROM watched
    UNION ALL SELECT batch_name, screen_name, 1 FROM reg) GROUP BY ALL),
placed AS (SELECT batch_name, screen_name, user_id,
    row_number() OVER (PARTITION BY batch_name ORDER BY origin, user_id) AS position
    FROM cand JOIN accounts USING (screen_name)),
followed AS (SELECT batch_name, (position - 1) // 200 AS list_no, position, screen_name, user_id FROM placed)"""
ORACLES["follow_list"] = f"WITH {_FOLLOWED} SELECT * FROM followed"
ORACLES["follow_filter"] = f"""WITH {_FOLLOWED}
SELECT status_id, batch_name, user_id FROM st
WHERE EXISTS (SELECT 1 FROM followed f WHERE f.batch_name = st.batch_name AND f.user_id = st.user_id)"""
_FIRST_SEEN = f"""{_STATUS},
nth AS (SELECT *, row_number() OVER (PARTITION BY screen_name ORDER BY created_at, status_id) AS rn FROM st)"""
ORACLES["user_first_seen"] = f"WITH {_FIRST_SEEN} SELECT screen_name, status_id, filter_type FROM nth WHERE rn = 1"
ORACLES["user_anti_processed"] = f"""WITH {_FIRST_SEEN}
SELECT screen_name, status_id FROM nth WHERE rn = 1 AND created_at > TIMESTAMP '2024-01-01 12:00:00'"""
ORACLES["status_anti_processed"] = f"""WITH {_STATUS}
SELECT status_id FROM st EXCEPT SELECT retweeted_status_id FROM st"""

# -- back-fill state ------------------------------------------------------------------

ORACLES["cutoff_filter"] = f"""WITH {_STATUS}
SELECT status_id, strftime(created_at, '{_BATCH_DATE}') AS created_text FROM st
WHERE created_at BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-21 18:30:00'"""
ORACLES["user_watermarks"] = f"""WITH {_STATUS}
SELECT screen_name, min(status_id) AS since_id, max(status_id) AS max_id, count(*) AS status_count
FROM st GROUP BY screen_name"""
ORACLES["incremental_extract"] = f"""WITH {_STATUS},
marks AS (SELECT screen_name, min(status_id) AS lo, max(status_id) AS hi FROM st
    WHERE screen_name NOT LIKE '%3' AND created_at BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-20'
    GROUP BY screen_name)
SELECT status_id, st.screen_name, CASE WHEN hi IS NULL THEN 'INITIAL' WHEN status_id > hi THEN 'FORWARD'
    ELSE 'REVERSE' END AS direction
FROM st LEFT JOIN marks ON marks.screen_name = st.screen_name
WHERE hi IS NULL OR status_id > hi OR status_id < lo"""
_MODES = f"""{_STATUS}, {_ACCOUNTS},
modes AS (SELECT 'batch' || (a.user_id % 7) AS batch_name, a.screen_name,
    CASE WHEN count(st.status_id) FILTER (created_at >= TIMESTAMP '2024-01-01 12:00:00') = 0
        OR count(st.status_id) FILTER (created_at < TIMESTAMP '2024-01-01 12:00:00') > 0
        THEN 'FORWARD' ELSE 'REVERSE' END AS paging_mode
    FROM accounts a LEFT JOIN st ON st.user_id = a.user_id
    GROUP BY a.user_id, a.screen_name)"""
ORACLES["user_paging_mode"] = f"WITH {_MODES} SELECT * FROM modes"
ORACLES["batch_mode"] = f"""WITH {_MODES}
SELECT batch_name, count(*) AS user_count, count(*) FILTER (paging_mode = 'FORWARD') AS forward_count,
    bool_and(paging_mode = 'FORWARD') AS is_finished FROM modes GROUP BY batch_name"""
ORACLES["unfinished_users"] = f"WITH {_MODES} SELECT batch_name, screen_name FROM modes WHERE paging_mode = 'REVERSE'"
ORACLES["cutoff_advance"] = f"""WITH {_STATUS},
newest AS (SELECT batch_name, max(created_at) FILTER (created_at <= TIMESTAMP '2024-01-20') AS newest
    FROM st GROUP BY batch_name)
SELECT batch_name, strftime(greatest(newest, CASE batch_name WHEN 'batch0' THEN TIMESTAMP '2024-01-25 10:00:00'
    WHEN 'batch1' THEN TIMESTAMP '2024-01-02 10:00:00' ELSE newest END), '{_BATCH_DATE}') AS cutoff_min_text
FROM newest"""
_DEFINITIONS = f"""{_ACCOUNTS},
member AS (SELECT 'batch' || (user_id % 3) || '-' || (user_id // 60) AS batch_name, user_id, screen_name FROM accounts)"""
ORACLES["batch_config_users"] = f"""WITH {_DEFINITIONS}
SELECT batch_name, row_number() OVER (PARTITION BY batch_name ORDER BY user_id) - 1 AS position, screen_name
FROM member"""
ORACLES["batch_config_settings"] = f"""WITH {_DEFINITIONS},
low AS (SELECT batch_name, min(user_id) AS lowest FROM member GROUP BY batch_name)
SELECT batch_name, '05/01/2024-06:00:00' AS cutoff_min,
    CASE WHEN lowest % 2 = 0 THEN '21/01/2024-18:30:00' END AS cutoff_max,
    lowest % 3 = 0 AS track_stream, CAST(5 AS BIGINT) AS ref_level, true AS starts_now FROM low"""

ORACLES["definition_advance"] = f"""WITH {_DEFINITIONS}
SELECT batch_name, strftime(greatest(max(ts), TIMESTAMP '2024-01-05 06:00:00'), '{_BATCH_DATE}') AS cutoff_min,
    CASE WHEN min(member.user_id) % 2 = 0 THEN '21/01/2024-18:30:00' ELSE '' END AS cutoff_max
FROM member JOIN events ON events.user_id = member.user_id GROUP BY batch_name"""

# -- lineage --------------------------------------------------------------------------

_LINEAGE = f"""RECURSIVE {_STATUS},
chain AS (SELECT status_id AS origin_id, status_id AS ref_status_id, retweeted_status_id AS status_id,
        CAST(1 AS BIGINT) AS level FROM st WHERE retweeted_status_id IS NOT NULL
    UNION ALL SELECT c.origin_id, c.status_id, st.retweeted_status_id, c.level + 1
    FROM chain c JOIN st ON st.status_id = c.status_id
    WHERE st.retweeted_status_id IS NOT NULL)"""
ORACLES["retweet_lineage"] = f"WITH {_LINEAGE} SELECT * FROM chain"
ORACLES["retweet_unroll"] = f"""WITH {_LINEAGE}
SELECT c.origin_id, c.ref_status_id, c.status_id, t.screen_name, o.filter_type, o.original_user
FROM chain c JOIN st t ON t.status_id = c.status_id JOIN st o ON o.status_id = c.origin_id"""
ORACLES["embedded_unroll"] = f"""WITH RECURSIVE {_STATUS},
landed AS (SELECT * FROM st WHERE status_id % 2 = 0),
inside AS (SELECT * FROM st WHERE status_id IN (SELECT retweeted_status_id FROM landed)),
known AS (SELECT * FROM landed UNION SELECT * FROM inside),
chain AS (SELECT status_id AS origin_id, status_id AS ref_status_id, retweeted_status_id AS status_id FROM landed
        WHERE retweeted_status_id IS NOT NULL
    UNION ALL SELECT c.origin_id, c.status_id, known.retweeted_status_id
    FROM chain c JOIN known ON known.status_id = c.status_id WHERE known.retweeted_status_id IS NOT NULL)
SELECT c.origin_id, c.ref_status_id, c.status_id, t.screen_name, o.filter_type, o.original_user
FROM chain c JOIN known t ON t.status_id = c.status_id JOIN landed o ON o.status_id = c.origin_id"""
ORACLES["reply_lookup"] = f"""WITH {_STATUS},
nth AS (SELECT status_id AS child, in_reply_to_status_id AS parent, row_number() OVER (
    PARTITION BY in_reply_to_status_id ORDER BY created_at DESC, status_id DESC) AS rn
    FROM st WHERE in_reply_to_status_id IS NOT NULL)
SELECT st.status_id, child AS ref_status_id, screen_name FROM nth JOIN st ON st.status_id = parent WHERE rn = 1"""
ORACLES["reply_threads"] = """WITH RECURSIVE
th AS (SELECT conv_id * 1000 + turn AS id, turn, role,
    CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent FROM conversations),
walk AS (SELECT id, CAST(0 AS BIGINT) AS level FROM th WHERE role = 'user'
    UNION SELECT p.id, walk.level + 1 FROM walk JOIN th c ON c.id = walk.id JOIN th p ON p.id = c.parent),
reached AS (SELECT id, min(level) AS level FROM walk WHERE level > 0 GROUP BY id)
SELECT r.id AS status_id, arg_max(c.id, c.turn) AS ref_status_id, r.level
FROM reached r JOIN th c ON c.parent = r.id JOIN walk w ON w.id = c.id AND w.level = r.level - 1
GROUP BY r.id, r.level"""

# -- files and loads ------------------------------------------------------------------

_SIZES = f"""{_TEXT},
sized AS (SELECT status_id, CAST(greatest(octet_length(encode(text)), octet_length(encode(lang)),
    octet_length(encode(source))) AS BIGINT) AS longest FROM tx)"""
ORACLES["length_reject"] = f"WITH {_SIZES} SELECT status_id, longest, longest <= 500 AS accepted FROM sized"
ORACLES["load_audit"] = f"""WITH {_SIZES}
SELECT 'documents.parquet' AS file_name, count(*) FILTER (longest <= 500) AS accepted_rows,
    count(*) FILTER (longest > 500) AS rejected_rows, count(*) FILTER (longest <= 500) > 0 AS is_loaded FROM sized"""
_ONE_LINE = "replace(replace(text, chr(13), ' '), chr(10), ' ')"
ORACLES["one_line_text"] = f"WITH {_TEXT} SELECT status_id, {_ONE_LINE} AS text FROM tx"
ORACLES["delimited_roundtrip"] = f"""WITH {_TEXT}
SELECT status_id, {_ONE_LINE} AS text, lang, source,
    CASE status_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'a\\' || status_id || '"~null' END AS note FROM tx"""
ORACLES["roll_windows"] = f"""WITH {_STATUS}
SELECT batch_name, strftime(time_bucket(INTERVAL '8 minutes', created_at, TIMESTAMP '1970-01-01')
    + INTERVAL '8 minutes', '%Y%m%d%H%M%S') AS bucket, count(*) AS record_count FROM st GROUP BY ALL"""
ORACLES["routed_write"] = f"""WITH {_CLASSIFIED}, {_TAGGED.removeprefix(_STATUS + ',').strip()}, {_top()},
kw AS (SELECT 0 AS org_pos, original_user AS org, position AS kw_pos, derived_user AS der, hashtag AS tag FROM pairs5),
tracker AS (SELECT * FROM st WHERE filter_type = 'STREAM_TRACKER'),
{_matched('tracker', 'kw')},
delivered AS (SELECT c.status_id, c.created_at, c.batch_name, c.kind, st.screen_name FROM classified c
        JOIN st USING (status_id) WHERE st.filter_type <> 'STREAM_TRACKER'
    UNION ALL SELECT status_id, created_at, 'STREAM_TRACKER',
        CASE WHEN orgs = 'STREAM_KEYWORD' THEN 'REJECTED-STATUS' ELSE 'STATUS' END, screen_name
    FROM matched JOIN tracker USING (status_id)),
nth AS (SELECT *, row_number() OVER (PARTITION BY batch_name, kind, screen_name ORDER BY created_at, status_id) AS rn FROM delivered),
routed AS (SELECT status_id, created_at, batch_name, kind FROM delivered
    UNION ALL SELECT status_id, created_at, batch_name, replace(kind, 'STATUS', 'USER') FROM nth WHERE rn = 1)
SELECT batch_name, kind, strftime(date_trunc('day', created_at) + INTERVAL '1 day', '%Y%m%d%H%M%S') AS bucket,
    count(*) AS record_count, CAST(sum(status_id) AS BIGINT) AS id_sum FROM routed GROUP BY ALL"""
ORACLES["load_runs"] = f"""WITH {_SIZES},
outcomes AS (SELECT 'accepted' AS outcome, count(*) AS rows, CAST(sum(status_id) AS BIGINT) AS id_sum FROM sized WHERE longest <= 500
    UNION ALL SELECT 'field too long', count(*), 0 FROM sized WHERE longest > 500
    UNION ALL SELECT 'wrong number of fields', count(*) FILTER (status_id % 7 = 0) + count(*) FILTER (status_id % 9 = 0), 0 FROM sized
    UNION ALL SELECT 'audited', count(*) + count(*) FILTER (status_id % 7 = 0) + count(*) FILTER (status_id % 9 = 0), 0 FROM sized
    UNION ALL SELECT 'second load', 0, 0)
SELECT outcome, CAST(rows AS BIGINT) AS rows, CAST(id_sum AS BIGINT) AS id_sum FROM outcomes"""
ORACLES["timestamp_parse"] = f"""WITH {_STATUS},
zoned AS (SELECT *, ['UTC', 'IST', 'EST', 'XXX'][k % 4 + 1] AS zone, [0, 330, -300, NULL][k % 4 + 1] AS shift FROM st)
SELECT status_id, strftime(created_at, '%a %b %d %H:%M:%S ') || zone || strftime(created_at, ' %Y') AS long_text,
    strftime(created_at - to_minutes(shift), '{_BATCH_DATE}') AS long_utc,
    CASE WHEN k % 10 <> 0 THEN strftime(created_at, '{_BATCH_DATE}') END AS batch_utc,
    strftime(created_at, '%Y%m%d%H') AS hour_stamp FROM zoned"""

# -- derived tables -------------------------------------------------------------------

_COUNTRIES = f"""{_USERS},
countries AS (SELECT user_id, n_name AS country FROM us
    LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 7 <> 6)"""
ORACLES["timezone_country"] = f"WITH {_COUNTRIES} SELECT user_id, country FROM countries"
ORACLES["sentiment_score"] = f"""WITH {_LEXICON}, {_TEXT},
spoken AS (SELECT 'u' || user_id AS user_code, day(ts) AS day, month(ts) AS month, year(ts) AS year,
    unnest({_words('text')}) AS keyword FROM tx LEFT JOIN events ON event_id = status_id),
summed AS (SELECT user_code, keyword, day, month, year, CAST(sum(weight) AS BIGINT) AS sentiment_score
    FROM spoken JOIN lex ON word = keyword GROUP BY ALL)
SELECT {_row_id('user_code', 'keyword', 'day', 'month', 'year')} AS ssoid, user_code, keyword, sentiment_score,
    CASE WHEN sentiment_score > 0 THEN 'POSITIVE' WHEN sentiment_score < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END
    AS sentiment_type, 'LEXICON_SUM' AS analysis_name, day, month, year FROM summed"""
ORACLES["status_sentiment"] = f"""WITH {_LEXICON}, {_TEXT},
split AS (SELECT status_id, {_words('text')} AS list FROM tx),
spoken AS (SELECT status_id, unnest(list) AS keyword FROM split),
summed AS (SELECT status_id, CAST(sum(weight) AS BIGINT) AS score FROM spoken JOIN lex ON word = keyword GROUP BY ALL)
SELECT status_id, coalesce(score, 0) AS score, len(list) AS word_count FROM split LEFT JOIN summed USING (status_id)"""
_ASKED = f"""{_STATUS}, {_ACCOUNTS},
msg AS (SELECT s.original_user AS sender_team, s.user_id AS sender_id, p.user_id AS addressee_id,
    a.original_user AS client, s.created_at FROM st s JOIN events p ON p.event_id = s.in_reply_to_status_id
    JOIN accounts a ON a.user_id = p.user_id),
asked AS (SELECT client, sender_id AS user_id, date_trunc('hour', created_at) AS hour_start, max(created_at) AS asked_at
    FROM msg WHERE sender_team <> client GROUP BY ALL),
judged AS (SELECT *, NOT EXISTS (SELECT 1 FROM msg m WHERE m.sender_team = asked.client
    AND m.addressee_id = asked.user_id AND m.created_at >= asked_at) AS missed FROM asked)"""
ORACLES["non_responded_users"] = f"""WITH {_ASKED},
last_asked AS (SELECT *, row_number() OVER (PARTITION BY client, user_id ORDER BY asked_at DESC) AS rn FROM judged)
SELECT client, count(*) AS asking_users, count(*) FILTER (missed) AS non_responded_user_count
FROM last_asked WHERE rn = 1 GROUP BY client"""
_SCORED = f"""{_LEXICON},
weighed AS (SELECT status_id, sum(weight) AS score FROM (SELECT status_id, unnest({_words('text')}) AS keyword FROM st)
    JOIN lex ON word = keyword GROUP BY ALL),
scored AS (SELECT st.*, coalesce(score, 0) AS score FROM st LEFT JOIN weighed USING (status_id))"""
ORACLES["rollup_client_country_hour"] = f"""WITH {_ASKED}, {_SCORED}, {_COUNTRIES},
merged AS (SELECT original_user AS client, user_id, date_trunc('hour', created_at) AS hour_start, score, 0 AS missed FROM scored
    UNION ALL SELECT client, user_id, hour_start, 0, 1 FROM judged WHERE missed),
summed AS (SELECT client, country, hour_start, CAST(sum(score) AS BIGINT) AS sentiment_score,
    CAST(sum(missed) AS BIGINT) AS non_responded_user_count
    FROM merged LEFT JOIN countries USING (user_id) GROUP BY ALL),
parts AS (SELECT client, country, sentiment_score, non_responded_user_count, hour(hour_start) AS hour,
    day(hour_start) AS day, month(hour_start) AS month, year(hour_start) AS year FROM summed)
SELECT {_row_id('client', 'country', 'hour', 'day', 'month', 'year')} AS ssoid, * FROM parts"""
ORACLES["rollup_hashtag_country_day"] = f"""WITH {_STATUS}, {_SCORED}, {_COUNTRIES},
tags AS (SELECT user_id, score, created_at, unnest(hashtags) AS hashtag FROM scored),
summed AS (SELECT country, hashtag, day(created_at) AS day, month(created_at) AS month, year(created_at) AS year,
    CAST(sum(score) AS BIGINT) AS sentiment_score, count(DISTINCT user_id) AS num_of_users
    FROM tags LEFT JOIN countries USING (user_id) GROUP BY ALL)
SELECT {_row_id('country', 'hashtag', 'day', 'month', 'year')} AS ssoid, country, hashtag, sentiment_score,
    num_of_users, day, month, year FROM summed"""

# -- jobs -----------------------------------------------------------------------------

ORACLES["backfill_runs"] = f"""WITH {_STATUS}, {_WATCHED}
SELECT status_id, st.batch_name, st.screen_name AS original_user, 'BATCH_TIMELINE' AS filter_type
FROM st JOIN watched w ON w.batch_name = st.batch_name AND w.screen_name = st.screen_name
WHERE created_at BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-21 18:30:00'
UNION ALL SELECT status_id, 'wide', screen_name, 'BATCH_TIMELINE' FROM st
WHERE user_id % 8 = 0 AND created_at <= TIMESTAMP '2024-01-18 00:00:00'"""
ORACLES["handover"] = f"""WITH {_STATUS}
SELECT status_id, batch_name, CASE WHEN created_at < TIMESTAMP '2024-01-15' AND status_id % 3 <> 0 THEN 'BATCH_TIMELINE'
    ELSE 'STREAM_TIMELINE' END AS filter_type FROM st"""

ORACLES["load_by_name"] = ORACLES["status_retype"]
ORACLES["stream_until_date"] = f"""WITH {_STATUS}
SELECT status_id, batch_name, 'STREAM_TIMELINE' AS filter_type FROM st WHERE created_at < TIMESTAMP '2024-01-15'"""
ORACLES["stream_discovered_users"] = f"""WITH {_STATUS},
first_wave AS (SELECT * FROM st WHERE status_id % 2 = 0 AND user_id % 10 = 0),
found AS (SELECT DISTINCT e.user_id FROM first_wave f JOIN events e ON e.event_id = f.retweeted_status_id),
kept AS (SELECT * FROM first_wave UNION ALL SELECT * FROM st
    WHERE status_id % 2 = 1 AND (user_id % 10 = 0 OR user_id IN (SELECT user_id FROM found)))
SELECT status_id, 'all' AS batch_name, CASE WHEN user_id % 10 = 0 THEN 'STREAM_TIMELINE' ELSE 'STREAM_REFERENCE' END AS filter_type,
    CASE WHEN user_id % 10 = 0 THEN 'org' || (user_id % 10) END AS account FROM kept"""
ORACLES["stream_refresh"] = ORACLES["rollup_client_country_hour"]

# -- streams --------------------------------------------------------------------------

ORACLES["stream_classify"] = ORACLES["status_classify"]
ORACLES["stream_dedupe_users"] = "SELECT DISTINCT 'u' || user_id AS screen_name, user_id FROM events"
ORACLES["stream_first_seen"] = ORACLES["user_first_seen"]
ORACLES["stream_roll_counts"] = ORACLES["roll_windows"]
ORACLES["stream_user_registry"] = ORACLES["user_registry"]
_EARLY = "created_at < TIMESTAMP '2024-01-15'"


def _tracked_half(name: str, known: str, which: str) -> str:
    """Tracker statuses of one half of the time, matched to the patterns of the ``known`` statuses."""
    body = f"""{_top(source=known)},
kw AS (SELECT 0 AS org_pos, original_user AS org, position AS kw_pos, derived_user AS der, hashtag AS tag FROM pairs5),
half AS (SELECT * FROM st WHERE filter_type = 'STREAM_TRACKER' AND {which}),
{_matched('half', 'kw')}"""
    return f"{name} AS (WITH {body} SELECT * FROM matched)"


ORACLES["stream_keyword_refresh"] = f"""WITH {_TAGGED},
early AS (SELECT * FROM tagged WHERE {_EARLY}),
{_tracked_half('first_half', 'early', _EARLY)},
{_tracked_half('second_half', 'tagged', 'NOT ' + _EARLY)}
SELECT status_id, patterns AS derived_user, orgs AS original_user,
    CASE WHEN orgs = 'STREAM_KEYWORD' THEN 'REJECTED-STATUS' ELSE 'STATUS' END AS kind
FROM (SELECT * FROM first_half UNION ALL SELECT * FROM second_half)"""
