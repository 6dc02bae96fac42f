"""Secret scan over a trigram inverted index, in DataFrame expressions only.

From each rule's regular expression a Boolean query over trigrams is derived: an alternative (OR) of
sets of trigrams that all must occur (AND), in lower case. The index holds postings (trigram, text)
for the trigrams that some rule asks for; the queries intersect the postings of a set and unite the
alternatives. Texts found this way are verified by the expression; a rule whose query is empty, as no
trigram is mandatory, scans every text.

Positions come from the pieces between matches, as Spark has no function for them: a match starts
behind all pieces and matches before it. They are code points, ends are exclusive.

Defined results: null and empty texts have no spans; texts are scanned whole; repeated rows have
the same spans; rows with null ids are kept. Other columns are ignored by ``scan``; ``redact`` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as parts
from re import _parser as expressions

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_CLASS = 8
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java and Python; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# "{12,}" and "{32,}" find the runs that "+" finds and a length test keeps: a run that is long enough
# matches from the same start, and a run that is too short holds no match.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
RULES = BASE_RULES + (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hosting", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", "AIza[A-Za-z0-9_-]{35}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment", "[rs]k_live_[A-Za-z0-9]{16,}"),
)

Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _minimal(query) -> Query:
    """Without alternatives that ask for more than another one."""
    return frozenset(q for q in query if not any(o < q for o in query))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_STRINGS:
        return a  # asks for less, which is allowed
    return _minimal({x | y for x, y in product(a, b)})


def _of_strings(strings: set[str]) -> Query:
    return _minimal({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _walk(items) -> tuple[set[str] | None, Query]:
    """(all strings that the sequence matches, if few; what else any match must hold)."""
    run, query, exact = {""}, ANY, True
    for op, arg in items:
        strings, inner = _item(op, arg)
        query = _both(query, inner)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
        else:
            query = _both(query, _of_strings(run))
            run, exact = (strings, False) if strings is not None else ({""}, False)
    return (run, query) if exact else (None, _both(query, _of_strings(run)))


def _item(op, arg) -> tuple[set[str] | None, Query]:
    if op is parts.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is parts.SUBPATTERN:
        return _walk(arg[-1])
    if op is parts.BRANCH:
        sides = [_walk(x) for x in arg[1]]
        if all(s is not None for s, _ in sides):
            return set().union(*(s for s, _ in sides)), ANY
        queries = [q if s is None else _both(q, _of_strings(s)) for s, q in sides]
        return None, _minimal(frozenset().union(*queries))
    if op is parts.IN:
        chars = set()
        for kind, value in arg:
            span = (value, value) if kind is parts.LITERAL else value if kind is parts.RANGE else None
            if span is None or span[1] - span[0] >= SMALL_CLASS:
                return None, ANY
            chars |= {chr(c).lower() for c in range(span[0], span[1] + 1)}
        return (chars, ANY) if len(chars) <= SMALL_CLASS else (None, ANY)
    if op is parts.MAX_REPEAT:
        least, most, body = arg
        strings, query = _walk(body)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        if least == 0:
            return None, ANY
        return None, query if strings is None else _both(query, _of_strings(strings))
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigram sets, one of which every match holds in lower case."""
    strings, query = _walk(expressions.parse(pattern))
    query = query if strings is None else _both(query, _of_strings(strings))
    return ANY if frozenset() in query else query


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` as a struct ``row`` beside its text (null is empty) and the text's 128-bit key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text.alias("text"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"),
    )


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, k1, k2): the inverted index, for the given trigrams."""
    listed = F.array(*[F.lit(t) for t in trigrams])
    # the lambda variable keeps the lower-case text from being computed for each trigram
    found = F.transform(
        F.array(F.lower("text")), lambda lower: F.filter(listed, lambda t: lower.contains(t))
    )
    return texts.select(F.explode(F.get(found, F.lit(0))).alias("trigram"), "k1", "k2")


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(k1, k2, rules): per text the bit set of the indexed rules whose query it meets."""
    asked = [
        (f"{n}.{c}", n, 1 << i, (1 << len(need)) - 1, t)
        for n, rule in enumerate(rules)
        for c, need in enumerate(sorted(map(sorted, trigram_query(rule.pattern))))
        for i, t in enumerate(need)
    ]
    fields = {"need": "string", "rule": "int", "bit": "long", "full": "long", "trigram": "string"}
    terms = texts.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields.items())]) for row in asked
    ])))
    index = postings(texts, sorted({a[-1] for a in asked}))
    # the terms are a constant of the rule list, a few hundred rows
    met = (
        index.join(F.broadcast(terms), "trigram")
        .groupBy("k1", "k2", "need", "rule", "full").agg(F.bit_or("bit").alias("bits"))
        .where("bits = full")
    )
    return met.groupBy("k1", "k2").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _spans(rule: Rule, rank: int) -> Column:
    """Spans of a rule in ``text``, from left to right."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    tested = found
    if rule.group:
        tested = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    lengths = F.transform(F.split("text", rule.pattern, -1), F.length)
    steps = F.arrays_zip(
        lengths.alias("gap"), F.transform(found, F.length).alias("size"),
        F.transform(tested, F.length).alias("tested"),
    )
    none = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS {SPANS})").alias("spans"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        more = F.when(x["tested"] >= rule.least, F.concat(acc["spans"], F.array(span)))
        return F.struct(end.alias("at"), F.coalesce(more, acc["spans"]).alias("spans"))

    return F.aggregate(steps, none, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, text, spans): every input row as a struct, with the spans of all rules.

    Spans have start, rank (place of the rule in the list), end and kind, sorted by start, then rank.
    """
    texts = keyed(docs, text_col)
    met = candidates(texts, rules)
    none = F.expr(f"CAST(array() AS {SPANS})")
    per_rule = []
    for rank, rule in enumerate(rules):
        spans = _spans(rule, rank)
        if trigram_query(rule.pattern) == ANY:
            per_rule.append(F.when(F.col("text").rlike(rule.pattern), spans).otherwise(none))
        else:
            listed = F.col("rules").bitwiseAND(F.lit(1 << rank)) != 0
            per_rule.append(F.when(listed, spans).otherwise(none))
    return (
        texts.join(met, ["k1", "k2"], "left")
        .select("row", "text", F.array_sort(F.concat(*per_rule)).alias("spans"))
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(
    docs: DataFrame, text_col: str = "text", mark: str = "[secret]", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``docs`` with every span of a rule replaced by ``mark``; overlapping spans get one mark.

    Texts without a span, null among them, stay as they are.
    """
    found = scan(docs, text_col, rules)
    empty = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))

    def step(acc, s):
        piece = F.col("text").substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = F.array(piece, F.lit(mark))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], fresh)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc):
        rest = F.col("text").substr(acc["at"] + 1, F.length("text"))
        return F.concat(F.array_join(acc["out"], ""), rest)

    clean = F.when(F.size("spans") > 0, F.aggregate("spans", empty, step, finish)).otherwise(
        F.col(f"row.`{text_col}`")
    )
    return found.select(*[
        (clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns
    ])
