"""Match status texts to an ordered list of popular ``user+hashtag`` patterns.

The list has one entry per keyword: (org_pos, org, kw_pos, der, tag), five per watched account.
Short lists travel as one value and are walked within each row, which also works on streams;
lists of thousands of keywords meet the vocabulary of the texts (``match_patterns_indexed``,
``track_filter_indexed``). Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.text import in_parentheses, split_pattern
from pulsegrid.operators.ranking import with_position
from pulsegrid.operators.skew import lookup_join
from pulsegrid.session import cut_lineage, drop_table, shuffles_dropped

# One stream tracks at most this many tokens; more tokens make several lists.
LIST_SIZE = 400
# Longer keyword lists are not sent along with every row.
SHORT_LIST = 400
# Sizes of the grams in the index of long lists; a token takes the largest that fits it.
GRAMS = (1, 2, 3, 5, 8)
GAP = r"[ \t\n\r]+"
NO_GAP = r"[^ \t\n\r]"
# Tables of the keyword list hold several texts a row: beyond so many counted rows (some megabytes each) they are joined
# by shuffle, so that the driver never gathers a list that grows with the data.
BROADCAST_TOKENS = 20_000
# So many entries of tokens, and so many frequent words with at most MOST_SENT entries each, are sent to all tasks.
SENT_ENTRIES = 100_000
FREQUENT_WORDS = 150_000
MOST_SENT = 16
# Rows with one id and text are matched once where some come more often.
REPEATS = 10
# Tokens of more different lengths are found by grams.
LENGTHS = 16
# Between the entries of tokens without white space.
BETWEEN = " "


def keyword_list(keywords: DataFrame) -> Column:
    """The whole list as one array value (a scalar subquery), ordered by org_pos, org, kw_pos.

    The lower-case tokens are NULL when empty, so that they match nothing.
    """
    entry = F.struct(
        "org_pos", "org", "kw_pos", "der", "tag",
        F.nullif(F.lower("der"), F.lit("")).alias("der_low"),
        F.nullif(F.lower("tag"), F.lit("")).alias("tag_low"),
    )
    return keywords.agg(F.array_sort(F.collect_list(entry))).scalar()


def match_patterns(statuses: DataFrame, keywords: DataFrame) -> DataFrame:
    """Add ``patterns`` and ``orgs``; statuses that match nothing are dropped.

    Walks the list in order for each status. A keyword whose user and hashtag both occur
    gives ``(user+hashtag)`` and credits its account. Otherwise a hashtag, or else a user,
    that occurs gives ``(token)``, once per token over the whole list. Empty tokens never
    match. Without a credited account ``orgs`` is STREAM_KEYWORD.

    This is a narrow, stateless row expression: statuses are not shuffled, no
    (status, keyword) pairs are produced, and the same code runs on streams.
    """
    listed = statuses.withColumn("_entries", keyword_list(keywords))
    return listed.select(
        *statuses.columns, F.inline(pattern_result(F.col("text"), F.col("_entries")))
    )


def pattern_result(text: Column, entries: Column) -> Column:
    """Array with one (patterns, orgs) struct for a matching text, empty for any other.

    The text is lowered once: it is bound as the variable of a one-element ``transform``.
    Used below a generator, the expression is evaluated once per row and not copied into a
    pushed-down filter. "Once per token" is ``array_distinct``, which keeps first places; the
    keywords that match as a whole carry their position, so these all stay.
    """
    def occurs(low: Column, token: Column) -> Column:
        return F.coalesce(F.contains(low, token), F.lit(False))

    def occurring(low: Column) -> Column:
        listed = F.filter(entries, lambda e: occurs(low, e["der_low"]) | occurs(low, e["tag_low"]))
        return F.transform(listed, lambda e: F.struct(
            e["org"].alias("org"), e["der"].alias("der"), e["tag"].alias("tag"),
            occurs(low, e["der_low"]).alias("has_der"), occurs(low, e["tag_low"]).alias("has_tag"),
        ))

    matches = F.transform(F.array(F.lower(text)), occurring)
    return F.transform(F.filter(matches, lambda hits: F.size(hits) > 0), hit_summary)


def hit_summary(hits: Column) -> Column:
    """(patterns, orgs) of a status from its keywords (org, der, tag, has_der, has_tag) in list order."""
    def labelled(hit: Column, place: Column) -> Column:
        both = hit["has_der"] & hit["has_tag"]
        label = F.when(both, F.concat_ws("+", hit["der"], hit["tag"])).when(
            hit["has_tag"], hit["tag"]).otherwise(hit["der"])
        return F.struct(label.alias("label"), F.when(both, place).alias("place"))

    labels = F.transform(
        F.array_distinct(F.transform(hits, labelled)), lambda x: in_parentheses(x["label"])
    )
    credited = F.array_distinct(F.transform(
        F.filter(hits, lambda h: h["has_der"] & h["has_tag"]), lambda h: h["org"]
    ))
    return F.struct(
        F.array_join(labels, " & ").alias("patterns"),
        F.coalesce(F.nullif(F.array_join(credited, " & "), F.lit("")), F.lit(S.STREAM_KEYWORD)).alias("orgs"),
    )


def _grams(text: Column, size: int) -> Column:
    """Hashes of all substrings of ``size`` code points, each once.

    The lookahead makes every position a match, so the text is walked once. Equal hashes of different grams
    only add candidates.
    """
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda g: F.xxhash64(g, F.lit(size))))


def _gram_size(token: Column) -> Column:
    """The largest size of GRAMS that is not above the token's length."""
    size = F.lit(None).cast("int")
    for g in GRAMS:
        size = F.when(F.length(token) >= g, g).otherwise(size)
    return size


def _gram_join(grams: DataFrame, listed: DataFrame, rows: int) -> DataFrame:
    """``grams`` met by ``listed``, which has one row per gram: broadcast while it is counted as small."""
    if rows <= BROADCAST_TOKENS:
        return grams.join(F.broadcast(listed), "gram")
    return lookup_join(grams, listed, "gram", "inner", count_dim=False)


def pieces_by_grams(vocabulary: DataFrame, pieces: DataFrame) -> DataFrame:
    """(word, piece): the pieces that each word of the vocabulary (word, texts) holds.

    A piece stands in the index under one gram, its rarest: the grams of all pieces are counted over the words,
    weighted by the words' texts, and a piece with a gram that no word holds is dropped at once. Long pieces
    have long grams, short ones do not shorten those of others.
    """
    pieces = pieces.withColumn("size", _gram_size(F.col("piece")))
    sizes = sorted(r["size"] for r in pieces.select("size").distinct().collect())  # at most len(GRAMS) rows
    none = F.array().cast("array<bigint>")
    of_piece = cut_lineage(
        pieces.select("piece", F.explode(F.coalesce(
            *[F.when(F.col("size") == g, _grams(F.col("piece"), g)) for g in sizes], none
        )).alias("gram")), "token-grams",
    )
    of_word = vocabulary.select("word", "texts", F.explode(F.concat(
        none, *[F.coalesce(_grams(F.col("word"), g), none) for g in sizes]
    )).alias("gram"))
    counts = _gram_join(of_word, of_piece.select("gram").distinct(), of_piece.count()).groupBy("gram").agg(
        F.sum("texts").alias("n")
    )
    rarest = cut_lineage(
        of_piece.join(counts, "gram", "left").groupBy("piece")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least"))
        .filter("least.n > 0").select(F.col("least.gram").alias("gram"), "piece"), "rarest-grams",
    )
    index = rarest.groupBy("gram").agg(F.collect_list("piece").alias("pieces"))
    return (
        _gram_join(of_word.drop("texts"), index, rarest.count())
        .select("word", F.explode("pieces").alias("piece")).filter(F.contains("word", "piece")).distinct()
    )


def candidate_tokens(keyed: DataFrame, tokens: DataFrame) -> DataFrame:
    """(_key, token, is_whole): the tokens that may occur in the text of each row, at least all that do.

    A token without white space (``is_whole``) does occur. Texts and tokens are cut at white space: a token can only occur where its longest piece lies within
    a word. So pieces are looked for in the vocabulary, each word once however many texts hold it, and the
    texts meet the tokens of their words. Within the vocabulary each piece stands in an index under one
    gram only (``pieces_by_grams``). Tokens of white space only have no piece; all texts are their candidates.
    """
    low = tokens.select(F.lower("token").alias("token")).filter("token <> ''").distinct()
    parts = F.split("token", GAP)
    longest = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("piece"))))
    piece = longest["piece"]
    pieced = cut_lineage(low.select("token", piece.alias("piece"), (piece == F.col("token")).alias("is_whole")), "tokens")
    pieces = pieced.select("piece").filter("piece <> ''").distinct()
    has_blank = not pieced.filter("piece = ''").isEmpty()

    words = F.array_distinct(F.split(F.lower("text"), GAP))
    blank = F.array(F.lit("")) if has_blank else F.array().cast("array<string>")
    of_text = keyed.select("_key", F.explode(F.array_distinct(F.concat(words, blank))).alias("word"))

    vocabulary = cut_lineage(
        of_text.filter("word <> ''").groupBy("word").agg(F.count("*").alias("texts")), "vocabulary"
    )
    met = pieces_by_grams(vocabulary, pieces)
    of_blank = pieced.filter("piece = ''").select(F.col("piece").alias("word"), "piece")
    by_word = cut_lineage(
        met.unionByName(of_blank).join(pieced, "piece")
        .groupBy("word").agg(F.collect_set(F.struct("token", "is_whole")).alias("tokens")), "word-tokens",
    )
    size = by_word.select(F.sum(F.size("tokens"))).first()[0] or 0
    found = of_text.join(F.broadcast(by_word), "word") if size <= BROADCAST_TOKENS else lookup_join(
        of_text, by_word, "word", "inner")
    return found.select("_key", F.explode("tokens").alias("t")).select("_key", "t.*").distinct()


def _with_key(statuses: DataFrame) -> DataFrame:
    """Rows under a key of id and text: rows that share a key share their tokens, whatever their ids are."""
    return statuses.withColumn("_key", F.struct("status_id", F.xxhash64("text").alias("text_hash")))


def found_tokens(keyed: DataFrame, tokens: DataFrame) -> DataFrame:
    """(_key, token), once each: the tokens that occur in the text of each row, in lower case.

    Only candidates with white space are looked up in the texts again.
    """
    near = cut_lineage(candidate_tokens(keyed, tokens), "candidates")
    whole = near.filter("is_whole").select("_key", "token")
    parts = near.filter("NOT is_whole").select("_key", "token")
    if parts.isEmpty():
        return whole
    verified = keyed.select("_key", "text").join(parts, "_key").filter(F.contains(F.lower("text"), "token"))
    return whole.unionByName(verified.select("_key", "token").distinct())


def _met(facts: DataFrame, listed: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Inner join with a table of the keyword list, which is broadcast while it is counted as small.

    Beyond that Spark may still broadcast what it measures as small; a table that it sorts or hashes is dealt by key,
    and partitions of frequent tokens are split by its skew join.
    """
    return facts.join(F.broadcast(listed) if rows <= BROADCAST_TOKENS else listed, keys)


def keyword_tokens(keywords: DataFrame) -> tuple[DataFrame, int]:
    """(token, entries, leads): what a text that holds the lower-case token has to know of the keyword list.

    Places in the list are texts of equal length, to the base 36, which sort as the numbers; the length is returned, too. An entry is the place of the first keyword
    with a label, and the label; a token has one entry for each of its spellings. A lead is a keyword with two tokens,
    given to the token that fewer keywords share, so that a token that most keywords share leads few of them (of
    ``k`` keywords with different tokens at most the root of ``2 k``). It holds the entries of its labels, its own one
    and the other one, and of both the place of the next keyword with that label.
    """
    listed = with_position(
        keywords.select("org_pos", "org", "kw_pos", "der", "tag"),
        [F.col(c) for c in ("org_pos", "org", "kw_pos", "der", "tag")], "place",
    )
    count, digits = listed.count(), 1
    while 36**digits <= count:
        digits += 1
    sides = listed.select(
        F.lpad(F.conv("place", 10, 36), digits, "0").alias("place"), "org",
        F.coalesce((F.col("der") != "") & (F.col("tag") != ""), F.lit(False)).alias("is_pair"),
        F.explode(F.array_distinct(F.array("der", "tag"))).alias("label"), "der",
    ).filter("label <> ''").withColumn("token", F.lower("label"))
    by_token, by_label = Window.partitionBy("token"), Window.partitionBy("token", "label").orderBy("place")
    sides = sides.select(
        "place", "org", "is_pair", "token", F.count("*").over(by_token).alias("shared"),
        F.concat(F.first("place").over(by_label), "label").alias("entry"),
        F.lead("place").over(by_label).alias("next"), F.col("label").eqNullSafe(F.col("der")).alias("is_der"),
    )
    sides = cut_lineage(sides, "keyword-sides")

    side = F.struct("shared", (-F.length("token")).alias("size"), (~F.col("is_der")).alias("is_tag"), "token", "entry", "next")
    leads = (
        sides.filter("is_pair").groupBy("place").agg(F.max("org").alias("org"), F.min(side).alias("own"), F.max(side).alias("other"))
        .select(F.col("own.token").alias("token"), F.lit(None).cast("string").alias("entry"), F.struct(
            "place", "org", F.col("own.entry").alias("own"), F.col("other.entry").alias("other"),
            (~F.col("own.is_tag")).alias("own_is_der"), F.col("own.next").alias("own_next"), F.col("other.next").alias("other_next"),
        ).alias("lead"))
    )
    entries = sides.filter(F.startswith("entry", "place")).select("token", "entry", F.lit(None).cast(leads.schema["lead"].dataType).alias("lead"))
    tokens = cut_lineage(entries.unionByName(leads).groupBy("token").agg(
        F.collect_list("entry").alias("entries"), F.collect_list("lead").alias("leads")
    ), "keyword-tokens")
    drop_table(listed)
    drop_table(sides)
    return tokens, digits


def _summed(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """What all rows of the keys hold and lead, in one row; most words lead nothing, which is NULL and takes no room."""
    leads = F.flatten(F.collect_list("leads"))
    return rows.groupBy(*keys).agg(
        F.array_join(F.collect_list("held"), BETWEEN).alias("held"), F.when(F.size(leads) > 0, leads).alias("leads"), *more)


def words_of_tokens(vocabulary: DataFrame, tokens: DataFrame, loads: dict[int, int]) -> DataFrame:
    """(word, held, leads, load) of the words that hold a token (token, held, leads, load); ``loads``: by length of the tokens.

    Each word is cut into its pieces of the lengths that tokens have, which meet the tokens. Tokens of as many lengths as
    fit are sent to all tasks, the others are joined by shuffle. Beyond ``LENGTHS`` different lengths tokens are found by grams.
    """
    def of_words(rows: DataFrame) -> DataFrame:
        return _summed(rows, ["word"], F.sum("load").alias("load"))

    if len(loads) > LENGTHS:
        pairs = pieces_by_grams(vocabulary, tokens.select(F.col("token").alias("piece")))
        return of_words(_met(pairs.withColumnRenamed("piece", "token"), tokens, ["token"], sum(loads.values())))
    sent, total = [], 0
    for size, load in sorted(loads.items(), key=lambda x: x[1]):
        total += load
        if total <= SENT_ENTRIES:
            sent.append(size)

    def pieces(size: int) -> Column:
        places = F.sequence(F.lit(1), F.length("word") - (size - 1))
        found = F.transform(places, lambda i: F.substring("word", i, F.lit(size)))
        return F.when(F.length("word") >= size, found).otherwise(F.array().cast("array<string>"))

    def cuts(sizes: list[int]) -> DataFrame:
        return vocabulary.select("word", F.explode(F.array_distinct(F.flatten(F.array(*map(pieces, sizes))))).alias("token"))

    parts = []
    if sent:
        parts.append(cuts(sent).join(F.broadcast(tokens.filter(F.length("token").isin(sent))), "token"))
    if left := [size for size in loads if size not in sent]:
        # one row a token, spread evenly: a hash table for each part of the list, and the many pieces are not sorted
        parts.append(cuts(left).join(tokens.filter(F.length("token").isin(left)).hint("shuffle_hash"), "token"))
    return of_words(reduce(DataFrame.unionByName, [p.select("word", "held", "leads", "load") for p in parts]))


def _single_texts(texts: DataFrame) -> DataFrame:
    """Texts by their keys (_id, _text): once each where any comes often, as all that its rows hold meets in one row."""
    keys = ["_id", "_text"]
    most = texts.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    return texts if most <= REPEATS else cut_lineage(texts.dropDuplicates(keys), "single-texts")


def _plain_matches(keyed: DataFrame, tokens: DataFrame, loads: dict[int, int]) -> list[DataFrame]:
    """Tables (_id, _text, entries, leads), at most one row a text in each, by tokens without white space.

    Such a token lies within a word. What the words hold is found once for each word of the vocabulary. The most
    frequent words are sent to all tasks with it; texts meet the others by shuffle, where no word is frequent but
    those that hold very much.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"{NO_GAP}{{{min(loads)},}}+"), F.lit(0)))
    of_text = keyed.select("_id", "_text", F.explode(words).alias("word"))
    vocabulary = cut_lineage(of_text.groupBy("word").agg(F.count("*").alias("texts")), "vocabulary")
    top = cut_lineage(vocabulary.orderBy(F.desc("texts"), "word").limit(FREQUENT_WORDS), "top-words")
    frequent = cut_lineage(
        top.select("word").join(words_of_tokens(top, tokens, loads), "word", "left")
        .filter(F.coalesce("load", F.lit(0)) <= MOST_SENT), "frequent-words",
    )
    sent = F.broadcast(frequent.filter("load > 0").select("word", "held", "leads"))
    others = vocabulary.join(F.broadcast(frequent.select("word")), "word", "left_anti")
    of_other = cut_lineage(words_of_tokens(others, tokens, loads).drop("load"), "other-words")
    far = of_text.join(F.broadcast(frequent.select("word")), "word", "left_anti").join(
        of_other.hint("shuffle_hash"), "word")  # one row a word
    # rows of a text lie together among the near ones only: the others are not summed before they meet
    parts = [of_text.join(sent, "word"), far.select("_id", "_text", "held", "leads").repartition("_id", "_text")]
    return [_summed(p, ["_id", "_text"]).withColumn("entries", F.split("held", BETWEEN)).drop("held") for p in parts]


def _gapped_matches(statuses: DataFrame, tokens: DataFrame) -> DataFrame:
    """(_id, _text, entries, leads), one row a text, by tokens with white space, which are looked up in the texts."""
    found = _met(found_tokens(_with_key(statuses), tokens.select("token")), tokens, ["token"], tokens.count())
    return found.groupBy(F.xxhash64("_key.status_id").alias("_id"), F.col("_key.text_hash").alias("_text")).agg(
        F.flatten(F.collect_list("entries")).alias("entries"), F.flatten(F.collect_list("leads")).alias("leads"))


def _bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, also where the function uses it for each element of an array."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def whole_matches(entries: Column, leads: Column) -> Column:
    """The leads whose other label is among the entries, once each and in order of their places."""
    def sorted_once(found: Column) -> Column:
        return F.filter(found, lambda x, i: (i == 0) | (F.get(found, i - 1)["place"] != x["place"]))

    others = F.array_intersect(F.transform(leads, lambda x: x["other"]), entries)
    return _bound(others, lambda o: _bound(
        F.sort_array(F.filter(leads, lambda x: F.array_contains(o, x["other"]))), sorted_once))


def moved_labels(whole: Column, passed: Column) -> Column:
    """(place, entry): the labels whose first keyword matches as a whole, at the next of their keywords that does not."""
    nexts = F.flatten(F.transform(whole, lambda x: F.array(
        F.struct(x["own_next"].alias("place"), x["own"].alias("entry")),
        F.struct(x["other_next"].alias("place"), x["other"].alias("entry")),
    )))

    def open_places(taken: Column) -> Column:
        return F.sort_array(F.filter(nexts, lambda x: x["place"].isNotNull() & F.array_contains(passed, x["entry"])
                                     & ~F.array_contains(taken, x["place"])))

    def firsts(found: Column) -> Column:
        return _bound(F.transform(found, lambda x: x["entry"]), lambda labels: F.filter(
            found, lambda x, i: F.array_position(labels, x["entry"]) == i + 1))

    return _bound(F.transform(whole, lambda x: x["place"]), lambda taken: _bound(open_places(taken), firsts))


def match_hits(entries: Column, leads: Column, digits: int) -> Column:
    """(patterns, orgs) from all entries and leads of a text, which may be given more than once.

    A keyword matches as a whole where the entries hold the other label of its lead, too. A label alone stands at the first of its
    keywords that does not match as a whole: its first keyword, or else the next one behind a keyword that does.
    """
    def label(entry: Column) -> Column:
        return F.substr(entry, F.lit(digits + 1))

    def pair(x: Column) -> Column:
        own, other = label(x["own"]), label(x["other"])
        return F.concat(x["place"], F.when(x["own_is_der"], F.concat_ws("+", own, other)).otherwise(F.concat_ws("+", other, own)))

    def summary(whole: Column, passed: Column) -> Column:
        moved = F.transform(moved_labels(whole, passed), lambda x: F.concat(x["place"], label(x["entry"])))
        hits = F.sort_array(F.concat(F.array_except(entries, passed), F.transform(whole, pair), moved))
        credited = F.array_join(F.array_distinct(F.transform(whole, lambda x: x["org"])), " & ")
        return F.struct(
            in_parentheses(F.array_join(F.transform(hits, label), ") & (")).alias("patterns"),
            F.coalesce(F.nullif(credited, F.lit("")), F.lit(S.STREAM_KEYWORD)).alias("orgs"),
        )

    def passed(whole: Column) -> Column:
        return F.flatten(F.transform(whole, lambda x: F.filter(F.array(x["own"], x["other"]), lambda e: F.startswith(e, x["place"]))))

    return _bound(whole_matches(entries, leads), lambda w: _bound(passed(w), lambda p: summary(w, p)))


def match_patterns_indexed(statuses: DataFrame, keywords: DataFrame) -> DataFrame:
    """``match_patterns`` for long keyword lists; the work follows the tokens found and the result.

    What the list says of a token travels with the words that hold it, so a text meets all of it by one shuffle, and its
    keywords, labels and their order are settled within its row. Tokens with white space are looked up in the texts.
    """
    with shuffles_dropped(statuses.sparkSession):
        tokens, digits = keyword_tokens(keywords)
        has_gap, load = F.rlike("token", F.lit(GAP)), F.size("entries") + F.size("leads")
        plain = tokens.filter(~has_gap).select(
            "token", F.array_join("entries", BETWEEN).alias("held"), F.when(F.size("leads") > 0, F.col("leads")).alias("leads"),
            load.alias("load"))
        sizes = plain.groupBy(F.length("token").alias("size")).agg(F.sum("load").alias("load")).collect()
        # rows that share both hashes share their tokens, whatever their ids are
        keyed = statuses.withColumn("_id", F.xxhash64("status_id")).withColumn("_text", F.xxhash64("text"))
        texts = _single_texts(keyed.select("_id", "_text", "text"))
        parts = _plain_matches(texts, plain, {r["size"]: r["load"] for r in sizes}) if sizes else []
        gapped = tokens.filter(has_gap)
        if not parts or not gapped.isEmpty():
            parts.append(_gapped_matches(statuses, gapped))
    rows = keyed
    for i, part in enumerate(parts):
        rows = rows.join(part.withColumnsRenamed({"entries": f"_entries{i}", "leads": f"_leads{i}"}), ["_id", "_text"], "left")

    def joined(name: str) -> Column:
        none = F.array().cast(tokens.schema[name].dataType)
        return F.concat(*[F.coalesce(F.col(f"_{name}{i}"), none) for i in range(len(parts))])

    rows = rows.withColumn("_entries", joined("entries")).withColumn("_leads", joined("leads"))
    hits = match_hits(F.col("_entries"), F.col("_leads"), digits)
    return rows.filter(F.coalesce(*[F.col(f"_entries{i}") for i in range(len(parts))]).isNotNull()).withColumn(
        "_hits", hits).select(*statuses.columns, "_hits.*")


def match_keywords(statuses: DataFrame, keywords: DataFrame) -> DataFrame:
    """``match_patterns`` by the way that fits the length of the list, which is counted up to the bound."""
    if keywords.limit(SHORT_LIST + 1).count() <= SHORT_LIST:
        return match_patterns(statuses, keywords)
    return match_patterns_indexed(statuses, keywords)


def pattern_keywords(top_pairs: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """The keyword list made from ``hashtags.top_hashtags``.

    Accounts come in the order of ``order`` (original_user, org_pos), a configured list; those it
    lacks, or all without it, in name order behind.
    """
    place = F.lit(2147483647)
    if order is not None:
        top_pairs = top_pairs.join(order.select("original_user", "org_pos"), "original_user", "left")
        place = F.coalesce("org_pos", place)
    return top_pairs.select(
        place.cast("int").alias("org_pos"), F.col("original_user").alias("org"),
        F.col("position").alias("kw_pos"), F.col("derived_user").alias("der"),
        F.col("hashtag").alias("tag"),
    )


def tracked_tokens(keywords: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """All distinct keyword tokens in first-seen order, in lists of ``size`` (``list_no``).

    Tokens are ranked by ranges of that order, however many accounts and tokens there are.
    """
    tokens = keywords.select(
        "org_pos", "org", "kw_pos",
        F.posexplode(split_pattern(F.concat_ws("+", "der", "tag"))).alias("part", "token"),
    )
    first = tokens.groupBy("token").agg(
        F.min(F.struct("org_pos", "org", "kw_pos", "part")).alias("seen_at")
    ).select("token", "seen_at.*")
    ranked = with_position(first, [F.col(c) for c in ("org_pos", "org", "kw_pos", "part", "token")])
    return ranked.select(
        F.expr(f"CAST((position - 1) div {size} AS int)").alias("list_no"),
        F.col("position").cast("int").alias("position"), "token",
    )


def track_filter(statuses: DataFrame, tokens: DataFrame) -> DataFrame:
    """Statuses whose text contains any tracked token, ignoring case; for short lists.

    Short tokens are tried first: they match most often and end the search.
    """
    low = F.lower("token")
    entry = F.struct(F.length(low).alias("size"), low.alias("token"))
    wanted = tokens.agg(F.sort_array(F.collect_set(entry)).alias("all")).select("all.token").scalar()
    return (
        statuses.withColumn("_tokens", wanted)
        .filter(F.exists(
            F.array(F.lower("text")),
            lambda low: F.exists("_tokens", lambda token: F.contains(low, token)),
        ))
        .drop("_tokens")
    )


def track_filter_indexed(statuses: DataFrame, tokens: DataFrame) -> DataFrame:
    """``track_filter`` for long lists."""
    keyed = _with_key(statuses)
    keys = found_tokens(keyed, tokens).select("_key").distinct()
    return keyed.join(keys, "_key", "left_semi").select(statuses.columns)
