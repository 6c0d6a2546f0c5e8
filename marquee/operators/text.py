"""Text operators that need a table beside the text: tagging, lemmas, hashtag words."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import session
from marquee.functions.tokens import ENGLISH_STOPWORDS, casual_tokenize, clean_tokens, pos_to_wordnet
from marquee.operators.joins import dictionary_join
from marquee.operators.tagging import TagModel, context_tags, relisted, settled
from marquee.session import TABLE_ROWS, cut_lineage, fits_broadcast, more_than, reach_package, small_batches

MAX_WORD = 24  # default for the longest piece a hashtag is split into

# Endings of inflected words and what the base form has instead, by word class
ENDINGS = {
    "n": (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")),
    "v": (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")),
    "a": (("er", ""), ("est", ""), ("er", "e"), ("est", "e")),
}


def token_rows(df: DataFrame, key: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """One row per token: key, ``pos`` from 0, ``token``.

    An outer explode with a filter on its result: a plain one would have Spark test the size of the
    array first, and make the tokens twice for it.
    """
    rows = df.select(*key, F.posexplode_outer(tokens).alias("pos", "token"))
    return rows.filter(F.col("pos").isNotNull())


def _one_per_key(table: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """One ``value`` a key: the most frequent, by a count column ``n`` or the number of rows; of equal ones the least."""
    n = F.sum("n") if "n" in table.columns else F.count(F.lit(1))
    counted = table.groupBy(*key, value).agg(n.alias("n"))
    return cut_lineage(counted.groupBy(*key).agg(F.min_by(value, F.struct(-F.col("n"), value)).alias(value)))


def pos_lookup(rows: DataFrame, lexicon: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Add ``tag``: the most frequent tag of the token by ``lexicon(token, tag[, n])``, else ``NN``."""
    tagged = dictionary_join(rows, _one_per_key(lexicon, ["token"], "tag"), ["token"], spread)
    return tagged.withColumn("tag", F.coalesce("tag", F.lit("NN")))


def base_forms(token: Column, wordclass: Column) -> Column:
    """What a token of a word class may be a form of: itself, then the token with each ending of the class replaced."""
    by_class = F.when(F.lit(False), F.array(token))
    for letter, endings in ENDINGS.items():
        made = [
            F.when(token.endswith(ending), F.concat(F.left(token, F.length(token) - len(ending)), F.lit(put)))
            for ending, put in endings
        ]
        by_class = by_class.when(wordclass == letter, F.array(token, *made))
    return by_class.otherwise(F.array(token))


def ending_lemmas(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``token, wordclass, lemma`` of each distinct token of ``tokens(token, wordclass)`` that is a form of a known word.

    ``words(word, wordclass)`` are the known base forms. Of several known forms the shortest is the lemma; of equally
    short ones the token itself, then the one of the earlier ending. Endings are replaced once. Only distinct tokens
    are shuffled, not their occurrences. Null words and tokens match nothing.
    """
    known = cut_lineage(words.select("word", "wordclass").dropna().distinct().withColumn("is_word", F.lit(True)))
    distinct = tokens.select("token", "wordclass").distinct()
    forms = distinct.select("token", "wordclass", F.posexplode(base_forms(F.col("token"), F.col("wordclass"))).alias("place", "word"))
    found = dictionary_join(forms.filter("word <> ''"), known, ["word", "wordclass"], ["token"]).filter("is_word")
    return cut_lineage(
        found.groupBy("token", "wordclass").agg(F.min_by("word", F.struct(F.length("word"), "place")).alias("lemma"))
    )


def lemma_lookup(
    rows: DataFrame, lemmas: DataFrame | None, spread: Sequence[str], words: DataFrame | None = None
) -> DataFrame:
    """Add ``lemma``: the most frequent one by ``lemmas(token, wordclass, lemma[, n])``, else that of the ending, else the token.

    ``words(word, wordclass)`` holds base forms; without it no ending is looked at (see ``ending_lemmas``).
    """
    if lemmas is not None:
        known = _one_per_key(lemmas, ["token", "wordclass"], "lemma")
        found = dictionary_join(rows, known, ["token", "wordclass"], spread)
    else:
        found = rows.withColumn("lemma", F.lit(None).cast("string"))
    if words is not None:
        by_ending = ending_lemmas(rows, words).withColumnRenamed("lemma", "_by_ending")
        found = dictionary_join(found, by_ending, ["token", "wordclass"], spread)
        found = found.withColumn("lemma", F.coalesce("lemma", "_by_ending")).drop("_by_ending")
    return found.withColumn("lemma", F.coalesce("lemma", "token"))


def _replaced(tokens: pa.ListArray, classes: pa.ListArray | None, forms: pa.Table) -> pa.ListArray:
    """Lists of tokens with those that ``forms`` (token[, wordclass], lemma) has replaced by the lemma."""
    flat = tokens.flatten()
    asked, known = flat, forms["token"].combine_chunks()
    if classes is not None:
        asked = pc.binary_join_element_wise(flat, classes.flatten(), "\0")
        known = pc.binary_join_element_wise(known, forms["wordclass"].combine_chunks(), "\0")
    lemmas = pc.take(forms["lemma"].combine_chunks(), pc.index_in(asked, value_set=known))
    return relisted(tokens, pc.coalesce(lemmas, flat))


def _put_lemmas(df: DataFrame, forms: DataFrame, tokens: str, classes: Column | None) -> DataFrame:
    """Replace tokens by a table of forms that every task holds; rows stay where they are."""
    table = small_batches(reach_package(df.sparkSession)).sparkContext.broadcast(forms.toArrow())

    @F.arrow_udf("array<string>")
    def by_token(lists: pa.Array) -> pa.Array:
        return _replaced(lists, None, table.value)

    @F.arrow_udf("array<string>")
    def by_class(lists: pa.Array, classes: pa.Array) -> pa.Array:
        return _replaced(lists, classes, table.value)

    # as if not deterministic: else Spark may put it into a later lambda, where it can't be called
    if classes is None:
        return df.withColumn(tokens, settled(tokens)).withColumn(tokens, by_token.asNondeterministic()(tokens))
    df = df.withColumns({tokens: settled(tokens), "_classes": settled(classes)})
    return df.withColumn(tokens, by_class.asNondeterministic()(tokens, "_classes"))


def lemmatize(
    df: DataFrame,
    key: Sequence[str],
    lemmas: DataFrame | None,
    lexicon: DataFrame | None = None,
    tokens: str = "tokens",
    words: DataFrame | None = None,
    context: TagModel | None = None,
) -> DataFrame:
    """Replace each token by its lemma, given its word class.

    Word classes come from tags in context where a ``context`` model is given, else from the ``lexicon``, else all are
    nouns. ``lemmas`` is looked at first (irregular forms), then endings are taken off to reach a base form in ``words``.
    Tags and lemmas are looked up for distinct tokens, those of a small table of lemmas where no endings are asked for, else
    those of the rows. A table of the tokens that change which is measured small is sent to the tasks, and rows stay where they
    are: nothing is shuffled or written. For a few rows, or a larger table, every row gets a number of its own, written once, so
    rows that share ``key`` stay apart; the tokens of a row meet only that table, and only the changed ones are brought back to
    their row, by number and position.
    """
    columns = df.columns
    if context is not None:
        df = context_tags(df, context, tokens, "_context_tags")

    def uses_of(df: DataFrame, *key: str) -> DataFrame:
        if context is None:
            uses = df.select(*key, F.posexplode_outer(tokens).alias("pos", "token"))
        else:
            pairs = F.arrays_zip(F.col(tokens).alias("token"), F.col("_context_tags").alias("tag"))
            uses = df.select(*key, F.posexplode_outer(pairs).alias("pos", "_pair"))
            uses = uses.select(*key, "pos", "_pair.token", pos_to_wordnet(F.col("_pair.tag")).alias("wordclass"))
        return uses.filter(F.col("token").isNotNull())

    def changed(distinct: DataFrame) -> DataFrame:
        if context is None and lexicon is not None:
            distinct = pos_lookup(distinct, lexicon, keys).withColumn("wordclass", pos_to_wordnet("tag"))
        elif context is None:
            distinct = distinct.withColumn("wordclass", F.lit("n"))
        forms = lemma_lookup(distinct, lemmas, ["token"], words).filter(F.col("lemma") != F.col("token"))
        return cut_lineage(forms.select(*keys, "lemma"))

    keys, forms = ["token"] if context is None else ["token", "wordclass"], None
    if more_than(df, session.FEW_ROWS):
        if words is None and fits_broadcast(lemmas.select(*keys), TABLE_ROWS):
            forms = changed(lemmas.select(*keys).dropna().distinct())
        else:
            forms = changed(cut_lineage(uses_of(df).select(*keys).distinct()))
        if fits_broadcast(forms, TABLE_ROWS):
            classes = F.transform("_context_tags", pos_to_wordnet) if context is not None else None
            return _put_lemmas(df, forms, tokens, classes).select(*columns)
    docs = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    uses = uses_of(docs, "_row")
    if forms is None:
        forms = changed(cut_lineage(uses.select(*keys).distinct()))
    found = dictionary_join(uses, forms, keys, ["_row", "pos"]).filter(F.col("lemma").isNotNull())
    changes = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("pos", "lemma"))).alias("_changes"))
    begin = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("lemma")))
    ends = F.concat(F.transform("_changes", lambda c: c["pos"]), F.array(F.size(tokens)))
    # each changed token with the run of tokens after it: every token is taken once
    runs = F.zip_with(
        F.concat(begin, F.col("_changes")),
        ends,
        lambda c, end: F.concat(
            F.when(c["pos"] >= 0, F.array(c["lemma"])).otherwise(F.array().cast("array<string>")),
            F.slice(tokens, c["pos"] + F.lit(2), end - c["pos"] - F.lit(1)),
        ),
    )
    new_tokens = F.when(F.col("_changes").isNull(), F.col(tokens)).otherwise(F.flatten(runs))
    return docs.join(changes.hint("merge"), "_row", "left").withColumn(tokens, new_tokens).select(*columns)


def tokenize_posts(
    df: DataFrame,
    text: str = "tweet_text",
    *,
    key: Sequence[str] = ("title", "tweet_id"),
    out: str = "tokens",
    lexicon: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    stopwords: Sequence[str] = ENGLISH_STOPWORDS,
    words: DataFrame | None = None,
    context: TagModel | None = None,
) -> DataFrame:
    """Model tokens of a post: tokenize, lemmatize, mark negation, filter, drop stopwords.

    ``lexicon``, ``lemmas`` and ``words`` are the user's tables, ``context`` the model of the user's tagged texts; without
    ``lemmas`` and ``words`` every token is its own lemma.
    """
    tokens = df.withColumn(out, casual_tokenize(text))
    if lemmas is not None or words is not None:
        tokens = lemmatize(tokens, key, lemmas, lexicon, out, words, context)
    return tokens.withColumn(out, clean_tokens(out, stopwords))


def _tag_text(element: Column) -> Column:
    """A hashtag as the lower-case letters and digits to split."""
    return F.regexp_replace(F.lower(element), "[^a-z0-9]", "")


def _best_split(tag: str, spans: list[dict], pairs: list[dict] | None, total: float) -> list[str]:
    """Words of the most probable split of ``tag``.

    ``spans`` are the pieces that are words (start, end, score: log10 of their share). A piece that is no word, of up to the
    longest piece's length, costs more the longer it is. ``pairs`` are neighbouring words that are known as a pair
    (start, middle, end, score: log10 of the pair's share of its first word); the second one then costs that instead. Keeps
    the best score of every last piece, and the best one of every end.
    """
    longest, scores = spans[0]["limit"], {(s["start"], s["end"]): s["score"] for s in spans if s["score"] is not None}
    after: dict[tuple[int, int], dict[int, float]] = {}
    for pair in pairs if pairs is not None else ():
        after.setdefault((pair["middle"], pair["end"]), {})[pair["start"]] = pair["score"]
    unknown = 1.0 - math.log10(total)
    pieces: list[dict[int, tuple[float, int | None]]] = [{}]  # by end and start: score, start of the piece before
    best = [(0.0, 0)]
    for end in range(1, len(tag) + 1):
        mine: dict[int, tuple[float, int | None]] = {}
        for start in range(max(0, end - longest), end):
            own = scores.get((start, end), unknown - (end - start))
            known = after.get((start, end))
            if not known:
                mine[start] = (best[start][0] + own, best[start][1] if start else None)
            else:
                mine[start] = max((score + known.get(before, own), before) for before, (score, _) in pieces[start].items())
        pieces.append(mine)
        best.append(max((score, start) for start, (score, _) in mine.items()))
    words, end = [], len(tag)
    start = best[end][1]
    while end:
        words.append(tag[start:end])
        start, end = pieces[end][start][1], start
    return words[::-1]


def _split_all(tags: pd.Series, spans: pd.Series, pairs: pd.Series, total: pd.Series) -> pd.Series:
    return pd.Series([_best_split(t, s, p, n) for t, s, p, n in zip(tags, spans, pairs, total, strict=True)], dtype=object)


def word_pairs(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``first, second, n``: how often a word follows another one; counted within documents before the shuffle."""
    runs = F.zip_with(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("first"), b.alias("second")))
    return docs.filter(F.size(tokens) > 1).select(F.inline(runs)).groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))


def _known_pairs(known: DataFrame, word_counts: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """``tag, pairs``: neighbouring pieces of each tag that the pair table knows, scored by their share of the first word."""
    firsts = word_counts.select(F.col("word").alias("first"), F.col("n").alias("n_first"))
    shares = pair_counts.join(firsts, "first").select("first", "second", F.log10(F.col("n") / F.col("n_first")).alias("pair_score"))
    words = known.filter(F.col("score").isNotNull())
    left = words.select("tag", "start", F.col("end").alias("middle"), F.col("word").alias("first"))
    right = words.select("tag", F.col("start").alias("middle"), "end", F.col("word").alias("second"))
    found = dictionary_join(left.join(right.hint("merge"), ["tag", "middle"]), cut_lineage(shares), ["first", "second"], ["tag", "middle"])
    found = found.filter(F.col("pair_score").isNotNull())
    return found.groupBy("tag").agg(F.collect_list(F.struct("start", "middle", "end", F.col("pair_score").alias("score"))).alias("pairs"))


def hashtag_words(tags: DataFrame, word_counts: DataFrame, max_word: int = MAX_WORD, pair_counts: DataFrame | None = None) -> DataFrame:
    """``tag, words`` for distinct ``tag`` texts, from ``word_counts(word, n)`` and, if given, ``pair_counts(first, second, n)``.

    Each word of a split counts with its share of all words, or, where it and the word before are a known pair, with the
    pair's share of the word before. Pieces of up to ``max_word`` characters are joined with the words; the best split of a tag then takes time in
    proportion to its length.
    """
    size = word_counts.agg(F.sum("n").cast("double")).scalar()
    logs = word_counts.select("word", F.log10(F.col("n") / size).alias("score"))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.length("tag") - F.lit(1)),
            lambda start: F.transform(
                F.sequence(start + F.lit(1), F.least(start + F.lit(max_word), F.length("tag"))),
                lambda end: F.struct(start.alias("start"), end.alias("end"), F.substring(F.col("tag"), start + F.lit(1), end - start).alias("word")),
            ),
        )
    )
    pieces = tags.filter(F.length("tag") > 0).select("tag", F.inline(spans))
    known = dictionary_join(pieces, logs, ["word"], ["tag", "start", "end"])
    # one piece without a score keeps a tag that holds no word; the rest is written, as the pairs are made of it too
    known = cut_lineage(known.filter(F.col("score").isNotNull() | ((F.col("start") == 0) & (F.col("end") == 1))))
    found = known.groupBy("tag").agg(F.collect_list(F.struct("start", "end", "score", F.lit(max_word).alias("limit"))).alias("spans"))
    if pair_counts is not None:
        found = found.join(_known_pairs(known, word_counts, pair_counts).hint("merge"), "tag", "left")
    else:
        found = found.withColumn("pairs", F.lit(None).cast("array<struct<start:int,middle:int,end:int,score:double>>"))
    split = F.pandas_udf(_split_all, "array<string>")("tag", "spans", "pairs", F.coalesce(size, F.lit(1.0)))
    empty = tags.filter(F.length("tag") == 0).select("tag", F.array().cast("array<string>").alias("words"))
    return found.select("tag", split.alias("words")).unionByName(empty)


def segment_hashtags(
    df: DataFrame,
    word_counts: DataFrame,
    *,
    key: Sequence[str] = (),
    text: str = "tweet_text",
    max_word: int = MAX_WORD,
    pair_counts: DataFrame | None = None,
) -> DataFrame:
    """Replace each space-separated element that holds ``#`` by its words (``hashtag_words``); the rest stays as it is.

    Only the distinct tags are split; the texts get them back by one join on tag rows (broadcast when
    small, else salted) and one on a number of their own, written once, so rows whose key is null or repeated are
    treated like others. ``key`` is not needed any more.
    """
    key = ["_row"]
    columns, df = df.columns, cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    elements = F.split(F.col(text), " ", -1)
    tagged = df.filter(F.contains(F.col(text), F.lit("#")))
    uses = tagged.select(
        *key,
        F.explode(
            F.array_distinct(F.transform(F.filter(elements, lambda e: F.contains(e, F.lit("#"))), _tag_text))
        ).alias("tag"),
    ).distinct()
    split = cut_lineage(hashtag_words(uses.select("tag").distinct(), word_counts, max_word, pair_counts))
    replaced = (
        dictionary_join(uses, split, ["tag"], key)
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("tag", "words"))).alias("_words"))
    )
    new_text = F.array_join(
        F.flatten(
            F.transform(
                elements,
                lambda e: F.when(
                    F.contains(e, F.lit("#")), F.element_at(F.col("_words"), _tag_text(e))
                ).otherwise(F.array(e)),
            )
        ),
        " ",
    )
    return (
        df.join(replaced.hint("merge"), key, "left")
        .withColumn(text, F.when(F.col("_words").isNotNull(), new_text).otherwise(F.col(text)))
        .drop("_words")
        .select(*columns)
    )
