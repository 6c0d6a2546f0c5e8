"""Tokenizers and token filters as columns over ``array<string>``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.entities import decode_entities, let, unescape_html
from marquee.functions.patterns import (
    BEFORE_END,
    CASUAL_EMOTICON,
    CASUAL_HANDLE,
    CASUAL_TOKEN,
    CONTRACTION,
    EDGE_LEFT,
    EDGE_RIGHT,
    LONG_RUN,
    MARK,
    PLAIN_MARK,
    REST_FORM,
    any_of,
    first_pass,
    plain_words,
    protected_kinds,
    protected_pattern,
    second_pass,
)
from marquee.functions.scalars import SPACE_CHARS, strip_space

# --- Fixed values: word lists and token patterns -----------------------------------------------

NEGATORS = (
    "never no nothing nowhere noone none not havent hasnt hadnt cant couldnt shouldnt wont wouldnt "
    "dont doesnt didnt isnt arent aint"
).split()
CLAUSE_MARKS = [".", ":", ";", "!", "?"]
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""

ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma "
    "mightn mustn needn shan shouldn wasn weren won wouldn"
).split()

DROPPED_TOKEN = (
    rf"^(?:{PUNCTUATION}(?:_NEG)?\z"  # one punctuation mark
    r"|[\p{Nd},.]+(?:_NEG)?\z"  # a number
    r"|[\p{L}\p{N}_]{1,2}(?:_NEG)?\z)"  # one or two letters
)

# --- end of fixed values -----------------------------------------------------------------------


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def casual_tokenize(col: Column | str, lower_first: bool = True) -> Column:
    """Tokens of a casual post.

    Handles are dropped, runs of three or more equal characters are cut to three, and letters are
    lower-cased except in emoticons. ``lower_first`` lower-cases the whole text before all else, as a
    text vectorizer does by default.
    """
    text = F.lower(_col(col)) if lower_first else _col(col)
    text = decode_entities(text)
    text = F.regexp_replace(text, CASUAL_HANDLE, " ")
    text = F.regexp_replace(text, r"(?s)(.)\1{2,}", "$1$1$1")
    tokens = F.regexp_extract_all(text, F.lit(CASUAL_TOKEN), F.lit(1))
    if lower_first:
        return tokens
    return F.transform(
        tokens, lambda t: F.when(t.rlike(rf"^{CASUAL_EMOTICON}\z"), t).otherwise(F.lower(t))
    )


def pos_to_wordnet(tag: Column | str) -> Column:
    """Treebank tag to the letter of its word class: a, v, r, else n."""
    tag = _col(tag)
    classes = F.when(tag.startswith("J"), "a").when(tag.startswith("V"), "v").when(tag.startswith("R"), "r")
    return classes.otherwise("n")


def is_negator(token: Column) -> Column:
    return token.isin(*NEGATORS) | token.contains("n't")


def is_clause_mark(token: Column) -> Column:
    return token.isin(*CLAUSE_MARKS)


def mark_negation(tokens: Column | str) -> Column:
    """Append ``_NEG`` to the tokens between a negator and the next clause mark.

    The opening negator and the mark stay bare; a second negator inside is marked. The list is cut
    after each negator, and what comes before the first clause mark of such a piece is marked, so
    the work is linear in the number of tokens. Lists without a negator are passed through.
    """

    def mark(toks: Column) -> Column:
        starts = F.filter(
            F.transform(toks, lambda t, i: F.when(is_negator(t), i + F.lit(1))), lambda i: i.isNotNull()
        )

        def pieces(lows: Column) -> Column:
            bounds = F.zip_with(
                lows,
                F.concat(F.slice(lows, F.lit(2), F.size(lows) - F.lit(1)), F.array(F.size(toks))),
                lambda lo, hi: F.struct(lo.alias("lo"), (hi - lo).alias("n")),
            )
            marked = F.transform(bounds, lambda b: let(F.slice(toks, b["lo"] + F.lit(1), b["n"]), mark_piece))
            return F.concat(F.slice(toks, F.lit(1), F.get(lows, F.lit(0))), F.flatten(marked))

        return let(starts, pieces)

    def mark_piece(piece: Column) -> Column:
        first = F.array_position(F.transform(piece, is_clause_mark), F.lit(True)).cast("int")
        negated = lambda t: F.concat(t, F.lit("_NEG"))

        def cut(end: Column) -> Column:
            return F.when(end == 0, F.transform(piece, negated)).otherwise(
                F.concat(
                    F.transform(F.slice(piece, F.lit(1), end - F.lit(1)), negated),
                    F.slice(piece, end, F.size(piece)),
                )
            )

        return let(first, cut)

    return let(_col(tokens), lambda toks: F.when(F.exists(toks, is_negator), mark(toks)).otherwise(toks))


def unmark_emoticons(tokens: Column | str) -> Column:
    """Take ``_NEG`` off again where it follows two or more punctuation marks."""
    bare = lambda t: F.regexp_replace(t, rf"({PUNCTUATION}{{2,}})_NEG", "$1")
    return F.transform(_col(tokens), lambda t: F.when(F.contains(t, F.lit("_NEG")), bare(t)).otherwise(t))


def filter_tokens(tokens: Column | str) -> Column:
    """Drop single punctuation marks, numbers, and words of one or two letters, marked or not."""


    def stays(t: Column) -> Column:
        word = (t >= "a") & (t < "{") & (F.length(t) > 2) & ~t.endswith("_NEG")  # starts with a to z: needs no pattern
        return word | ~t.rlike(DROPPED_TOKEN)

    return F.filter(_col(tokens), stays)


def remove_stopwords(tokens: Column | str, words: Sequence[str] = ENGLISH_STOPWORDS) -> Column:
    """Drop stopwords, also where they carry ``_NEG``."""
    marked = [w + "_NEG" for w in words]
    return F.filter(_col(tokens), lambda t: ~t.isin(*words, *marked))


def ngrams(tokens: Column | str, low: int = 1, high: int = 2) -> Column:
    """Runs of ``low`` to ``high`` neighbours joined by a space, shorter runs first."""

    def build(toks: Column) -> Column:
        parts = []
        for n in range(low, high + 1):
            if n == 1:
                parts.append(toks)
                continue
            count = F.greatest(F.size(toks) - F.lit(n - 1), F.lit(0))
            run = F.slice(toks, F.lit(1), count)
            for k in range(2, n + 1):
                run = F.zip_with(run, F.slice(toks, F.lit(k), count), lambda a, b: F.concat_ws(" ", a, b))
            parts.append(run)
        return F.concat(*parts)

    return _col(tokens) if (low, high) == (1, 1) else let(_col(tokens), build)


def squeeze_whitespace(col: Column | str) -> Column:
    """Any run of white space to one space; strip."""
    return F.trim(F.regexp_replace(_col(col), rf"[{SPACE_CHARS}\x{{180E}}]+", " "))


def split_edge_punct(col: Column | str) -> Column:
    """Set quotes, brackets, ``*`` and ``&`` apart from a word they open or close."""
    left = F.regexp_replace(_col(col), EDGE_LEFT, "$1$2 $3")
    return F.regexp_replace(left, EDGE_RIGHT, "$1 $2$3")


def protected_spans(col: Column | str, kind: str | None = None) -> Column:
    """Spans the raw tokenizer keeps whole, in order; or all matches of one kind on its own.

    Plain words, in which no span starts, are passed over first; they leave an empty group, and no span is empty.
    """
    kinds = protected_kinds()
    if kind:
        return F.regexp_extract_all(_col(col), F.lit(kinds[kind]), F.lit(0))
    pattern = rf"{plain_words()}|({any_of(PLAIN_MARK, *kinds.values())})"
    return F.filter(F.regexp_extract_all(_col(col), F.lit(pattern), F.lit(1)), lambda t: t != "")


def split_tokens(col: Column | str, pattern: str | None = None) -> Column:
    """Split on spaces, with each protected span (URL, emoticon, number, ...) kept as one token.

    No protected span has a space inside, so setting them off by spaces is enough. Texts with a run of
    512 characters or more without a space are read in two passes, so that no run is searched again from each of its spans.
    """
    text = _col(col)

    def pieces(spaced: Column) -> Column:
        return F.filter(F.split(strip_space(spaced), rf"[{SPACE_CHARS}]* [{SPACE_CHARS}]*"), lambda t: t != "")

    if pattern:
        return pieces(F.regexp_replace(text, pattern, " $0 "))
    spaced = F.regexp_replace(text, protected_pattern(), " $0 ")
    return F.when(text.rlike(LONG_RUN), _long_pieces(text, pieces)).otherwise(pieces(spaced))


def _long_pieces(text: Column, pieces: Callable[[Column], Column]) -> Column:
    marked = F.regexp_replace(text, first_pass(), REST_FORM)

    def opened(piece: Column) -> Column:
        rest = F.concat(F.when(piece.startswith(MARK + BEFORE_END), " ").otherwise(""), F.translate(piece, MARK + BEFORE_END, ""))

        def read_without(*kinds: str) -> Column:
            return F.regexp_replace(rest, second_pass(("apostrophe_word", *kinds)), " $0 ")

        spaced = F.when(~rest.contains("."), read_without("email", "host")).when(~rest.contains("@"), read_without("email")).otherwise(read_without())
        read = pieces(F.substring(spaced, 2, 2**31 - 1))
        kept = F.filter(F.array(strip_space(piece)), lambda t: t != "")
        return F.when(piece.startswith(MARK), read).otherwise(kept)

    return F.flatten(F.transform(F.split(marked, " "), opened))


def tokenize_raw(col: Column | str, pattern: str | None = None) -> Column:
    """Raw post text to tokens: decode entities, squeeze space, split edge punctuation, split."""
    return split_tokens(split_edge_punct(squeeze_whitespace(unescape_html(col))), pattern)


def split_contraction(tokens: Column | str) -> Column:
    """``don't`` to ``do``, ``n't`` and the like."""
    return F.flatten(
        F.transform(
            _col(tokens),
            lambda t: F.when(
                t.rlike(CONTRACTION),
                F.array(F.regexp_extract(t, CONTRACTION, 1), F.regexp_extract(t, CONTRACTION, 2)),
            ).otherwise(F.array(t)),
        )
    )


def clean_tokens(tokens: Column | str, stopwords: Sequence[str] = ENGLISH_STOPWORDS) -> Column:
    """Negation, emoticons, filter and stopwords, in that order."""
    return remove_stopwords(filter_tokens(unmark_emoticons(mark_negation(tokens))), stopwords)


def apply_tokenizer(
    col: Column | str,
    tokenizer: Callable[[Column], Column],
    preprocessor: Callable[[Column], Column] | None = F.lower,
) -> Column:
    """Any ``Column -> Column`` tokenizer after any preprocessor.

    The preprocessor replaces the default lower-casing; ``None`` keeps the text as it is. Python code
    fits in as a pandas UDF.
    """
    text = _col(col)
    return tokenizer(preprocessor(text) if preprocessor else text)
