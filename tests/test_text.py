"""Hand-written rows for the text columns."""

import html
import random
import time
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from marquee.functions import scalars as S
from marquee.functions import tokens as T
from marquee.functions.patterns import protected_kinds
from marquee.operators import text as X


def column(spark, texts, build):
    """Values of ``build('t')`` for each text, in order."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.o for r in rows.select("i", build("t").alias("o")).orderBy("i").collect()]


RAW = {
    "": [],
    ".": ["."],
    "it's 'so' good": ["it's", "'", "so", "'", "good"],
    "see http://t.co/abc. ok": ["see", "http://t.co/abc", ".", "ok"],
    "(www.foo.com)": ["(", "www.foo.com", ")"],
    "go to foo.bar.co.uk/x?y=z, now": ["go", "to", "foo.bar.co.uk/x?y=z", ",", "now"],
    "not.a url.zq here": ["not", ".", "a", "url", ".", "zq", "here"],
    "mail [e@f.de] or me@x.org.": ["mail", "[", "e@f.de", "]", "or", "me@x.org", "."],
    "at 12:30:15 or 7:05pm": ["at", "12:30:15", "or", "7:05", "pm"],
    "1,234,567 and 1,234.50 and 12,34": ["1,234,567", "and", "1,234", ".", "50", "and", "12", ",", "34"],
    "$7.50 or 3.5% of €1.2": ["$7.50", "or", "3.5%", "of", "€1.2"],
    ":-) :D D: ;P =] o.O O_o ^_^ (^o^) T_T >_<": [
        ":-)", ":D", "D:", ";P", "=]", "o.O", "O_o", "^_^", "(^o^)", "T_T", ">_<",
    ],
    "hm :-(( and (: there": ["hm", ":-((", "and", "(:", "there"],
    "<3 </3 <3<3 ->  <--": ["<3", "</3", "<3<3", "->", "<--"],
    "&amp;amp; &lt;3 AT&amp;T": ["&", "<3", "AT&T"],
    "what?!... no…": ["what", "?!...", "no", "…"],
    "U.S. and U.S.A, e.g. Dr. Who vs. Mr. X": [
        "U.S.", "and", "U.S.A", ",", "e.g.", "Dr.", "Who", "vs", ".", "Mr.", "X",
    ],
    "a--b ~ c=z — e": ["a", "--", "b", "~", "c", "=", "z", "—", "e"],
    "c=d": ["c", "=d"],
    "♫♪ ★★ ♥ ok": ["♫♪", "★★", "♥", "ok"],
    "don't rock'n'roll dogs' ’tis": ["don't", "rock'n'roll", "dogs", "'", "’", "tis"],
    "(#tag) #a1_b #é @name (@name2)": ["(", "#tag", ")", "#a1_b", "#é", "@name", "(", "@name2", ")"],
    "line\none\t two  three": ["line", "one", "two", "three"],
    "été à la plage": ["été", "à", "la", "plage"],
    "hello!world": ["hello", "!", "world"],
}


def test_raw_tokens(spark):
    assert column(spark, list(RAW), T.tokenize_raw) == list(RAW.values())
    assert column(spark, [None], T.tokenize_raw) == [None]


def test_raw_tokens_keep_every_character(spark):
    rng = random.Random(7)
    parts = ["a", "B", "é", "日", " ", "  ", ".", ",", "'", '"', ":", ";", "-", "_", "(", ")", "<", ">", "3", "1", "#", "@",
             "o.O", "^_^", "http://", "www.", ".com", "don't", "U.", "~", "=", "*", "/", "|", "D", "&", "♥", "0", "x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(800)]
    for text, tokens in zip(texts, column(spark, texts, T.split_tokens)):
        assert "".join(tokens) == text.replace(" ", ""), text


def test_passing_over_plain_words_changes_nothing(spark):
    from marquee.functions.patterns import any_of

    rng = random.Random(8)
    parts = ["word", "Mr", "Dr.", "Sen.", "rep", "st.", "a", "U.S", "b.", "foo.com", "ok,", "why?", "end.", "etc..", "é", "naïve",
             "don't", ":-)", "x.y", "no.we", "(see", "him)", '"hi"', "o.O", "T.T", "ヽ", "1.5", "#tag", "D,:", "oo?;", "D?", "S;", "o:", "-"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    slow = any_of(*protected_kinds().values())
    fast = column(spark, texts, T.split_tokens)
    assert fast == column(spark, texts, lambda t: T.split_tokens(t, slow))


@pytest.mark.parametrize("unit", ["^_^", "T_T", "0.0", "^-^", ";-;", "x_x", "♥.♥", "<._.>", "<-.->", "\\\\", "＼", "ヽ", "--'", "*_*", "o.O", "(;", "<;"])
def test_long_runs_of_faces_take_time_in_proportion(spark, unit):
    texts = [begin + unit * 10_000 + end for begin in ("<", "(", "~", "") for end in ("", ">", ")", " x")]
    start = time.monotonic()
    for text, tokens in zip(texts, column(spark, texts, T.tokenize_raw), strict=True):
        assert "".join(tokens) == text.replace(" ", "")
    assert time.monotonic() - start < 2 * len(texts)


def test_long_runs_of_faces_take_four_times_as_long_for_four_times_the_length(spark):
    units = ["^_^", "*_*", "x_x", "<-.->", "♥a", "~a", "#a", "a-b"]
    column(spark, ["x" * 600], T.tokenize_raw)
    took = []
    for times in (10_000, 40_000):
        start = time.monotonic()
        for text, tokens in zip(texts := ["'" + unit * times for unit in units], column(spark, texts, T.tokenize_raw), strict=True):
            assert "".join(tokens) == text
        took.append(time.monotonic() - start)
    assert took[1] < 8 * took[0]


def test_long_runs_are_read_like_short_ones(spark):
    """Two passes over a long run give the tokens of one pass over it."""
    from marquee.functions.patterns import protected_pattern

    rng = random.Random(9)
    parts = ["a", "é", "日", ".", ",", "'", '"', ":", "-", "_", "(", "<", ">", "3", "#", "@", "o.O", "^_^", "http://", "www.", ".com", "-b",
             "don't", "U.", "~", "=", "*", "|", "D", "&", "♥", "e@f.de", "foo.com", "Mr.", "*_*", "2:30", "1,234", "’", "U.S.A", "x" * 30]
    texts = [rng.choice([" ", "  ", " \t"]).join("".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 400]))) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    texts += ["x" * 600 + end for end in ("", "'a", "a'b", "@b.de", ".com/it's", "'", " U.S.A", "\t ok")]
    assert column(spark, texts, T.split_tokens) == column(spark, texts, lambda t: T.split_tokens(t, protected_pattern()))


@pytest.mark.parametrize("unit", ["-", "<", ".", "=-", "*;", "a-b", "1,234,", "1.", "U.", "(;-;", "日本", "ab1", "<3", "!'"])
def test_long_runs_do_not_exhaust_the_stack(spark, unit):
    text = "(" + unit * (4000 // len(unit))
    tokens, casual = column(spark, [text], lambda t: F.struct(T.tokenize_raw(t), T.casual_tokenize(t)))[0]
    assert tokens and casual




CASUAL = {
    "": [],
    "@bob Soooooo GOOD!!! :-D": ["sooo", "good", "!", "!", "!", ":-d"],
    "check https://t.co/x?y=1, now": ["check", "https://t.co/x?y=1", ",", "now"],
    "don't well-known #movie_night 7.50 wait...": ["don't", "well-known", "#movie_night", "7.50", "wait", "..."],
    "a &amp; b": ["a", "&", "b"],
    "ça va": ["ça", "va"],
    "me@x.org <b> -->": ["me@x.org", "<b>", "-->"],
}


def test_casual_tokens(spark):
    assert column(spark, list(CASUAL), T.casual_tokenize) == list(CASUAL.values())
    assert column(spark, ["WOW :D XD"], lambda t: T.casual_tokenize(t, lower_first=False)) == [["wow", ":D", "xd"]]


def negate(tokens):
    """The marking rule, one token at a time."""
    out, scope = [], False
    for t in tokens:
        negator = t in T.NEGATORS or "n't" in t
        if scope and t in T.CLAUSE_MARKS:
            scope = False
        elif scope:
            t = t + "_NEG"
        elif negator:
            scope = True
        out.append(t)
    return out


def test_negation_is_the_sequential_rule(spark):
    rng = random.Random(3)
    words = ["a", "good", "not", "don't", "never", ".", "!", "?", "?!", ":-)", ",", "no"]
    lists = [[rng.choice(words) for _ in range(rng.randint(0, 15))] for _ in range(500)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t array<string>")
    got = [r.o for r in rows.select("i", T.mark_negation("t").alias("o")).orderBy("i").collect()]
    assert got == [negate(t) for t in lists]


def test_post_tokens(spark):
    lemmas = spark.createDataFrame(
        [("movies", "n", "movie"), ("was", "v", "be"), ("better", "a", "good")], "token string, wordclass string, lemma string"
    )
    lexicon = spark.createDataFrame([("was", "VBD"), ("better", "JJR")], "token string, tag string")
    texts = ["The movies was not better than expected. ok :-) 12,5 !", "", "it isn't the BEST :-)"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id int, tweet_text string")
    plain = X.tokenize_posts(posts, key=["id"]).orderBy("id").collect()
    assert [r.tokens for r in plain] == [["movies", "better_NEG", "expected_NEG", ":-)"], [], ["isn't", "best_NEG", ":-)"]]
    full = X.tokenize_posts(posts, key=["id"], lexicon=lexicon, lemmas=lemmas).orderBy("id").collect()
    assert full[0].tokens == ["movie", "good_NEG", "expected_NEG", ":-)"]


def test_filter_and_stopwords(spark):
    tokens = [["!", "!_NEG", "!!", "1,000.5", "1_NEG", "ab", "ab_NEG", "abc", "the", "the_NEG", "not", "x"]]
    rows = spark.createDataFrame([(t,) for t in tokens], "t array<string>")
    assert rows.select(T.filter_tokens("t")).first()[0] == ["!!", "abc", "the", "the_NEG", "not"]
    assert rows.select(T.remove_stopwords(T.filter_tokens("t"))).first()[0] == ["!!", "abc"]


def test_ngrams(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in rows.select(T.ngrams("t", 1, 2)).collect()] == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert [r[0] for r in rows.select(T.ngrams("t", 1, 3)).collect()][0] == ["a", "b", "c", "a b", "b c", "a b c"]
    assert [r[0] for r in rows.select(T.ngrams("t", 2, 2)).collect()] == [["a b", "b c"], [], []]


def test_entities_are_decoded_like_html(spark):
    rng = random.Random(1)
    names = list(html5)
    pieces = [
        lambda: "&" + rng.choice(names),
        lambda: f"&#{rng.choice([rng.randint(0, 300), rng.randint(0, 0x120000)])};",
        lambda: f"&#x{rng.randint(0, 0x3000):x}",
        lambda: "&" + rng.choice(names).rstrip(";")[: rng.randint(1, 8)],
        lambda: rng.choice(["x", " ", "&", ";", "amp", "not", "&amp;", "日"]),
    ]
    texts = ["".join(rng.choice(pieces)() for _ in range(6)) for _ in range(600)]
    texts += ["&#99999999999999999999;", "&#x00000000041;", "&#xD800;", "&#128;", "&amp;amp;lt;"]
    twice = [html.unescape(t.replace("&amp;", "&")) for t in texts]
    assert column(spark, texts, T.unescape_html) == twice


def test_edges_and_spaces(spark):
    texts = ["'foo' don't", "(hello): x", 'a "b".', " a    b\n\tc "]
    assert column(spark, texts[:3], T.split_edge_punct) == ["' foo ' don't", "( hello ): x", 'a " b ".']
    assert column(spark, texts[3:], T.squeeze_whitespace) == ["a b c"]


def test_contractions(spark):
    rows = spark.createDataFrame([(["don't", "I'll", "she’s", "dogs'", "n't", "We'RE"],)], "t array<string>")
    assert rows.select(T.split_contraction("t")).first()[0] == ["do", "n't", "I", "'ll", "she", "’s", "dogs'", "n't", "We", "'RE"]


def test_hashtags(spark):
    counts = spark.createDataFrame(
        [("good", 50), ("movie", 80), ("night", 20), ("a", 500), ("the", 900), ("is", 300), ("goo", 1), ("dm", 1)], "word string, n long"
    )
    texts = ["i love #GoodMovie and #TheMovie2 x", "no tags  here", "# #zzq ok", None, "#goodmovieisanight"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id int, tweet_text string")
    got = [r.tweet_text for r in X.segment_hashtags(posts, counts, key=["id"]).orderBy("id").collect()]
    assert got == ["i love good movie and the movie 2 x", "no tags  here", "zzq ok", None, "good movie is a night"]


def test_hashtags_by_pairs_and_without_keys(spark):
    counts = spark.createDataFrame([("a", 500), ("miss", 50), ("amiss", 60), ("is", 300), ("this", 200), ("thi", 1), ("s", 90)], "word string, n long")
    pairs = spark.createDataFrame([("a", "miss", 400), ("is", "a", 250)], "first string, second string, n long")
    posts = spark.createDataFrame([(None, "x #AMiss"), (None, "#thisisamiss"), (3, None), (None, "none")], "id int, tweet_text string")
    got = sorted(str(r.tweet_text) for r in X.segment_hashtags(posts, counts, key=["id"]).collect())
    assert got == ["None", "none", "this is amiss", "x amiss"]
    got = sorted(str(r.tweet_text) for r in X.segment_hashtags(posts, counts, key=["id"], pair_counts=pairs).collect())
    assert got == ["None", "none", "this is a miss", "x a miss"]
    docs = spark.createDataFrame([(["a", "b", "a", "b"],), (["b"],), ([],), (None,)], "tokens array<string>")
    assert sorted(map(tuple, X.word_pairs(docs).collect())) == [("a", "b", 2), ("b", "a", 1)]


def test_hashtag_split_by_pairs_is_the_best_one(spark):
    from math import log10

    rng = random.Random(6)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 3))): rng.randint(20, 50) for _ in range(12)}
    known = sorted(counts)
    pairs = {(rng.choice(known), rng.choice(known)): rng.randint(1, 20) for _ in range(40)}
    tags = list({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(30)})
    rows = X.hashtag_words(
        spark.createDataFrame([(t,) for t in tags], "tag string"),
        spark.createDataFrame(list(counts.items()), "word string, n long"),
        pair_counts=spark.createDataFrame([(*p, n) for p, n in pairs.items()], "first string, second string, n long"),
    ).collect()
    assert len(rows) == len(tags)

    def value(words):
        _, score = best_split(words[0], counts)
        parts = zip([None, *words], words)
        return sum(log10(pairs[p] / counts[p[0]]) if p in pairs else score(p[1]) for p in parts)

    for r in rows:
        splits = []
        for cuts in range(2 ** (len(r.tag) - 1)):
            ends = [i for i in range(1, len(r.tag)) if cuts >> (i - 1) & 1] + [len(r.tag)]
            splits.append([r.tag[a:b] for a, b in zip([0, *ends], ends)])
        assert "".join(r.words) == r.tag
        assert value(r.words) == pytest.approx(max(map(value, splits)))


def best_split(tag, counts):
    """Most probable split by trying all of them."""
    from math import log10

    total = sum(counts.values())

    def score(w):
        return log10(counts[w] / total) if w in counts else 1 - log10(total) - len(w)

    best = None
    for cuts in range(2 ** (len(tag) - 1)):
        words, start = [], 0
        for i in range(1, len(tag) + 1):
            if i == len(tag) or cuts >> (i - 1) & 1:
                words.append(tag[start:i])
                start = i
        value = sum(map(score, words))
        if best is None or value > best:
            best = value
    return best, score


def test_hashtag_split_is_the_best_one(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.randint(1, 50) for _ in range(15)}
    tags = list({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(40)})
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = X.hashtag_words(spark.createDataFrame([(t,) for t in tags], "tag string"), words).collect()
    assert len(rows) == len(tags)
    for r in rows:
        best, score = best_split(r.tag, counts)
        assert "".join(r.words) == r.tag
        assert sum(map(score, r.words)) == pytest.approx(best)


TITLES = {
    "  The Movie (2017 remake) ": "the movie",
    '"Star": Part II': "star",
    "#Hash @ Sign": "hash  sign",
    "Trailing:": "trailing:",
    "What! (uncut)": "what! (uncut)",
}


def test_clean_title(spark):
    assert column(spark, list(TITLES), S.clean_title) == list(TITLES.values())


def test_remove_title_quotes_the_title(spark):
    cases = [
        ("I saw #MotherLand and mother land", "Mother Land", "I saw  and "),
        ("What (now)+! is good", "What (now)+!", " is good"),
        ("c++ rocks C++", "C++", " rocks "),
        ("nothing here", "x.y", "nothing here"),
        ("ÉTÉ rocks", "été", " rocks"),
    ]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, t string, title string")
    got = [r.o for r in rows.select("i", S.remove_title("t", "title").alias("o")).orderBy("i").collect()]
    assert got == [c for _, _, c in cases]


def test_clean_post(spark):
    texts = ["RT @bob: it's \"great\"\nreally", "hi @al: and @bea  x ", "  a "]
    assert column(spark, texts, S.clean_post) == ["its greatreally", "hi and x", "a"]


def test_numbers(spark):
    assert column(spark, ["$1,234", "n/a", "", None, "107 min"], S.digits_to_int) == [1234, None, None, None, 107]
    assert column(spark, ["7.5", "N/A"], S.rating_to_double) == [7.5, None]
    assert column(spark, ["7.5"], lambda c: S.rating_to_double(c, compat=True)) == [75.0]


def test_predicates(spark):
    texts = ["RT @a: x", "hi @a", "RT @a x", "rt @a: x", "none"]
    assert column(spark, texts, S.is_retweet) == [True, False, False, False, False]
    assert column(spark, texts, S.is_mention) == [False, True, True, True, False]


def test_links(spark):
    texts = ["see https://t.co/a?b=1 now"]
    assert column(spark, texts, S.strip_links) == ["see /a?b=1 now"]
    assert column(spark, texts, lambda c: S.strip_links(c, whole=True)) == ["see  now"]


def test_every_kind_is_found(spark):
    examples = {
        "heart": "</3", "url": "www.a.com/b", "email": "a.b@c.de", "time": "12:30", "thousands": "1,234", "decimal": "$1.50",
        "emoticon": ":-)", "arrow": "<--", "entity": "&amp;", "punctuation": "?!", "abbreviation": "U.S.", "separator": "--",
        "decoration": "★", "apostrophe_word": "don't", "hashtag": "#a", "mention": "@a",
    }
    assert list(protected_kinds()) == list(examples)
    for kind, text in examples.items():
        assert column(spark, [text], lambda t, k=kind: T.protected_spans(t, k)) == [[text]], kind


def test_spans_in_order_of_place_then_kind(spark):
    texts = ["a www.x.com/:) 1,234.5 (: b", "no spans here"]
    assert column(spark, texts, T.protected_spans) == [["www.x.com/:)", "1,234", ".", "(:"], []]


def test_a_token_with_several_tags_stays_one_token(spark):
    docs = spark.createDataFrame([("t", ["run", "fast"]), ("t", ["run", "fast"]), ("u", []), ("v", None)], "k string, tokens array<string>")
    lexicon = spark.createDataFrame([("run", "NN", 2), ("run", "VB", 5), ("run", "VB", 1), ("fast", "RB", 1), ("fast", "JJ", 1)], "token string, tag string, n int")
    lemmas = spark.createDataFrame([("run", "v", "go"), ("run", "v", "run"), ("run", "v", "go"), ("fast", "a", "quick")], "token string, wordclass string, lemma string")
    got = X.lemmatize(docs, ["k"], lemmas, lexicon)
    assert sorted(map(str, (r.tokens for r in got.collect()))) == sorted(map(str, [["go", "quick"], ["go", "quick"], [], None]))
    tagged = {(r.token, r.tag) for r in X.pos_lookup(X.token_rows(docs, ["k"]), lexicon, ["k", "pos"]).collect()}
    assert tagged == {("run", "VB"), ("fast", "JJ")}


def test_lemmas_by_ending(spark):
    known = "cat n, bus n, wolf n, box n, quiz n, church n, dish n, woman n, city n, make v, walk v, try v, go v, nice a, tall a, as n, a n, late a, lat a"
    words = spark.createDataFrame([(*w.split(),) for w in known.split(", ")] + [(None, "n"), ("cat", "n")], "word string, wordclass string")
    cases = {
        ("cats", "n"): "cat", ("buses", "n"): "bus", ("bus", "n"): "bus", ("wolves", "n"): "wolf", ("boxes", "n"): "box", ("churches", "n"): "church",
        ("dishes", "n"): "dish", ("women", "n"): "woman", ("cities", "n"): "city", ("making", "v"): "make", ("walked", "v"): "walk", ("tries", "v"): "try",
        ("goes", "v"): "go", ("nicer", "a"): "nice", ("tallest", "a"): "tall", ("as", "n"): "a", ("later", "a"): "lat", ("s", "n"): None, ("", "n"): None,
        ("cats", "v"): None, ("cats", "r"): None, ("dogs", "n"): None, (None, "n"): None,
    }
    tokens = spark.createDataFrame([*cases, *cases], "token string, wordclass string")
    found = {(r.token, r.wordclass): r.lemma for r in X.ending_lemmas(tokens, words).collect()}
    assert found == {k: v for k, v in cases.items() if v is not None}
    docs = spark.createDataFrame([(1, ["cats", "went", "dogs", "buses"]), (1, []), (None, None)], "k int, tokens array<string>")
    irregular = spark.createDataFrame([("buses", "n", "coach")], "token string, wordclass string, lemma string")
    for table, last in ((irregular, "coach"), (None, "bus")):
        got = X.lemmatize(docs, ["k"], table, words=words)
        assert sorted(map(repr, (r.tokens for r in got.collect()))) == sorted(map(repr, [["cat", "went", "dogs", last], [], None]))
    assert X.ending_lemmas(tokens, words.limit(0)).count() == 0 == X.ending_lemmas(tokens.limit(0), words).count()


def test_long_hashtags_take_time_in_proportion(spark):
    words = spark.createDataFrame([("good", 10), ("movie", 5)], "word string, n long")
    rows = [(1, "#" + "goodmovie" * 1200), (1, "#" + "goodmovie" * 1200), (2, "#" + "q" * 5000), (3, "#"), (4, "x #goodmovie! y")]
    posts = spark.createDataFrame(rows, "id int, tweet_text string")
    start = time.monotonic()
    got = sorted((r.id, r.tweet_text) for r in X.segment_hashtags(posts, words, key=["id"]).collect())
    assert time.monotonic() - start < 15
    assert got[0] == got[1] == (1, " ".join(["good movie"] * 1200)) and got[2][1].replace(" ", "") == "q" * 5000
    assert got[4] == (4, "x good movie y")


def test_pieces_of_hashtags_are_not_broadcast(spark, monkeypatch):
    """A dictionary that is too large to broadcast: neither it nor the pieces go through the driver."""
    from marquee.operators import joins

    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    words = spark.createDataFrame([("good", 10), ("movie", 5)], "word string, n long")
    pairs = spark.createDataFrame([("good", "movie", 3)], "first string, second string, n long")
    posts = spark.createDataFrame([(1, "see #goodmovie now"), (2, "x"), (3, None), (3, "#zz")], "id int, tweet_text string")
    split = X.segment_hashtags(posts, words, pair_counts=pairs)
    assert "Broadcast" not in split._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.tweet_text or "") for r in split.collect()) == [(1, "see good movie now"), (2, "x"), (3, ""), (3, "zz")]


def test_tokens_meet_only_the_lemmas_that_change_them(spark, monkeypatch):
    met = []
    join = X.dictionary_join

    def counted(tokens, table, keys, spread):
        met.append((tokens.columns, table.count()))
        return join(tokens, table, keys, spread)

    monkeypatch.setattr(X, "dictionary_join", counted)
    docs = spark.createDataFrame([(1, ["cats", "a", None, "cats"]), (1, []), (None, None), (2, ["a"]), (2, ["dogs", "ran"])], "k int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "n", "cat"), ("dogs", "n", "dog"), ("ran", "v", "run"), ("a", "n", "a"), ("owls", "n", "owl")], "token string, wordclass string, lemma string")
    got = X.lemmatize(docs, ["k"], lemmas)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.k, r.tokens) for r in got.collect()), key=key) == sorted([(1, ["cat", "a", None, "cat"]), (1, []), (None, None), (2, ["a"]), (2, ["dog", "ran"])], key=key)
    assert [n for columns, n in met if "_row" in columns] == [2]  # cats and dogs


def test_batches_of_python_tasks_are_small(spark):
    from marquee.session import small_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in ((10_000, 1_000), (0, 1_000), (50, 50)):
            spark.conf.set(name, given)
            assert int(small_batches(spark).conf.get(name)) == want
    finally:
        spark.conf.set(name, before)


def test_spans_beside_plain_words(spark):
    """Plain words are passed over, and the spans are those of the kinds alone."""
    rng = random.Random(7)
    parts = ["word", "Dr", "Mrs", "st", "U", "S", "o", "O", "x", "D", "s", "v", "été", "don", "com", "www", "t", "12", "1", "RT", "é"]
    marks = [" ", " ", " ", " ", ".", ",", "?", "!", "'", ":", ";", ")", "(", "_", "-", "@", "#", "/", "<", ">", "3", "&amp;", "..", "=", "*", "\u2019", "\n", "~", "^", "$"]
    texts = ["".join(rng.choice(parts if rng.random() < 0.5 else marks) for _ in range(rng.randrange(1, 40))) for _ in range(3_000)]
    texts += ["plain words only", "a, b? c", "see foo.com, or it's a.b.c at 12:30. D: word, :) o_O ssss. :(", "", " ", "U.S. a U.S", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    alone = F.regexp_extract_all("t", F.lit("(?:" + "|".join(protected_kinds().values()) + ")"), F.lit(0))
    bad = df.select("t", T.protected_spans("t").alias("a"), alone.alias("b")).filter(~F.col("a").eqNullSafe(F.col("b")))
    assert bad.take(3) == []
    assert "(?<![^ ])" in str(T.protected_spans("t"))


BESIDE = "oh www. so|sen. x|Dr. who, St. as.|a. b a.b. U.S. so.|é,a.b. oé. x|o, : o,: d: p8 s.:|no, ok? yes! ...|x.com, x. com|. . , .. .|a@b, @c, @@d, so @e|1, 2. 3 ? !|\ttab\t so. \tx"


def test_marks_beside_plain_words_change_no_token(spark):
    from marquee.functions.patterns import PLAIN_MARK, any_of, protected_kinds

    assert PLAIN_MARK
    kinds = any_of(*protected_kinds().values())
    texts = BESIDE.split("|")
    assert column(spark, texts, T.split_tokens) == column(spark, texts, lambda t: T.split_tokens(t, kinds))
    assert column(spark, texts, T.protected_spans) == column(spark, texts, lambda t: F.regexp_extract_all(t, F.lit(kinds), F.lit(0)))


def test_plain_words_are_casual_tokens_too(spark):
    from marquee.functions.patterns import CASUAL_KINDS, CASUAL_PLAIN, any_of

    assert CASUAL_PLAIN
    texts = [t for t in BESIDE.split("|") if "@" not in t]
    assert column(spark, texts, T.casual_tokenize) == column(spark, texts, lambda t: F.regexp_extract_all(F.lower(t), F.lit(any_of(*CASUAL_KINDS.values())), F.lit(0)))


def test_lists_without_a_negator_are_passed_through(spark):
    rows = spark.createDataFrame([(["a", "not", "b", ".", None, "no", "c", "never", "d"],), (["a", None],), ([],), (None,)], "t array<string>")
    got = rows.select(T.mark_negation("t").alias("o"), T.unmark_emoticons(F.array(F.lit("!!_NEG"), F.lit("ab"))).alias("u"), T.filter_tokens(F.array(*map(F.lit, ["ab", "ab_NEG", "abc", "a-", "abc_NEG", "1,2", "!"]))).alias("f"))
    assert [r.o for r in got.collect()] == [["a", "not", "b_NEG", ".", None, "no", "c_NEG", "never_NEG", "d_NEG"], ["a", None], [], None]
    assert got.first().u == ["!!", "ab"] and got.first().f == ["abc", "a-", "abc_NEG"]
    assert "exists" in got._jdf.queryExecution().analyzed().toString()
