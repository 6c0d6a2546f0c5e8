"""SQL side of the checks, for DuckDB."""

from __future__ import annotations

from checks.views import with_views

ORACLE: dict[str, str] = {}

# The English stop words and the words that begin a negation, as they are documented
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself "
    "they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don should now d ll m o re ve y ain aren "
    "couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn"
).split()
NEGATION = "never no nothing nowhere noone none not havent hasnt hadnt cant couldnt shouldnt wont wouldnt dont doesnt didnt isnt arent aint".split()


def add(name: str, sql: str, *extra: str) -> None:
    ORACLE[name] = with_views(sql, *extra)


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def braces(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


ARGMAX = "CASE WHEN pr_neg >= pr_neu AND pr_neg >= pr_pos THEN -1 WHEN pr_neu >= pr_pos THEN 0 ELSE 1 END"
W = braces(r"[\p{L}\p{N}_]")
PUNCT = r"[!-/:-@\[-`" + braces("{-~]")


def sub(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


CLEAN = (
    "trim(" + sub(sub(sub("replace(replace(replace(tweet_text, chr(10), ''), '''', ''), '\"', '')", f"(RT )?@{W}+:?"), "  +", " "), r"^\s+|\s+$") + ")"
)

# --- Scalars ---
TITLE = sub(sub(sub("lower(trim(raw_title))", '[@#"]+'), r"\([0-9]{{4}}.*\)"), ":.+")
add("p1_clean_title", f"SELECT p_partkey, trim({TITLE}) AS title FROM {{titles_fx}}")
JSON = "json_extract_string(json, '$.{}')"
VOTES, RUNTIME, RATING = (JSON.format(k) for k in ("imdbVotes", "Runtime", "imdbRating"))
DIGITS = "TRY_CAST(regexp_replace({}, '[^0-9]', '', 'g') AS BIGINT)"
POINTED = f"TRY_CAST(regexp_replace({RATING}, '[^0-9.]', '', 'g') AS DOUBLE)"
add(
    "p2_digits_to_int",
    f"SELECT p_partkey, {DIGITS.format(VOTES)} AS votes, {DIGITS.format(RUNTIME)} AS runtime FROM {{movie_json_fx}}",
)
add("p3_na_to_null", f"SELECT p_partkey, nullif({RUNTIME}, 'N/A') AS runtime FROM {{movie_json_fx}}")
add(
    "p4_rating_to_double",
    f"SELECT p_partkey, {POINTED} AS rating, CAST({DIGITS.format(RATING)} AS DOUBLE) AS rating_without_point FROM {{movie_json_fx}}",
)
RT, AT = f"regexp_matches(tweet_text, '^RT @{W}+:')", f"regexp_matches(tweet_text, '@{W}+')"
add("p5_is_retweet", f"SELECT tweet_id, {RT} AS retweet FROM {{tweets_fx}}")
add("p6_is_mention", f"SELECT tweet_id, {AT} AND NOT {RT} AS mention FROM {{tweets_fx}}")
add("p7_clean_post", f"SELECT tweet_id, {CLEAN} AS tweet_text FROM {{tweets_fx}}")
add(
    "p8_remove_title",
    "SELECT tweet_id, regexp_replace(tweet_text, concat('(?i)#?', title), '', 'g') AS tweet_text FROM {tweets_fx}",
)
add("p9_format_post_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS posted FROM events")
add(
    "p10_search_filter",
    "SELECT title, tweet_id, CAST(tweet_date AS VARCHAR) AS tweet_date FROM {tweets_fx} WHERE tweet_date >= DATE '2017-01-03' "
    f"AND tweet_date < DATE '2017-01-06' AND lang = 'en' AND NOT regexp_matches(tweet_text, 'https?://') AND NOT {RT}",
)
add(
    "p11_strip_links",
    rf"SELECT tweet_id, {sub('tweet_text', f'https?://(?:{W}|[.-])+')} AS host_removed, "
    rf"{sub('tweet_text', 'https?://[^ \t\n\r]+')} AS link_removed FROM {{tweets_fx}}",
)
BOX = "title, CAST(gross_date AS VARCHAR) AS gross_date"
add("p12_next_day", f"SELECT {BOX}, CAST(CAST(gross_date + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_date FROM {{boxoffice_fx}}")
add("p13_with_constants", f"SELECT {BOX}, 'chart' AS method, '2017-01-01' AS pred_date, CAST(1.5 AS DOUBLE) AS weight FROM {{boxoffice_fx}}")
add("p14_year_of", f"SELECT {BOX}, year(gross_date) AS year, year(gross_date) - 1 AS previous_year FROM {{boxoffice_fx}}")
add("p15_drop_unlabeled", "SELECT t.tweet_id, CAST(label AS BIGINT) AS label FROM {tweets_fx} t JOIN {sentiment_fx} s ON t.tweet_id = s.tweet_id")
BEST = "list_max([pr_neg, pr_neu, pr_pos])"
add("p16_max_prob", f"SELECT tweet_id, round({BEST}, 6) AS best, {BEST} >= 0.9 AS sure FROM {{scores_fx}}")
add(
    "p17_argmax_label",
    f"SELECT tweet_id, CAST(list_position([pr_neg, pr_neu, pr_pos], {BEST}) - 2 AS BIGINT) AS label FROM {{scores_fx}}",
)

# --- Joins ---
FREE = (
    "tweet_id NOT IN (SELECT DISTINCT tweet_id FROM {sentiment_fx} WHERE part = 'labeled') "
    "AND tweet_id NOT IN (SELECT DISTINCT tweet_id FROM {sentiment_fx} WHERE part = 'validation')"
)
add("j1_unlabeled_posts", f"SELECT title, tweet_id, CAST(tweet_date AS VARCHAR) AS tweet_date FROM {{tweets_fx}} WHERE {FREE}")
WORDS = "regexp_replace(concat(' ', lower({}), ' '), '" + r"[^\p{{{{L}}}}\p{{{{N}}}}_]+" + "', ' ', 'g')"
MENTION = (
    "SELECT DISTINCT t.title, p.tweet_id FROM (SELECT DISTINCT title, tweet_date FROM {tweets_fx}) t JOIN {tweets_fx} p "
    f"ON t.tweet_date = p.tweet_date AND contains({WORDS.format('p.tweet_text')}, {WORDS.format('t.title')})"
)
add("j2_mention_join", MENTION)
add("j2_mention_join_many_titles", MENTION)
add(
    "j2_mention_join_repeated_ids",
    f"""SELECT way, title, tweet_id, count(*) AS n FROM (SELECT title, tweet_id FROM ({MENTION}) a UNION ALL
 SELECT title, CASE WHEN tweet_id % 10 <> 0 THEN tweet_id END FROM ({MENTION}) b) q, (VALUES ('few'), ('many')) w(way) GROUP BY ALL""",
)
add(
    "j3_metadata_lookup",
    """SELECT title, CAST(2017 AS BIGINT) AS year, CAST(found_year AS BIGINT) AS found_year, p_partkey FROM (
 SELECT t.title, m.year AS found_year, m.p_partkey,
  ROW_NUMBER() OVER (PARTITION BY t.title ORDER BY m.year DESC NULLS LAST) AS n
 FROM (SELECT DISTINCT p_brand AS title FROM part) t
 LEFT JOIN {movies_fx} m ON t.title = m.title AND m.year IN (2016, 2017)) q WHERE n = 1""",
)
ANSWERED = """answered AS (SELECT pos, answer FROM (SELECT pos, lower(trim(answer)) AS answer,
  ROW_NUMBER() OVER (PARTITION BY pos ORDER BY attempt) AS n FROM {answers_fx}
  WHERE lower(trim(answer)) IN ('-1', '0', '1', 's', 'q')) q WHERE n = 1)"""
KEPT = (
    "SELECT q.pos, title, tweet_id, CAST(answer AS BIGINT) AS label FROM {queue_fx} q JOIN answered a ON q.pos = a.pos "
    "WHERE answer IN ('-1', '0', '1') AND q.pos < (SELECT min(pos) FROM answered WHERE answer = 'q')"
)
add("j4_apply_annotations", KEPT, ANSWERED)

# --- Aggregates ---
SHARES = ", ".join(
    f"round(avg(CASE WHEN c = {k} THEN 1.0 ELSE 0.0 END), 6) AS pr_cls_{n}" for n, k in (("neg", -1), ("neu", 0), ("pos", 1))
)
MEANS = ", ".join(f"round(avg(pr_{n}), 6) AS avg_pr_{n}" for n in ("neg", "neu", "pos"))
add("a1_title_metrics", f"SELECT title, {SHARES}, {MEANS} FROM (SELECT *, {ARGMAX} AS c FROM {{scores_fx}}) q GROUP BY title")
COUNTS = ", ".join(f"count(*) FILTER (WHERE label = {k}) AS {n}" for n, k in (("negative", -1), ("neutral", 0), ("positive", 1)))
add("a2_class_counts", f"SELECT part, {COUNTS} FROM {{sentiment_fx}} GROUP BY part")
add(
    "a3_accuracy",
    "SELECT title, round(avg(CASE WHEN old_class = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM {predictions_fx} GROUP BY title",
)
add(
    "a4_high_water_mark",
    "SELECT 'all' AS rows, CAST(CAST(max(gross_date) + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_date FROM {boxoffice_fx} "
    "UNION ALL SELECT 'none', '2017-01-01'",
)
add("a5_distinct_titles", "SELECT DISTINCT title FROM {tweets_fx} WHERE tweet_date = DATE '2017-01-03'")

# --- Ranking and sets ---
add(
    "w1_top_n_per_day",
    "SELECT CAST(gross_date AS VARCHAR) AS gross_date, title, daily_gross, CAST(rank AS BIGINT) AS rank FROM {boxoffice_fx} WHERE rank <= 10",
)
add(
    "w2_sample_per_title",
    f"SELECT title, tweet_id FROM {{tweets_fx}} WHERE {FREE} QUALIFY ROW_NUMBER() OVER (PARTITION BY title ORDER BY tweet_id) <= 20",
)
add(
    "w3_recent_n_per_title",
    "SELECT title, tweet_id, CAST(tweet_date AS VARCHAR) AS tweet_date FROM {tweets_fx} "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY title, tweet_date ORDER BY tweet_id DESC) <= 3",
)
add("w4_queue_position", "SELECT title, tweet_id, pos FROM {queue_fx}")
add("w5_latest", "SELECT CAST(max(gross_date) AS VARCHAR) AS gross_date FROM {boxoffice_fx}")
add(
    "w6_limit",
    f"SELECT {BOX}, daily_gross FROM {{boxoffice_fx}} b ORDER BY b.daily_gross DESC, b.title, b.gross_date LIMIT 25",
)
add("u1_concat_titles", "SELECT title, tweet_id, lang FROM {tweets_fx} WHERE lang IN ('en', 'fr', 'de', 'es')")
add(
    "u2_training_union",
    """SELECT md5(tweet_text) AS text_hash, CAST(label AS BIGINT) AS label,
 CAST(sum(CASE WHEN part = 'labeled' THEN 2 ELSE 1 END) AS BIGINT) AS n
 FROM {sentiment_fx} s JOIN {tweets_fx} t ON s.tweet_id = t.tweet_id GROUP BY 1, 2""",
)
add("u3_distinct_ids", "SELECT DISTINCT tweet_id FROM {sentiment_fx}")

# --- Sources and sinks ---
ITEMS = """SELECT page_id, generate_subscripts(items, 1) AS n, unnest(items) AS item FROM
 (SELECT page_id, regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1) AS items FROM pages) p"""
CELL = "trim(replace(regexp_replace(regexp_extract(item, '(?is)<a[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g'), '&amp;', '&'))"
add("s4_extract_rows", f"SELECT page_id, CAST(n AS BIGINT) AS rank, {CELL} AS cell FROM ({ITEMS}) q")
add("s4_extract_top_rows", f"SELECT page_id, CAST(n - 1 AS BIGINT) AS rank, {CELL} AS cell FROM ({ITEMS}) q WHERE n BETWEEN 2 AND 4")
add(
    "s4_extract_chart",
    """SELECT CAST(gross_date AS VARCHAR) AS gross_date, CAST(rank AS BIGINT) AS rank, title, daily_gross,
 daily_gross AS todate_gross, CASE WHEN rank <> 2 THEN CAST(rank AS BIGINT) END AS release_day, CAST(theaters AS BIGINT) AS theaters,
 CASE WHEN rank = 2 THEN 'unreadable: release_day' END AS problem FROM {boxoffice_fx} WHERE rank <= 10""",
)
add(
    "s5_normalize_metadata",
    f"""SELECT p_partkey, title, CAST(year AS BIGINT) AS year, {DIGITS.format(RUNTIME)} AS runtime, {DIGITS.format(VOTES)} AS imdbvotes,
 {POINTED} AS imdbrating, CAST(NULL AS VARCHAR) AS actors FROM {{movie_json_fx}}""",
)
add(
    "s6_flatten_posts",
    """SELECT tweet_id * 3 AS author_id, concat('user', tweet_id) AS author_name, tweet_id % 2 = 0 AS author_verified,
 tweet_id % 100 AS author_followers, tweet_id % 90 AS author_friends, tweet_id % 80 AS author_favorites,
 tweet_id % 70 AS author_statuses, tweet_id,
 strftime(CAST(tweet_date AS TIMESTAMP) + to_seconds(tweet_id % 86400), '%Y-%m-%d %H:%M:%S') AS tweet_datetime,
 tweet_id % 60 AS tweet_favorites, tweet_id % 50 AS tweet_retweets FROM {tweets_fx}""",
)
add("s7_read_table", "SELECT doc_id, source FROM documents")
add(
    "s8_append_keyed",
    "SELECT title, tweet_id, tweet_id NOT IN (SELECT tweet_id FROM {sentiment_fx}) AS added FROM {tweets_fx}",
)
add(
    "s10_csv_lines",
    "SELECT concat('\"', CAST(gross_date AS VARCHAR), '\",', rank, ',\"', title, ' \"\"x\"\"\",', daily_gross, ',', CAST(daily_gross AS DOUBLE), ',', theaters / 10000.0) AS value FROM {boxoffice_fx}",
)
LABELED_TEXT = "{{tweets_fx}} t JOIN {{sentiment_fx}} s ON t.tweet_id = s.tweet_id"
for name, extra, where in (
    ("s1_read_labeled_text", "", ""),
    ("s2_read_positional_tsv", "", ""),
    ("s3_read_datasets", "t.lang AS dataset, ", " WHERE t.lang IN ('en', 'de')"),
):
    group = "GROUP BY ALL"
    add(
        name,
        f"SELECT {extra}md5(translate(t.tweet_text, chr(10) || chr(13) || chr(9), '   ')) AS text_hash, CAST(s.label AS VARCHAR) AS label, "
        f"count(*) AS n FROM {LABELED_TEXT.replace('{{', '{').replace('}}', '}')}{where} {group}",
    )
add(
    "s9_replace_table",
    f"SELECT title, CAST(tweet_date AS VARCHAR) AS pred_date, round(avg(CASE WHEN c = -1 THEN 1.0 ELSE 0.0 END), 6) AS pr_cls_neg, "
    f"round(avg(pr_pos), 6) AS avg_pr_pos FROM (SELECT *, {ARGMAX} AS c FROM {{scores_fx}}) q GROUP BY title, tweet_date",
)
add(
    "s11_create_tables",
    "SELECT t.title, t.tweet_id, md5(t.tweet_text) AS text_hash, CAST(s.label AS BIGINT) AS label, 0::BIGINT AS before "
    "FROM {tweets_fx} t JOIN {sentiment_fx} s ON t.tweet_id = s.tweet_id",
)
add(
    "s12_append_metadata",
    f"SELECT title, concat(CAST(year AS VARCHAR), '-01-01') AS search_date, {DIGITS.format(RUNTIME)} AS runtime, {DIGITS.format(VOTES)} AS imdbvotes "
    "FROM (SELECT title, year, min(json) AS json FROM {movie_json_fx} GROUP BY title, year) q",
)

# --- Tokens ---
TOKEN = braces(r"[\p{L}\p{N}_'']+|[^\p{L}\p{N}_'' \t\n\r\f]+")
TOK = f"""tok AS (SELECT tweet_id, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token FROM
 (SELECT tweet_id, regexp_extract_all(lower(tweet_text), '{TOKEN}') AS toks FROM {{tweets_fx}}) q)"""
LEXICON = """lexicon AS (SELECT * FROM (SELECT DISTINCT token, CASE WHEN token LIKE '%ing' THEN 'VBG' WHEN token LIKE '%ly' THEN 'RB'
 WHEN token LIKE '%ble' THEN 'JJ' END AS tag FROM tok) q WHERE tag IS NOT NULL)"""


def per_post(rows: str, value: str = "token", sep: str = " ") -> str:
    """Tokens of each post joined in order; a post without tokens has an empty text."""
    return (
        f"SELECT t.tweet_id, coalesce(string_agg({value}, '{sep}' ORDER BY r.pos), '') AS tokens "
        f"FROM {{tweets_fx}} t LEFT JOIN {rows} r ON t.tweet_id = r.tweet_id GROUP BY t.tweet_id"
    )


add("a6_term_counts", "SELECT token AS term, count(*) AS total, count(DISTINCT tweet_id) AS docs FROM tok GROUP BY token", TOK)
PLURAL = "regexp_matches(token, '^[a-z]{{3,}}s$')"
add("j5_lemmatize", per_post(f"(SELECT tweet_id, pos, CASE WHEN {PLURAL} THEN left(token, length(token) - 1) ELSE token END AS token FROM tok)"), TOK)
CLASSED = """classed AS (SELECT k.tweet_id, k.pos, k.token, CASE tag WHEN 'VBG' THEN 'v' WHEN 'RB' THEN 'r' WHEN 'JJ' THEN 'a' ELSE 'n' END AS wordclass
 FROM tok k LEFT JOIN lexicon x ON k.token = x.token)"""
RULES = """rules AS (SELECT * FROM (VALUES ('n', 1, 's', ''), ('n', 2, 'ses', 's'), ('n', 3, 'ves', 'f'), ('n', 4, 'xes', 'x'), ('n', 5, 'zes', 'z'), ('n', 6, 'ches', 'ch'),
 ('n', 7, 'shes', 'sh'), ('n', 8, 'men', 'man'), ('n', 9, 'ies', 'y'), ('v', 1, 's', ''), ('v', 2, 'ies', 'y'), ('v', 3, 'es', 'e'), ('v', 4, 'es', ''), ('v', 5, 'ed', 'e'),
 ('v', 6, 'ed', ''), ('v', 7, 'ing', 'e'), ('v', 8, 'ing', ''), ('a', 1, 'er', ''), ('a', 2, 'est', ''), ('a', 3, 'er', 'e'), ('a', 4, 'est', 'e')) r(wordclass, place, ending, put))"""
BASES = """bases AS (SELECT DISTINCT token AS word, 'n' AS wordclass FROM tok WHERE token NOT LIKE '%s' UNION ALL SELECT DISTINCT token, 'v' FROM tok WHERE token NOT LIKE '%ing')"""
FORMS = """forms AS (SELECT DISTINCT token, wordclass, 0 AS place, token AS word FROM classed UNION ALL
 SELECT c.token, c.wordclass, r.place, concat(left(c.token, length(c.token) - length(r.ending)), r.put) FROM (SELECT DISTINCT token, wordclass FROM classed) c
 JOIN rules r ON c.wordclass = r.wordclass AND right(c.token, length(r.ending)) = r.ending)"""
BY_ENDING = """by_ending AS (SELECT token, wordclass, word AS lemma FROM (SELECT f.token, f.wordclass, f.word,
 row_number() OVER (PARTITION BY f.token, f.wordclass ORDER BY length(f.word), f.place) AS nth
 FROM forms f JOIN bases b ON f.word = b.word AND f.wordclass = b.wordclass) q WHERE nth = 1)"""
add(
    "j5_lemmatize_endings",
    per_post(
        "(SELECT c.tweet_id, c.pos, CASE WHEN c.wordclass = 'n' AND regexp_matches(c.token, '^[a-z]{{3}}s$') THEN left(c.token, 3) ELSE coalesce(e.lemma, c.token) END AS token "
        "FROM classed c LEFT JOIN by_ending e ON c.token = e.token AND c.wordclass = e.wordclass)"
    ),
    TOK,
    LEXICON,
    CLASSED,
    RULES,
    BASES,
    FORMS,
    BY_ENDING,
)
add("t2_pos_to_wordnet", "SELECT token, tag, CASE tag WHEN 'VBG' THEN 'v' WHEN 'RB' THEN 'r' ELSE 'a' END AS wordclass FROM lexicon", TOK, LEXICON)
add(
    "t3_pos_lookup",
    "SELECT k.token, coalesce(tag, 'NN') AS tag, count(*) AS n FROM tok k LEFT JOIN lexicon x ON k.token = x.token GROUP BY 1, 2",
    TOK,
    LEXICON,
)
AFTER_SHORT = "length(prev) < 4"
TAGGED = f"""tagged AS (SELECT *, CASE WHEN token LIKE '%ing' THEN CASE WHEN {AFTER_SHORT} THEN 'VBG' ELSE 'NN' END
 WHEN token LIKE '%er' THEN CASE WHEN {AFTER_SHORT} THEN 'JJ' WHEN length(prev) > 7 THEN 'RB' ELSE 'NN' END
 WHEN token LIKE '%ly' THEN 'RB' WHEN token LIKE '%ble' THEN 'JJ' WHEN length(token) < 4 THEN 'DT' ELSE 'NN' END AS tag
 FROM (SELECT *, coalesce(lag(token) OVER (PARTITION BY tweet_id ORDER BY pos), '.') AS prev FROM tok WHERE tweet_id % 2 = 0) q)"""
PAIRED = "paired AS (SELECT token, tag, coalesce(lag(tag) OVER (PARTITION BY tweet_id ORDER BY pos), '') AS before FROM tagged)"
TAGS = "tags AS (SELECT tag, count(*) AS total FROM paired GROUP BY tag)"
EMITS = """emits AS MATERIALIZED (SELECT token, tag, CAST(round(ln(count(*) / any_value(total)) * -1e6) AS BIGINT) AS cost
 FROM paired JOIN tags USING (tag) GROUP BY token, tag)"""
STEPS = """steps AS MATERIALIZED (SELECT b.before, t.tag, CAST(round(ln((coalesce(p.n, 0) + 1) / (b.n + (SELECT count(*) FROM tags))) * -1e6) AS BIGINT) AS step
 FROM (SELECT g.before, count(p.before) AS n FROM (SELECT tag AS before FROM tags UNION ALL SELECT '') g LEFT JOIN paired p ON p.before = g.before GROUP BY g.before) b
 CROSS JOIN tags t LEFT JOIN (SELECT before, tag, count(*) AS n FROM paired GROUP BY before, tag) p ON p.before = b.before AND p.tag = t.tag)"""
CHOICES = """choices AS MATERIALIZED (SELECT k.tweet_id, k.pos, coalesce(e.tag, 'NN') AS tag, coalesce(e.cost, 0) AS cost, count(*) OVER (PARTITION BY k.tweet_id, k.pos) AS alts
 FROM tok k LEFT JOIN emits e ON k.token = e.token)"""
# a token of one tag cuts the path: only runs of tokens of several tags are gone through
RUNS = """runs AS (SELECT a.tweet_id, a.pos AS first, a.pos, a.tag, a.cost + s.step AS cost, [a.tag] AS path
 FROM choices a LEFT JOIN choices p ON p.tweet_id = a.tweet_id AND p.pos = a.pos - 1 JOIN steps s ON s.before = coalesce(p.tag, '') AND s.tag = a.tag
 WHERE a.alts > 1 AND coalesce(p.alts, 1) = 1
 UNION ALL SELECT * FROM (SELECT a.tweet_id, r.first, a.pos, a.tag, r.cost + s.step + a.cost AS cost, list_append(r.path, a.tag) AS path
 FROM runs r JOIN choices a ON a.tweet_id = r.tweet_id AND a.pos = r.pos + 1 AND a.alts > 1 JOIN steps s ON s.before = r.tag AND s.tag = a.tag
 QUALIFY row_number() OVER (PARTITION BY a.tweet_id, a.pos, a.tag ORDER BY r.cost + s.step, r.tag) = 1) q)"""
CHEAPEST = """cheapest AS (SELECT r.tweet_id, r.first, r.path FROM runs r LEFT JOIN choices n ON n.tweet_id = r.tweet_id AND n.pos = r.pos + 1
 LEFT JOIN steps s ON s.before = r.tag AND s.tag = n.tag WHERE coalesce(n.alts, 1) = 1
 QUALIFY row_number() OVER (PARTITION BY r.tweet_id, r.first ORDER BY r.cost + coalesce(s.step, 0), r.tag) = 1)"""
add(
    "t3_context_tags",
    per_post(
        "(SELECT tweet_id, pos, tag FROM choices WHERE alts = 1 UNION ALL "
        "SELECT tweet_id, first + generate_subscripts(path, 1) - 1, unnest(path) FROM cheapest)",
        "tag",
    ).replace("AS tokens", "AS tags"),
    TOK,
    TAGGED,
    PAIRED,
    TAGS,
    EMITS,
    STEPS,
    CHOICES,
    RUNS,
    CHEAPEST,
)
ORACLE["t3_context_tags"] = ORACLE["t3_context_tags"].replace("WITH ", "WITH RECURSIVE ", 1)
SCOPE = f"""marked AS (SELECT tweet_id, pos, CASE WHEN negator > coalesce(mark, -1) AND NOT is_mark THEN concat(token, '_NEG') ELSE token END AS token
 FROM (SELECT *, max(CASE WHEN is_negator THEN pos END) OVER w AS negator, max(CASE WHEN is_mark THEN pos END) OVER w AS mark
  FROM (SELECT *, token IN ({quoted(NEGATION)}) OR contains(token, 'n''t') AS is_negator, token IN ('.', ':', ';', '!', '?') AS is_mark FROM tok) a
  WINDOW w AS (PARTITION BY tweet_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) b)"""
UNMARKED = f"unmarked AS (SELECT tweet_id, pos, {sub('token', f'({PUNCT}{{{{2,}}}})_NEG', chr(92) + '1')} AS token FROM marked)"
FILTERED = (
    f"filtered AS (SELECT * FROM unmarked WHERE NOT regexp_matches(token, '^({PUNCT}|[0-9,.]+|{W}{{{{1,2}}}})(_NEG)?$'))"
)
NO_STOPS = f"kept AS (SELECT * FROM filtered WHERE regexp_replace(token, '_NEG$', '') NOT IN ({quoted(STOPWORDS)}))"
add("t4_mark_negation", per_post("marked"), TOK, SCOPE)
add("t5_unmark_emoticons", per_post("unmarked"), TOK, SCOPE, UNMARKED)
add("t6_filter_tokens", per_post("filtered"), TOK, SCOPE, UNMARKED, FILTERED)
add("t7_remove_stopwords", per_post("kept"), TOK, SCOPE, UNMARKED, FILTERED, NO_STOPS)
add(
    "t9_ngrams",
    per_post(
        "(SELECT tweet_id, pos, token FROM tok UNION ALL SELECT tweet_id, pos + 10000000, token FROM "
        "(SELECT tweet_id, pos, concat(token, ' ', lead(token) OVER w) AS token, lead(token) OVER w AS n FROM tok "
        "WINDOW w AS (PARTITION BY tweet_id ORDER BY pos)) q WHERE n IS NOT NULL)",
        sep="|",
    ),
    TOK,
)
TERMS = "terms AS (SELECT token AS term, count(*) AS total, count(DISTINCT tweet_id) AS docs FROM tok GROUP BY token)"
add(
    "t10_vocabulary",
    "(SELECT term, total AS n, docs, FALSE AS is_binary FROM terms ORDER BY n DESC, term LIMIT 20000) UNION ALL "
    "(SELECT term, docs AS n, docs, TRUE AS is_binary FROM terms ORDER BY n DESC, term LIMIT 20000)",
    TOK,
    TERMS,
)
VOCAB = "vocab AS (SELECT * FROM terms ORDER BY total DESC, term LIMIT 20000)"
TF = "tf AS (SELECT tweet_id, token AS term, CAST(count(*) AS DOUBLE) AS w FROM tok WHERE token IN (SELECT term FROM vocab) GROUP BY 1, 2)"
IDF = """weighted AS (SELECT tweet_id, t.term, w * (ln((1.0 + (SELECT count(*) FROM {tweets_fx})) / (1.0 + docs)) + 1) AS w
 FROM tf t JOIN vocab v ON t.term = v.term)"""


def weights(source: str, value: str) -> str:
    return (
        f"SELECT term, count(*) AS docs, round(sum({value}), 6) AS weight FROM "
        f"(SELECT *, sqrt(sum(w * w) OVER (PARTITION BY tweet_id)) AS norm FROM {source}) q GROUP BY term"
    )


add("t11_term_vector", weights("tf", "w"), TOK, TERMS, VOCAB, TF)
add("t12_l2_tf", weights("tf", "w / norm"), TOK, TERMS, VOCAB, TF)
add("t13_tfidf", weights("weighted", "w / norm"), TOK, TERMS, VOCAB, TF, IDF)
UNESCAPED = "replace(replace({}, '&amp;', '&'), '&amp;', '&')"
add("t15_unescape_html", f"SELECT tweet_id, {UNESCAPED.format('tweet_text')} AS tweet_text FROM {{tweets_fx}}")
add("t16_squeeze_whitespace", rf"SELECT tweet_id, trim({sub('tweet_text', r'\s+', ' ')}) AS tweet_text FROM {{tweets_fx}}")
EDGE = braces(r"""[''"“”‘’«»{}()\[\]*&]+""")
OFF = r"[:;.,\s]"
LEFT = sub("tweet_text", rf"(^|{OFF})({EDGE})([a-zA-Z0-9])", r"\1\2 \3")
add("t17_split_edge_punct", f"SELECT tweet_id, {sub(LEFT, rf'([a-zA-Z0-9])({EDGE})($|{OFF})', r'\1 \2\3')} AS tweet_text FROM {{tweets_fx}}")
# What the fixture wrote around a post's text, as tokens
CASE = "CAST(tweet_id % 9 AS INT)"
HEADS = {0: "concat('RT @user', tweet_id, ' :')", 1: "concat('@user', tweet_id)", 4: "concat('i saw #', title, ' at 12:30 for $7.50 , 1,234 people !!!')", 5: "concat('loved ', upper(title), ' ...')"}
TAILS = {1: "concat('#', title)", 2: "'it was not good at all . :-) yes'", 3: "'see https://t.example.com/a/b?x=1 & more'", 6: "'said Dr. O''Neil <3'"}


def ends(name: str, heads: dict[int, str], tails: dict[int, str]) -> None:
    def pick(by: dict[int, str]) -> str:
        return f"CASE {CASE} " + " ".join(f"WHEN {k} THEN {v}" for k, v in by.items()) + " ELSE '' END"

    add(name, f"SELECT tweet_id, {pick(heads)} AS head, {pick(tails)} AS tail FROM {{tweets_fx}}")


ends("t18_fixture_spans", {4: "concat('#', title, ' 12:30 $7.50 , 1,234 !!!')"}, {2: "'. :-)'", 6: "'Dr. O''Neil <3'"})
ends("t19_fixture_tokens", HEADS, {k: TAILS[k] for k in (1, 2)})
ends("t20_fixture_tokens", HEADS, TAILS)
add(
    "t20_characters_kept",
    rf"SELECT tweet_id, {sub(UNESCAPED.format('tweet_text'), r'\s+')} AS characters FROM {{tweets_fx}}",
)
SHORT = "CASE WHEN length(token) = 3 THEN concat(token, 'n''t') WHEN length(token) = 4 THEN concat(token, '''ll') ELSE token END"
CONTRACTION = rf"(?i)^(.*{W})(n[''’′]t|[''’′](ve|ll|d|re|s|m))$"
add(
    "t21_split_contraction",
    per_post(f"(SELECT tweet_id, pos, regexp_replace({SHORT}, '{CONTRACTION}', '\\1 \\2') AS token FROM tok)"),
    TOK,
)
add(
    "f1_apply_tokenizer",
    "SELECT tweet_id, array_to_string(regexp_extract_all(lower(tweet_text), '[a-z]+'), ' ') AS tokens FROM {tweets_fx}",
)
add(
    "f2_apply_tokenizer_keep_case",
    "SELECT tweet_id, array_to_string(regexp_extract_all(replace(tweet_text, '#', ' '), '[A-Za-z]+'), ' ') AS tokens FROM {tweets_fx}",
)

# Casual tokens without look-around, which RE2 lacks: the texts hold no "www." and no handle before "@".
SPACE = r"[ \t\n\r\f]"
REPEATS = "abcdefghijklmnopqrstuvwxyz0123456789àâäçéèêëîïôöùûüßñáíóú"
MARKS = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
PREPARED = r"regexp_replace(replace(lower(tweet_text), '&amp;', '&'), '(^|[^a-z0-9_!@#$%&*])@[a-z0-9_]{{1,20}}', '\1 ', 'g')"
for mark in REPEATS:
    PREPARED = sub(PREPARED, mark + "{{3,}}", mark * 3)
for mark in MARKS:
    PREPARED = sub(PREPARED, f"[{chr(92)}{braces(mark)}]" + "{{3,}}", braces(mark * 3 if mark != chr(92) else mark * 6))
WORD_LETTER = braces(r"[\p{L}]")
CASUAL = "|".join(
    [
        r"https?://[^<> \t\n\r\f]*[^<>.,;:!?''\")\] \t\n\r\f]",
        braces(r"[<>]?[:;=8][\-o*'']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][\-o*'']?[:;=8][<>]?|<3"),
        r"<[^> \t\n\r\f]+>",
        "-+>|<-+",
        f"@{W}+",
        f"#+{W}(?:{W}|['' -])*{W}".replace("'' -", "''-"),
        f"(?:{W}|[.+-])+@(?:{W}|-)+" + r"\." + f"(?:{W}|-)(?:" + r"\.?" + f"(?:{W}|-))+",
        f"{WORD_LETTER}(?:{WORD_LETTER}|[''_-])+{WORD_LETTER}",
        r"[+-]?[0-9]+[,/.:-][0-9]+[+-]?",
        f"{W}+",
        rf"\.(?:{SPACE}*\.)+",
        r"[^ \t\n\r\f]",
    ]
)
CASUAL_TOK = f"""tok AS (SELECT tweet_id, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token FROM
 (SELECT tweet_id, regexp_extract_all({PREPARED}, '{CASUAL}') AS toks FROM {{tweets_fx}}) q)"""
add("t1_casual_tokenize", per_post("tok"), CASUAL_TOK)
add("t8_tokenize_post", per_post("kept"), CASUAL_TOK, SCOPE, UNMARKED, FILTERED, NO_STOPS)
IS_PLURAL = "k.wordclass = 'n' AND regexp_matches(k.token, '^[a-z]{{3,}}s$')"
LEMMATIZED = f"""tok AS (SELECT tweet_id, pos, CASE WHEN {IS_PLURAL} AND token IN (SELECT token FROM plain) THEN left(token, length(token) - 1)
 ELSE token END AS token FROM (SELECT c.*, CASE WHEN c.token IN (SELECT token FROM plain) AND (c.token LIKE '%ing') THEN 'v'
  WHEN c.token IN (SELECT token FROM plain) AND c.token LIKE '%ly' THEN 'r'
  WHEN c.token IN (SELECT token FROM plain) AND c.token LIKE '%ble' THEN 'a' ELSE 'n' END AS wordclass FROM casual c) k)"""
add(
    "t8_tokenize_post_with_lemmas",
    per_post("kept"),
    "plain AS (SELECT DISTINCT token FROM (" + TOK[len("tok AS (") : -1] + ") p)",
    "casual AS (" + CASUAL_TOK[len("tok AS (") :],
    LEMMATIZED,
    SCOPE,
    UNMARKED,
    FILTERED,
    NO_STOPS,
)

# --- Models ---
add(
    "m3_stratified_folds",
    """SELECT tweet_id, CAST(label AS BIGINT) AS label,
 CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY tweet_id) - 1) % 5 AS BIGINT) AS fold FROM {sentiment_fx}""",
)
for name in ("m1_softmax_optimum", "m12_ridge_optimum"):
    add(name, "SELECT DISTINCT CAST(label AS BIGINT) AS label, TRUE AS penalty_is_one FROM {sentiment_fx}")
add(
    "m10_hinge_optimum",
    "SELECT DISTINCT CAST(label AS BIGINT) AS label, TRUE AS length_is_best, TRUE AS intercept_is_best FROM {sentiment_fx}",
)
add(
    "m3_tune_optimum",
    "SELECT c::DOUBLE AS \"C\", b AS is_binary, m::INT AS max_features, n::INT AS max_n, f::INT AS fold, TRUE AS penalty_is_one "
    "FROM unnest([0.1, 1.0, 10.0]) AS a(c), unnest([TRUE, FALSE]) AS b(b), unnest([5000, 10000, 20000]) AS c2(m), "
    "unnest([1, 2]) AS d(n), unnest(range(5)) AS e(f)",
)
add("s13_save_and_load_model", "SELECT tweet_id, TRUE AS same FROM {tweets_fx}")
add("m5_score_is_consistent", "SELECT title, tweet_id, CAST(1.0 AS DOUBLE) AS total, TRUE AS is_best FROM {tweets_fx}")
PR = "round(pr_neg, 6) AS pr_neg, round(pr_neu, 6) AS pr_neu, round(pr_pos, 6) AS pr_pos"
add(
    "m6_self_train",
    f"SELECT title, tweet_id, {PR}, CAST({ARGMAX} AS BIGINT) AS label, 'self-training' AS method FROM {{open_fx}} "
    "WHERE greatest(open_fx.pr_neg, open_fx.pr_neu, open_fx.pr_pos) >= 0.9",
)
add("m7_annotation_queue", f"SELECT title, tweet_id, pos, {PR}, 'manual-annotation' AS method FROM {{queue_fx}}")
add(
    "m8_update_validation",
    f"""SELECT r.title, r.tweet_id, r.label, md5(t.tweet_text) AS text_hash FROM (
 SELECT title, tweet_id, CAST(label AS BIGINT) AS label FROM {{sentiment_fx}} WHERE part = 'validation'
 UNION ALL SELECT title, tweet_id, label FROM ({KEPT}) k) r JOIN {{tweets_fx}} t ON r.tweet_id = t.tweet_id""",
    ANSWERED,
)
add("m9_train_test_split", "SELECT tweet_id, (tweet_id * 31 + 42) % 100 < 33 AS is_test FROM {sentiment_fx}")
add(
    "m11_naive_bayes_parameters",
    """SELECT CAST(label AS BIGINT) AS label, term, round(ln((coalesce(w, 0) + 1.0) / (total + (SELECT count(DISTINCT term) FROM cw))), 6) AS log_prob,
 round(ln(CAST(n AS DOUBLE) / (SELECT count(*) FROM {sentiment_fx})), 6) AS log_prior
 FROM (SELECT c.label, c.n, c.total, d.term, cw.w FROM
  (SELECT a.label, a.n, b.total FROM (SELECT label, count(*) AS n FROM {sentiment_fx} GROUP BY label) a
   JOIN (SELECT label, sum(w) AS total FROM cw GROUP BY label) b ON a.label = b.label) c
  CROSS JOIN (SELECT DISTINCT term FROM cw) d LEFT JOIN cw ON cw.label = c.label AND cw.term = d.term) q""",
    TOK,
    "cw AS (SELECT label, token AS term, CAST(count(*) AS DOUBLE) AS w FROM tok JOIN {sentiment_fx} s ON tok.tweet_id = s.tweet_id GROUP BY 1, 2)",
)
HIT = "round(avg(CASE WHEN {} = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy"
add(
    "m13_accuracy_by_model",
    f"SELECT part, 'old' AS model, {HIT.format('old_class')} FROM {{predictions_fx}} GROUP BY part "
    f"UNION ALL SELECT part, 'new' AS model, {HIT.format('new_class')} FROM {{predictions_fx}} GROUP BY part",
)
add(
    "m14_compare_before_after",
    f"SELECT 'old' AS model, {HIT.format('old_class')} FROM {{predictions_fx}} UNION ALL SELECT 'new', {HIT.format('new_class')} FROM {{predictions_fx}}",
)

# --- Jobs ---
RAW = "regexp_replace(replace(replace(replace(tweet_text, chr(10), ''), '''', ''), '\"', ''), '" + f"(RT )?@{W}+:?" + "', '', 'g')"
add(
    "d1_daily_posts",
    f"""SELECT title, tweet_id, FALSE AS tweet_retweet, {AT} AS tweet_mention,
 trim({sub(sub(f"regexp_replace({RAW}, concat('(?i)#?', title), '', 'g')", '  +', ' '), r'^\s+|\s+$')}) AS tweet_text
 FROM (SELECT t.title, p.tweet_id, p.tweet_text FROM (SELECT DISTINCT title FROM {{tweets_fx}} WHERE tweet_date = DATE '2017-01-03') t
  JOIN {{tweets_fx}} p ON contains({WORDS.format('p.tweet_text')}, {WORDS.format('t.title')})
  WHERE p.tweet_date = DATE '2017-01-03' AND lang = 'en' AND NOT regexp_matches(tweet_text, 'https?://') AND NOT {RT}) q
 QUALIFY ROW_NUMBER() OVER (PARTITION BY title ORDER BY tweet_id % 86400 DESC, tweet_id DESC) <= 5""",
)
add(
    "d4_ingest_days",
    f"""SELECT CAST(tweet_date AS VARCHAR) AS gross_date, title, CAST(rank AS BIGINT) AS rank, daily_gross, tweet_id,
 md5(trim({sub(sub(f"regexp_replace({RAW}, concat('(?i)#?', title), '', 'g')", '  +', ' '), r'^\s+|\s+$')})) AS tweet_text
 FROM (SELECT t.title, t.rank, t.daily_gross, p.tweet_date, p.tweet_id, p.tweet_text FROM
  (SELECT tweet_date, title, count(*) AS daily_gross, row_number() OVER (PARTITION BY tweet_date ORDER BY count(*) DESC, title) AS rank FROM {{tweets_fx}} GROUP BY 1, 2) t
  JOIN {{tweets_fx}} p ON p.tweet_date = t.tweet_date AND contains({WORDS.format('p.tweet_text')}, {WORDS.format('t.title')})
  WHERE rank <= 10 AND lang = 'en' AND NOT regexp_matches(tweet_text, 'https?://') AND NOT {RT}) q
 QUALIFY ROW_NUMBER() OVER (PARTITION BY tweet_date, title ORDER BY tweet_id % 86400 DESC, tweet_id DESC) <= 200""",
)
add(
    "d2_daily_metrics",
    f"SELECT title, CAST(tweet_date AS VARCHAR) AS pred_date, {SHARES}, {MEANS} FROM "
    f"(SELECT *, {ARGMAX} AS c FROM {{open_fx}}) q GROUP BY title, tweet_date",
)
add(
    "d3_labeled_rows",
    f"""SELECT title, tweet_id, CAST({ARGMAX} AS BIGINT) AS label, 'self-training' AS method, round(pr_neg, 6) AS pr_neg FROM {{open_fx}}
 WHERE greatest(open_fx.pr_neg, open_fx.pr_neu, open_fx.pr_pos) >= 0.9
 UNION ALL SELECT k.title, k.tweet_id, k.label, 'manual-annotation', round(q.pr_neg, 6) FROM ({KEPT}) k JOIN {{queue_fx}} q ON q.pos = k.pos""",
    ANSWERED,
)
add(
    "d4_missing_days",
    "SELECT DISTINCT CAST(gross_date AS VARCHAR) AS gross_date FROM {boxoffice_fx} WHERE gross_date NOT IN "
    "(SELECT DATE '1992-01-01' + CAST(tweet_id % 3000 AS INT) FROM {scores_fx})",
)
