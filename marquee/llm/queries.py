"""The operators of this subpackage as queries over whole tables, and SQL for those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


import corpus_pipeline
from marquee.llm.bpe import bpe_encode, ids_digest, load_ranks
from marquee.llm.chat import format_conversations, read_back
from marquee.llm.common import scratch, table
from marquee.llm.decontaminate import find_leaks
from marquee.llm.html_text import extract_text
from marquee.llm.jaccard import jaccard_classes
from marquee.llm.lm import score_documents
from marquee.llm.minmax import near_duplicate_classes
from marquee.llm.pii import find_pii
from marquee.llm.prefix_trie import prefix_trie
from marquee.llm.quality import quality_verdicts
from marquee.llm.toxicity import fit, score
from marquee.llm.warc import read_archives, write_archives
from marquee.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

PROBE = r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("bigint"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE))
    return read_back(format_conversations(turns.union(probe)))


def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    return score_documents(table(spark, folder, "documents"), train)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_verdicts(table(spark, folder, "documents")).select(*columns)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    scored = score(docs, fit(docs, labels.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op8_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_pii(table(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    both = bpe_encode(table(spark, folder, "documents").select("doc_id", "text"), ranks, pattern, bytes_col="bytes")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_digest("ids").alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op13_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat_format, op2_lm_score, op3_decontamination, op4_ngram_jaccard_join, op5_html_text, op6_quality_rules, op7_toxicity, op8_warc_revisits, op9_pii, op10_byte_bpe, op11_prefix_trie, op12_whitening, op13_minmax_dedup)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE: dict[str, str] = {
    "op1_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, regexp_replace(role, '([\\<>])', '\\\1', 'g') AS r, regexp_replace(text, '([\\<>])', '\\\1', 'g') AS t FROM c)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length('<turn ' || r || '>' || chr(10) || t || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op6_quality_rules": r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
grams AS (SELECT doc_id, i, ws[i:i + 4] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2, 3, 4]) AS u(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT w.doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
       len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
       coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines
      FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       10 * n_symbols > 3 * n_words AS strict_failed,
       10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 20 * n_words AS lax_failed FROM f),
h AS (SELECT source, count(*) AS d, count(*) FILTER (base_failed OR strict_failed OR lax_failed) AS k FROM r GROUP BY source),
m AS (SELECT sum(k) / sum(d) AS m, var_pop(CASE WHEN source IS NOT NULL THEN k / d END) AS v,
       avg(CASE WHEN source IS NOT NULL THEN 1 / d END) AS c FROM h),
p AS (SELECT m, least(greatest(m * (1 - m) / greatest(v - m * (1 - m) * c, 1e-9) - 1, 1), 1000) AS s FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND NOT strict_failed AND (coalesce((k + m * s) / (d + s) <= 0.5, true) OR NOT lax_failed) AS kept
FROM r LEFT JOIN h ON r.source = h.source CROSS JOIN p""",
    "op8_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN page_id < original THEN original END AS refers_to FROM m""",
}
# crc32 bit by bit: DuckDB has no function for it
ORACLE["op11_prefix_trie"] = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn
 FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'r': r, 'x': x} ORDER BY rn) AS turns FROM t GROUP BY c),
b AS (SELECT c, turns, list_transform(range(1, len(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k, 1))::BIGINT) AS bytes FROM o),
h AS (SELECT c, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
   lambda u, v: list_reduce(list_prepend(xor(u, v), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda p, q: xor(p >> 1, (p & 1) * 3988292384))), 4294967295) % 4 AS h FROM b),
s AS (SELECT h.c, list_concat(coalesce(o.turns[1:h.h], []), h.turns[h.h + 1:]) AS s FROM h LEFT JOIN o ON o.c = h.c - h.c % 20),
p AS (SELECT c, s, d, s[1:d] AS p FROM s, unnest(range(0, len(s) + 1)) AS u(d)),
n AS (SELECT p, d, min(c) AS conv, count(*) AS n,
  (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(any_value(s[d].x), '[^ 	-
]+')) END AS saved,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends FROM p GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN k ON k.d = n.d AND k.p = n.p),
a AS (SELECT m.p[1:u.d] AS p, u.d, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved FROM m, unnest(range(0, m.d + 1)) AS u(d) GROUP BY 1, 2)
SELECT m.conv AS conv_id, m.d AS depth, q.conv AS parent_conv_id, m.n AS n_convs, m.children AS n_children, a.leaves AS n_leaves,
 a.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN a ON a.d = m.d AND a.p = m.p LEFT JOIN n q ON q.d = m.d - 1 AND q.p = m.p[1:m.d - 1]"""


def _linked_classes(width: int, percent: int, columns: str) -> str:
    """Classes of documents whose shingle sets are alike, all pairs that share a shingle counted."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, hash(ws[i:i + {width - 1}]) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {width - 2}, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
f AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
d AS (SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(n_links, 0) AS n_links
 FROM w LEFT JOIN n USING (doc_id) LEFT JOIN f ON f.a = doc_id LEFT JOIN k ON k.a = doc_id)
SELECT {columns} FROM d"""


ORACLE["op4_ngram_jaccard_join"] = _linked_classes(4, 85, "doc_id, n_shingles, component_id, n_links")
ORACLE["op13_minmax_dedup"] = _linked_classes(5, 85, "doc_id, n_shingles, component_id, doc_id = component_id AS kept")
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
