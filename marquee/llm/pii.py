"""Personal data: patterns of its own form, and identifiers found by the words before them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, slices
from marquee.session import cut_lineage, fits_broadcast

KINDS = ("email", "ip", "card", "phone", "context")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match begins where its run of digits begins, so long runs are read once
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
HAS_DIGIT = re.compile(r"[0-9]")
# identifier-like tokens: at least five characters with a digit among them
TOKEN = re.compile(r"\S+")
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9@._+/-]*[A-Za-z0-9]")
FILTER_BITS = 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ signs in one pass."""
    end = before = 0
    at = text.find("@")
    while at >= 0:
        left = text[max(end, before) : at]
        start = at - (len(left) - len(left.rstrip(LOCAL)))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        before = at + 1
        at = text.find("@", max(before, end))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds in order of kind and start; code points, end exclusive."""
    if not text:
        return []
    spans = [("email", *s) for s in emails(text)] if "@" in text else []
    if not HAS_DIGIT.search(text):
        return spans
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str, bool, list[str]]]:
    """Identifier-like values with the lexical patterns before them: (start, end, instance, is seed, patterns).

    A pattern is ``word value`` ("1 " + word), ``word word value`` ("2 " + both words) or ``name=value`` ("= " + name).
    Base spans are the seeds; a value that overlaps one is that seed.
    """
    found = []
    places = sorted((s, e) for _, s, e in spans)
    before: list[str] = []
    nearest = 0
    seed_end = -1
    for m in TOKEN.finditer(text):
        token, start = m[0], m.start()
        while nearest < len(places) and places[nearest][0] < m.end():
            s, e = places[nearest]
            nearest += 1
            if s >= seed_end:
                found.append((s, e, text[s:e], True, _patterns(before, text[start:s])))
            seed_end = max(seed_end, e)
        if start >= seed_end and len(token) >= 5 and HAS_DIGIT.search(token):
            cut = max(token.rfind("="), token.rfind(":")) + 1
            if v := VALUE.search(token, cut):
                if len(v[0]) >= 5 and HAS_DIGIT.search(v[0]):
                    found.append((start + v.start(), start + v.end(), v[0], False, _patterns(before, token[: v.start()])))
        before = [*before[-1:], token]
    return found


def _patterns(before: list[str], head: str) -> list[str]:
    head = head.strip("\"'([{<").lower()
    if head.endswith(("=", ":")):
        return [f"= {head}"]
    low = [w.encode().lower().decode() for w in before]
    return ([f"1 {low[-1]}"] if low else []) + ([f"2 {low[-2]} {low[-1]}"] if len(low) > 1 else [])


_ROW = "key string, base string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, found array<struct<s:int,e:int,instance:string,seed:boolean,patterns:array<string>>>"
_FOUND = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        out = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            found = candidates(text, spans) if text and (spans or HAS_DIGIT.search(text)) else []
            counts = [sum(s[0] == k for s in spans) for k in KINDS[:4]]
            key = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if found or spans else None
            out.append((key, joined(spans), *counts, [dict(zip(("s", "e", "instance", "seed", "patterns"), f, strict=True)) for f in found]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, _FOUND]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", "key", "base", "n_email", "n_ip", "n_card", "n_phone", "found"])


def _pattern_hash(pattern: str, hashes: WordHashes) -> int:
    kind, _, rest = pattern.partition(" ")
    h = hashes.of(rest.encode().split(b" "))
    return int(h[0] if kind == "1" else h[0] * np.uint64(3) + h[1])


def _filter_bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        hashes = WordHashes()
        yield pd.DataFrame({"h": np.array([_pattern_hash(p, hashes) for p in frame["pattern"]], np.uint64).view(np.int64), "pattern": frame["pattern"]})


def _occurrences(places: np.ndarray):
    """How often the words of each wanted pattern occur, whatever follows them; ``places`` filters by hash bits.

    Each of a text's ``copies`` counts as that part of it, so all of them together count once.
    """
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[places] = True
    shift = np.uint64(64 - FILTER_BITS)

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            hits, parts = [np.zeros(0, np.uint64)], [np.zeros(0)]
            for text, copies in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                h = hashes.of(text.encode("utf-8", "surrogatepass").lower().split()) if text else ()
                if len(h):
                    for x in (h, h[:-1] * np.uint64(3) + h[1:]):
                        hits.append(x[wanted[x >> shift]])
                        parts.append(np.full(len(hits[-1]), 1 / copies))
            values, at = np.unique(np.concatenate(hits), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate(parts), minlength=len(values))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["h", "n"])

    return run


def _with_copies(texts: DataFrame) -> DataFrame:
    """Every row's text and how many rows hold it; only hashes of texts that occur more than once are joined back."""
    hashed = texts.filter("text <> ''").withColumn("own", F.xxhash64("text"))
    many = cut_lineage(hashed.groupBy("own").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    side = F.broadcast(many) if fits_broadcast(many) else many
    return hashed.join(side, "own", "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))


def _counted(rows: DataFrame, patterns: DataFrame, named: DataFrame) -> DataFrame:
    """(pattern, n) for ``patterns``: how often their words occur in ``rows``; for ``name=value`` the counts of ``named``."""
    hashed = cut_lineage(patterns.filter("pattern NOT LIKE '= %'").select("pattern").mapInPandas(_filter_bits, "h bigint, pattern string"))
    # the filter has 2^24 places whatever the number of patterns
    places = np.array([r[0] for r in hashed.select(F.shiftrightunsigned("h", 64 - FILTER_BITS)).distinct().collect()], np.int64)
    own = named.join(patterns.filter("pattern LIKE '= %'"), "pattern").select("pattern", "n")
    if not len(places):
        return cut_lineage(own)
    counted = rows.mapInArrow(_occurrences(places), "h bigint, n double").groupBy("h").agg(F.round(F.sum("n")).alias("n"))
    return cut_lineage(hashed.join(counted, "h").select("pattern", "n").union(own))


def score_patterns(edges: DataFrame, occurrences: Callable[[DataFrame], DataFrame], rounds: int = 3, support: int = 3, limit: float = 0.6) -> DataFrame:
    """Patterns that find identifiers: (pattern, score) with score at least ``limit``.

    ``edges`` (pattern, instance, seed, times) is the distinct graph and how often the pattern led to the instance;
    ``occurrences`` gives (pattern, n), how often a pattern's words occur at all; it is asked for the patterns that reach
    ``support`` in a round for the first time, so identifiers found in one round admit patterns in the next. Each round: a pattern's score is the
    share of its occurrences that led to an instance, weighed by the belief in that, for patterns whose distinct
    instances have a belief of at least ``support`` together; an instance's belief is 1 for seeds, else the best score
    among its patterns. Each round is reduced by key before the shuffle.
    """
    beliefs = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("belief"))
    scores = known = None
    for _ in range(rounds):
        mass = edges.join(beliefs, "instance").groupBy("pattern").agg(F.sum("belief").alias("mass"), F.sum(F.col("belief") * F.col("times")).alias("led"))
        mass = cut_lineage(mass.filter(F.col("mass") >= support))
        new = mass.select("pattern") if known is None else cut_lineage(mass.select("pattern").join(known, "pattern", "left_anti"))
        if known is None:
            known = occurrences(new)
        elif not new.isEmpty():
            known = known.union(occurrences(new))
        scores = cut_lineage(mass.join(known, "pattern").select("pattern", F.least(F.lit(1.0), F.col("led") / F.col("n")).alias("score")))
        told = edges.join(scores, "pattern").groupBy("instance").agg(F.max("score").alias("told"))
        seeds = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("seed"))
        beliefs = cut_lineage(seeds.join(told, "instance", "left").select("instance", F.greatest("seed", F.when(F.col("told") >= limit, F.col("told")).otherwise(0.0)).alias("belief")))
    return scores.filter(F.col("score") >= limit)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: int = 3, limit: float = 0.6) -> DataFrame:
    """Personal data of every row: id, ``key`` (SHA-256 of a text with candidates), n_email, n_ip, n_card, n_phone, ``base`` and ``spans`` (kind:start:end, joined).

    The base kinds are found by their form. They seed a bootstrap: the words before a seed make lexical patterns;
    Spark scores the graph of patterns and instances for some rounds, a pattern by the share of its occurrences in
    the whole corpus that lead to a believed identifier; identifier-like values after high-scoring patterns are
    added as kind ``context``, and believed in the next round, in which they admit patterns that no seed follows. Copies of a text count once, in the graph and in the occurrences.

    Null and empty texts have no spans. Null ids and repeated rows are rows like others. Equal starts of one kind
    cannot occur. An empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scanned = cut_lineage(rows.mapInArrow(_scan, f"id {rows.schema['id'].dataType.simpleString()}, {_ROW}"))
    values = scanned.filter("size(found) > 0").select("key", F.explode("found").alias("f")).select("key", "f.*").select("*", F.explode("patterns").alias("pattern")).drop("patterns")
    edges = values.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count_distinct("key", "s").alias("times"))
    edges = cut_lineage(edges)
    # belief in a pattern is at most the number of its instances, so smaller ones can reach support in no round
    named = cut_lineage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("times").cast("double").alias("n")).filter(F.col("instances") >= support))
    seeds = edges.filter("seed").select("instance").distinct().withColumn("known", F.lit(True))
    edges = edges.join(named.select("pattern"), "pattern").join(seeds, "instance", "left")
    edges = cut_lineage(edges.select("pattern", "instance", F.coalesce("known", F.lit(False)).alias("seed"), "times"))
    texts = _with_copies(rows.select("text"))
    good = score_patterns(edges, lambda patterns: _counted(texts, patterns, named), rounds, support, limit).select("pattern")
    side = F.broadcast(good) if fits_broadcast(good) else good
    added = values.filter("NOT seed").join(side, "pattern").groupBy("key").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("added"))
    own = scanned.drop("found")
    more = own.filter("key IS NOT NULL").join(added, "key", "left")
    full = more.unionByName(own.filter("key IS NULL").withColumn("added", F.lit(None).cast("array<struct<s:int,e:int>>")))
    context = F.array_join(F.transform("added", lambda x: F.concat(F.lit("context:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), context)
    return full.select(F.col("id").alias(id_col), "key", "n_email", "n_ip", "n_card", "n_phone", "base", spans.alias("spans"))


def mask(text: str | None, spans: str | None) -> str | None:
    """``text`` with each span replaced by its kind in angle brackets; of overlapping spans the first and longest wins."""
    if not text or not spans:
        return text
    parts, end = [], 0
    found = [(int(s), -int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))]
    for start, stop, kind in sorted(found):
        if start >= end:
            parts += [text[end:start], f"<{kind.upper()}>"]
            end = -stop
        elif -stop > end:  # runs on beyond the span before it
            end = -stop
    return "".join([*parts, text[end:]])


def _mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([mask(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span of personal data in the text replaced by its kind, as in ``<EMAIL>``.

    Spans belong to a text, so they are joined back by its hash; only texts with spans go through Python.
    """
    found = find_pii(docs, id_col, text_col, **options).filter("spans <> ''")
    found = cut_lineage(found.select(F.col("key").alias("__key"), F.col("spans").alias("__spans")).distinct())
    side = F.broadcast(found) if fits_broadcast(found) else found
    joined_back = docs.withColumn("__key", F.sha2(text_col, 256)).join(side, "__key", "left")
    masked = F.pandas_udf(_mask, "string")(F.when(F.col("__spans").isNotNull(), F.col(text_col)), "__spans")
    return joined_back.withColumn(text_col, F.coalesce(masked, text_col)).select(*docs.columns)
