"""Quality rules with verdicts on hosts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, slices, windows
from marquee.session import cut_lineage, fits_broadcast

WINDOW = 5
SYMBOLS = re.compile(r"[#*$%&|<>]")
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def features_of(text: str | None, hashes: WordHashes) -> tuple[int, ...]:
    """The numbers of ``FEATURES`` for one text; zeros for null."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    n = len(tokens)
    joined = b"".join(tokens)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    seen: set[bytes] = set()
    lines = duplicates = 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            digest = line if len(line) < 64 else xxhash.xxh3_128_digest(line)
            duplicates += digest in seen
            seen.add(digest)
    repeated = 0
    if n > WINDOW:
        found, place, counts = np.unique(windows(hashes.of(tokens), WINDOW), return_inverse=True, return_counts=True)
        if len(found) < n - WINDOW + 1:
            starts = np.flatnonzero(counts[place] > 1)
            change = np.zeros(n + 1, np.int64)
            change[starts] = 1
            np.subtract.at(change, starts + WINDOW, 1)
            repeated = int((np.cumsum(change) > 0).sum())
    return n, chars, len(SYMBOLS.findall(text)), duplicates, repeated, lines


def _features(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, text_col):
            found = np.array([features_of(t, hashes) for t in batch.column(text_col).to_pylist()], np.int64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), *(pa.array(found[:, k]) for k in range(len(FEATURES)))], ["id", "host", *FEATURES])

    return run


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source") -> DataFrame:
    """(id, host, features) of every row, and which rules it fails: ``base_failed``, ``strict_failed``, ``lax_failed``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.col(host) if isinstance(host, str) else host).cast("string").alias("host"))
    found = rows.mapInArrow(_features("text"), f"id {rows.schema['id'].dataType.simpleString()}, host string, " + ", ".join(f"{f} bigint" for f in FEATURES))
    return found.withColumns(
        {
            "base_failed": F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"),
            "strict_failed": F.expr("10 * n_symbols > 3 * n_words"),
            "lax_failed": F.expr("10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 20 * n_words"),
        }
    )


def host_verdicts(features: DataFrame, limit: float = 0.5) -> DataFrame:
    """(host, docs, failures, rate, trusted): failure rates of hosts, shrunk towards the mean of all hosts.

    The beta prior comes from the hosts' own rates by moments: mean m of all rows and the spread s of the rates
    beyond what chance gives; rate = (failures + a) / (docs + a + b) with a + b = m (1 - m) / s - 1, held
    between 1 and 1,000. Rows without host count for the prior only.
    """
    failed = (F.col("base_failed") | F.col("strict_failed") | F.col("lax_failed")).cast("bigint")
    hosts = features.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum(failed).alias("failures"))
    rate = F.col("failures") / F.col("docs")
    prior = hosts.agg(
        F.sum("failures").alias("f"),
        F.sum("docs").alias("d"),
        F.var_pop(F.when(F.col("host").isNotNull(), rate)).alias("v"),
        F.avg(F.when(F.col("host").isNotNull(), 1 / F.col("docs"))).alias("c"),
    ).first()
    mean = (prior["f"] or 0) / prior["d"] if prior["d"] else 0.0
    spread = max((prior["v"] or 0.0) - mean * (1 - mean) * (prior["c"] or 0.0), 1e-9)
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0)
    shrunk = (F.col("failures") + mean * strength) / (F.col("docs") + strength)
    return hosts.filter("host IS NOT NULL").withColumn("rate", shrunk).withColumn("trusted", F.col("rate") <= limit)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source", limit: float = 0.5) -> DataFrame:
    """A row per input row: id, host, features, failed rules, the host's shrunk rate, and ``kept``.

    A row goes when it fails the base rules (too few words, too much repeated) or the strict symbol rule. A row
    of a host whose shrunk failure rate is above ``limit`` must pass the laxer-to-fail rules too; clean rows of
    such a host stay. Rows without host are judged by their own rules. Null and empty texts have no words and
    fail. Repeated rows count and are judged each for itself; other columns are not looked at; an empty table
    gives an empty result. Features are made once, counts by host are reduced before the shuffle, and host
    verdicts are joined back (broadcast when measured small).
    """
    features = cut_lineage(quality_features(docs, id_col, text_col, host))
    verdicts = host_verdicts(features, limit).select(F.col("host").alias("of"), "rate", "trusted")
    side = F.broadcast(verdicts) if fits_broadcast(verdicts) else verdicts
    known = features.filter("host IS NOT NULL").join(side, F.col("host") == F.col("of"), "left").drop("of")
    judged = known.unionByName(features.filter("host IS NULL").withColumns({"rate": F.lit(None).cast("double"), "trusted": F.lit(True)}))
    kept = ~F.col("base_failed") & ~F.col("strict_failed") & (F.col("trusted") | ~F.col("lax_failed"))
    return judged.withColumn("kept", kept).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps. Rows with one id and different texts are told apart.

    A row's own rules and its host's verdict are all that counts, so rejected rows are found by id and text hash.
    """
    tagged = docs.withColumn("__own", F.xxhash64(F.col(text_col)))
    own = F.struct(F.col(id_col).alias("id"), F.col("__own").alias("own"), F.col(host).cast("string").alias("at"))
    verdicts = quality_verdicts(tagged.select(own.alias("__key"), F.col(text_col).alias("text"), F.col(host).cast("string").alias("host")), "__key", "text", "host")
    gone = cut_lineage(verdicts.filter("NOT kept").select(*(F.col(f"__key.{c}").alias(f"__{c}_gone") for c in ("id", "own", "at"))).distinct())
    side = F.broadcast(gone) if fits_broadcast(gone) else gone
    same = tagged[id_col].eqNullSafe(side["__id_gone"]) & tagged["__own"].eqNullSafe(side["__own_gone"]) & tagged[host].cast("string").eqNullSafe(side["__at_gone"])
    return tagged.join(side, same, "left_anti").drop("__own")
