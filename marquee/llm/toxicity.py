"""Toxicity by votes of the nearest labelled examples, found exactly with a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices
from marquee.session import cut_lineage, fits_broadcast

EDGES = b".,;:!?\"'()[]{}<>|*#$%&~`^_+=/\\-"
STEMS = (4, 5, 7)  # code points of the word beginnings that are terms too
BLOCK = 64
FIRST_BLOCKS = 4
KEPT_VOTES = 200_000
# Parameters of the model's size: the terms vectors are made of, and the distinct example vectors in the index
MAX_TERMS = 4096
MAX_EXAMPLES = 20_000


def terms_of(word: bytes) -> tuple[str, ...]:
    """Terms of a lower-cased word: itself without signs at its ends, and its beginnings."""
    text = word.strip(EDGES).decode("utf-8", "replace")
    return (text, *(f"{text[:n]}*" for n in STEMS if len(text) > n)) if text else ()


class _Terms(dict):
    """Word -> its terms, or the numbers of its chosen terms."""

    LIMIT = 400_000

    def __init__(self, chosen: dict[str, int] | None = None):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes):
        if len(self) >= self.LIMIT:
            self.clear()
        found = terms_of(word)
        if self.chosen is not None:
            found = tuple(self.chosen[t] for t in found if t in self.chosen)
        self[word] = found
        return found


def _tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Terms()
    for batch in slices(batches, "text"):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update({t for w in set(_tokens(text)) for t in known[w]})
        found = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), pa.array([counts[0][t] for t in found], pa.int64()), pa.array([counts[1][t] for t in found], pa.int64())], ["term", "clean", "toxic"]
        )


def choose_terms(labelled: DataFrame, least: float, purity: float, max_terms: int) -> tuple[dict[str, int], np.ndarray, int]:
    """Terms that tell toxic rows (log-likelihood ratio of at least ``least``, share of at least ``purity``), with their idf.

    Counts are over all labelled rows, reduced in each task before the shuffle; at most ``max_terms`` terms, those
    of the highest ratio, reach the driver.
    """
    totals = labelled.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        return {}, np.zeros(0), clean + toxic
    counts = labelled.select("text", "toxic").mapInArrow(_term_counts, "term string, clean bigint, toxic bigint")
    counts = counts.groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    share = toxic / (clean + toxic)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    df = F.col("c") + F.col("t")
    rest_c, rest_t = clean - F.col("c"), toxic - F.col("t")
    rest = rest_c + rest_t
    ratio = 2 * (part(F.col("t"), df * share) + part(F.col("c"), df * (1 - share)) + part(rest_t, rest * share) + part(rest_c, rest * (1 - share)))
    best = counts.filter(F.col("t") >= df * max(purity, share)).withColumn("ratio", ratio).filter(F.col("ratio") >= least)
    rows = best.orderBy(F.desc("ratio"), "term").limit(max_terms).select("term", df.alias("df")).collect()
    idf = np.array([math.log((1 + clean + toxic) / (1 + r["df"])) + 1 for r in rows])
    return {r["term"]: k for k, r in enumerate(rows)}, idf, clean + toxic


def vector_of(text: str | None, known: _Terms) -> tuple[tuple[int, int], ...]:
    """(term number, how often) of the chosen terms in a text, by number."""
    found = list(chain.from_iterable(map(known.__getitem__, _tokens(text))))
    return tuple(sorted(Counter(found).items())) if found else ()


def weights(vector: tuple[tuple[int, int], ...], idf: np.ndarray) -> dict[int, float]:
    """Unit TF-IDF weights: (1 + ln tf) idf over their length."""
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in vector}
    length = math.sqrt(sum(x * x for x in raw.values()))
    return {t: x / length for t, x in raw.items()}


@dataclass
class BlockMaxIndex:
    """Inverted lists of example vectors, cut into blocks of ``BLOCK`` examples with the largest weight of each."""

    idf: np.ndarray
    counts: np.ndarray
    toxic: np.ndarray
    ids: list
    lists: dict[int, tuple[np.ndarray, ...]] = field(default_factory=dict)

    @classmethod
    def build(cls, examples: list[tuple], idf: np.ndarray) -> BlockMaxIndex:
        """From (vector, rows, toxic rows, an id); alike vectors side by side make tight blocks."""
        examples = sorted(examples, key=lambda e: e[0])
        index = cls(idf, np.array([e[1] for e in examples], float), np.array([e[2] for e in examples], float), [e[3] for e in examples])
        postings: dict[int, tuple[list[int], list[float]]] = {}
        for k, e in enumerate(examples):
            for t, w in weights(e[0], idf).items():
                at, held = postings.setdefault(t, ([], []))
                at.append(k)
                held.append(w)
        for t, (at, held) in postings.items():
            where, w = np.array(at), np.array(held)
            block = where // BLOCK
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            index.lists[t] = (block[starts], np.maximum.reduceat(w, starts), np.r_[starts, len(w)], where, w)
        return index

    def nearest(self, vector: tuple[tuple[int, int], ...], k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of the largest cosine, exactly; equal cosines by place in the index.

        A block is looked into only while the sum of its largest weights reaches the k-th best cosine so far.
        """
        query = {t: w for t, w in weights(vector, self.idf).items() if t in self.lists}
        if not query:
            return []
        bound = np.zeros(len(self.counts) // BLOCK + 1)
        for t, w in query.items():
            block, most = self.lists[t][:2]
            bound[block] += w * most
        # first the blocks of the largest bounds, then every other block whose bound reaches the k-th best of those
        order = np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]
        now = np.zeros(len(bound), bool)
        now[order] = bound[order] > 0
        at, cosine = self._exact(query, now)
        if len(at) >= k:
            least = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
            rest = (bound >= least - 1e-12) & ~now
        else:
            rest = (bound > 0) & ~now
        if rest.any():
            more, theirs = self._exact(query, rest)
            at, cosine = np.r_[at, more], np.r_[cosine, theirs]
        best = np.lexsort((at, -cosine))[:k]
        return [(float(cosine[j]), int(at[j])) for j in best]

    def _exact(self, query: dict[int, float], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the wanted blocks that share a term with the query, and their cosines."""
        places, held = [], []
        for t, w in query.items():
            block, _, starts, at, weight = self.lists[t]
            mine = np.repeat(wanted[block], np.diff(starts))
            places.append(at[mine])
            held.append(w * weight[mine])
        at, place = np.unique(np.concatenate(places), return_inverse=True)
        return at, np.bincount(place, weights=np.concatenate(held), minlength=len(at))


@dataclass
class Model:
    """Chosen terms, the index, the share of toxic rows among examples without a chosen term, and the vote's settings."""

    terms: dict[str, int]
    index: BlockMaxIndex
    base: float
    k: int
    prior: float = 0.5
    kept: dict = field(default_factory=dict)

    def vote_kept(self, vector: tuple[tuple[int, int], ...]) -> tuple[float, list]:
        """``vote``, remembered by the process for vectors it has met."""
        if vector not in self.kept:
            if len(self.kept) >= KEPT_VOTES:
                self.kept.clear()
            self.kept[vector] = self.vote(vector)
        return self.kept[vector]

    def vote(self, vector: tuple[tuple[int, int], ...]) -> tuple[float, list]:
        """Score and the ids of the nearest examples. Votes count by the fourth power of the cosine and lean to the base."""
        near = self.index.nearest(vector, self.k) if vector else []
        for_, all_ = self.prior * self.base, self.prior
        for cosine, j in near:
            power = cosine**4 * self.index.counts[j]
            all_ += power
            for_ += power * self.index.toxic[j] / self.index.counts[j]
        return for_ / all_, [self.index.ids[j] for _, j in near[:3]]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", k: int = 20, least: float = 20.0, purity: float = 0.5, max_terms: int = MAX_TERMS, max_examples: int = MAX_EXAMPLES) -> Model:
    """Learn from labelled rows: terms from all of them, the index from at most ``max_examples`` distinct vectors.

    Rows with one vector over the chosen terms make one example with their counts. Beyond ``max_examples`` vectors,
    those of the least hash stay. Null labels, null ids and labels other than 0 and 1 are left out; of several labels
    of one id the largest counts.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("of")).agg(F.max(label_col).cast("int").alias("toxic"))
    side = F.broadcast(known) if fits_broadcast(known) else known
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(side, F.col("id") == F.col("of")).select("id", "text", "toxic")
    terms, idf, n = choose_terms(labelled, least, purity, max_terms)
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Terms(shared.value)
        for batch in slices(batches, "text"):
            found = [",".join(f"{t}:{c}" for t, c in vector_of(x, own)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), pa.array(found, pa.string())], ["id", "toxic", "vector"])

    kind = labelled.schema["id"].dataType.simpleString()
    grouped = labelled.mapInArrow(vectors, f"id {kind}, toxic int, vector string").groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"), F.min("id").alias("id"))
    grouped = cut_lineage(grouped)
    empty = grouped.filter("vector = ''").first()
    rows = grouped.filter("vector <> ''").orderBy(F.xxhash64("vector"), "vector").limit(max_examples).collect()
    examples = [(tuple(tuple(map(int, p.split(":"))) for p in r["vector"].split(",")), r["n"], r["t"], r["id"]) for r in rows]
    base = (empty["t"] + 0.5) / (empty["n"] + 1) if empty else sum(e[2] for e in examples) / max(1, sum(e[1] for e in examples))
    return Model(terms, BlockMaxIndex.build(examples, idf), base, k)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence) of every row; ``evidence`` holds ids of the nearest examples.

    Null and empty texts and texts without a chosen term get the share of toxic rows among such examples, and no
    evidence. Null ids and repeated rows are rows like others; other columns are not read; an empty table gives an
    empty result. The model is broadcast: at most ``MAX_TERMS`` terms and ``MAX_EXAMPLES`` vectors.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = _Terms(own.terms)
        for batch in slices(batches, "text"):
            found = [own.vote_kept(vector_of(text, known)) for text in batch.column("text").to_pylist()]
            scores, evidence = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(batch.schema.field("id").type))], ["id", "score", "evidence"])

    return rows.mapInArrow(run, f"id {kind}, score double, evidence array<{kind}>").withColumnRenamed("id", id_col)
