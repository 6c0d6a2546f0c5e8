"""Language-model scores by logistic mixing of hashed-context bit predictors."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from marquee.llm.common import gathered, release, scale_parts, scratch, text_bytes, words

CHUNK_BYTES = 12_000_000
BUCKET_BYTES = 8_000_000  # text for each bucket of words
END, STOP = 0x0A, 0x20  # symbols that no word holds: end of the text, end of a word
# Bit predictors of the symbols of a word after its first, by context: one, three and five symbols before, and all before in the
# word. Each has a table of so many slots, by bits of a hash.
TABLE_BITS = (16, 18, 20, 20)
NEAR = (1, 3, 5)
GATES = 16
BUCKETS = 33
FIRST_GATES = 1024
PSEUDO = 0.3
RATE = 0.02
# Weights are learned online by several learners, each on the buckets of about so many training words, and averaged
LEARNER_WORDS = 50_000
SHARES = (0.02, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97)
CACHE_SHARES = (0.0, 0.03, 0.1, 0.3)
# Texts are dealt to classes by their most frequent word; what a class leaves to the model of all texts
CLASSES = 16
CLASS_REST = 0.15
CLASS_STEP, CLASS_FLOOR = 12.0, 21.0
TOKENS_AT_ONCE = 20_000

_K = np.uint64(0x9E3779B97F4A7C15)
_J = np.uint64(0xC2B2AE3D27D4EB4F)


# ---- the corpus as chunks of numbered words


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def _opened(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def _joined(found: list[bytes]) -> bytes:
    """Words, which hold no space, as one packed text."""
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(found))


def _split(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split()


def _first_gate(last: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Context of a word's first symbol: the last symbol of the word before and two bits of the one before that."""
    return last.astype(np.int32) * 4 + ((second.astype(np.int32) * 37) >> 3 & 3)


def _ends_of(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First symbol, and gate for the word that follows, of the end (number 0) and then of each word."""
    first = np.frombuffer(bytes([END]) + bytes(w[0] for w in found), np.uint8)
    last = np.frombuffer(bytes(1) + bytes(w[-1] for w in found), np.uint8)
    second = np.frombuffer(bytes(1) + bytes(w[-2] if len(w) > 1 else 0 for w in found), np.uint8)
    return first, _first_gate(last, second)


def _previous(seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The word before each word; 0 before the first of a text."""
    before = np.r_[0, seq[:-1]] if len(seq) else seq
    before[(np.cumsum(lengths) - lengths)] = 0
    return before


class _Numbers(dict):
    """Words by number, from 1, in the order they are first met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _chunk_types(id_type: pa.DataType) -> dict[str, pa.DataType]:
    """One table for both kinds of rows: a chunk's texts (``bucket`` -1), and its words of one bucket."""
    longs = pa.list_(pa.int64())
    return {
        "chunk": pa.int64(), "bucket": pa.int32(), "ids": pa.list_(id_type), "train": pa.list_(pa.bool_()), "lengths": longs, "bytes": longs,
        "seq": pa.binary(), "first": pa.binary(), "gate": pa.binary(), "ends": longs, "cells": longs, "cell_counts": longs, "words": pa.binary(), "counts": pa.binary(),
    }


def _chunks(id_type: pa.DataType, buckets: int):
    types = _chunk_types(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(gathered(batches, "text", CHUNK_BYTES)):
            numbers = _Numbers()
            rows, sizes, kinds = [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                found = words(text)
                rows.append(np.array(list(map(numbers.__getitem__, found)), np.int32))
                kinds.append(_class_of(found))
                sizes.append(len(text.encode("utf-8", "surrogatepass")) if text else 0)
            met = list(numbers)
            place = _bucket(np.array([xxhash.xxh64_intdigest(w) for w in met], np.uint64), buckets)
            order = np.argsort(place, kind="stable")
            met, place = [met[j] for j in order], place[order]
            renumbered = np.zeros(len(met) + 1, np.int32)
            renumbered[order + 1] = np.arange(1, len(met) + 1)
            lengths = np.array([len(r) + 1 for r in rows])
            last = np.cumsum(lengths) - 1
            seq = np.zeros(lengths.sum(), np.int32)
            inside = np.ones(len(seq), bool)
            inside[last] = False
            seq[inside] = renumbered[np.concatenate(rows)]
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            learned, kind = np.repeat(train, lengths), np.repeat(kinds, lengths)
            counts = np.bincount(seq[learned] * np.int64(CLASSES) + kind[learned], minlength=(len(met) + 1) * CLASSES).reshape(-1, CLASSES)
            first, gate = _ends_of(met)
            cells, cell_counts = np.unique((gate[_previous(seq, lengths)].astype(np.int64) * 256 + first[seq])[learned], return_counts=True)
            chunk = (TaskContext.get().partitionId() << 20) + k
            out = [
                {
                    "chunk": chunk, "bucket": -1, "ids": batch.column("id").to_pylist(), "train": train.tolist(), "lengths": lengths.tolist(), "bytes": sizes,
                    "seq": _packed(seq), "first": _packed(first), "gate": _packed(gate), "ends": counts[0].tolist(), "cells": cells.tolist(), "cell_counts": cell_counts.tolist(),
                }
            ]
            starts = np.searchsorted(place, np.arange(buckets + 1))
            for b in np.unique(place):
                part = slice(starts[b], starts[b + 1])
                out.append({"chunk": chunk, "bucket": int(b), "words": _joined(met[part]), "counts": _packed(counts[1:][part])})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in types.items()], list(types))

    return run


def _class_of(found: list[bytes]) -> int:
    """The class of a text, by its most frequent word (the first of equal ones)."""
    return xxhash.xxh64_intdigest(Counter(found).most_common(1)[0][0]) % CLASSES if found else 0


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """All distinct words of one bucket with their counts by class."""
    numbers = _Numbers()
    at, counts = [], []
    for blob, packed in zip(frame["words"], frame["counts"], strict=True):
        at.append(np.array(list(map(numbers.__getitem__, _split(blob))), np.int64))
        counts.append(_opened(packed, np.int64).reshape(-1, CLASSES))
    where, total = np.concatenate(at) - 1, np.concatenate(counts)
    summed = np.stack([np.bincount(where, weights=total[:, k], minlength=len(numbers)) for k in range(CLASSES)], axis=1).astype(np.int64)
    seen = summed.sum(axis=1) > 0
    return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "words": [_joined(list(numbers))], "counts": [_packed(summed)], "n": [int(seen.sum())], "totals": [summed.sum(axis=0).tolist()]})


# ---- the code of symbols and the contexts of their bits


@dataclass
class Code:
    """A binary code of the 256 symbols: length, and for each place the decision node and the bit."""

    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @classmethod
    def build(cls, frequency: np.ndarray) -> Code:
        """Huffman's code; every symbol has one, as each counts once more than it was seen."""
        heap = [(float(f) + 1, s, (s,)) for s, f in enumerate(frequency)]
        heapq.heapify(heap)
        paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        for node in range(255):
            (f0, _, zero), (f1, _, one) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, side in ((0, zero), (1, one)):
                for s in side:
                    paths[s].append((node, bit))
            heapq.heappush(heap, (f0 + f1, 256 + node, zero + one))
        most = max(map(len, paths))
        node, bit = np.zeros((256, most), np.int64), np.zeros((256, most), np.int8)
        for s, path in enumerate(paths):
            for k, (n, b) in enumerate(reversed(path)):
                node[s, k], bit[s, k] = n, b
        return cls(np.array([len(p) for p in paths]), node, bit)


def _spelled(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of words with their stops, the word of each symbol, and its place in the word."""
    sizes = np.array([len(w) + 1 for w in found])
    symbols = np.frombuffer(bytes([STOP]).join(found) + bytes([STOP]), np.uint8)
    owner = np.repeat(np.arange(len(found)), sizes)
    return symbols, owner, np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _decisions(found: list[bytes], code: Code) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The bits of all symbols after the first: (word, bit, table slots by predictor)."""
    symbols, owner, place = _spelled(found)
    value = symbols.astype(np.uint64) + np.uint64(1)
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(int(place.max()) + 1, _J)])
    run = np.cumsum(value * powers[place])  # wraps around; differences do too
    start = np.arange(len(symbols)) - place
    prefix = run - value * powers[place] - (run[start] - value[start] * powers[0])
    contexts, h = [], np.zeros(len(symbols), np.uint64)
    for k in range(1, max(NEAR) + 1):
        back = np.zeros(len(symbols), np.uint64)
        back[k:] = value[:-k]
        back[place < k] = 0
        h = (h + back) * _K + np.uint64(k)
        if k in NEAR:
            contexts.append(h)
    contexts.append(prefix * _K + place.astype(np.uint64))
    at = np.flatnonzero(place > 0)
    length = code.length[symbols[at]]
    rep = np.repeat(at, length)
    nth = np.arange(len(rep)) - np.repeat(np.cumsum(length) - length, length)
    node, bit = code.node[symbols[rep], nth].astype(np.uint64), code.bit[symbols[rep], nth]
    slots = []
    for context, bits in zip(contexts, TABLE_BITS, strict=True):
        x = (context[rep] + node) * _K
        x = (x ^ (x >> np.uint64(29))) * _J
        slots.append((x >> np.uint64(64 - bits)).astype(np.int64))
    return owner[rep], bit, slots


def _gate(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(seen + 1).astype(np.int64), GATES - 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tables:
    """Zeros and ones seen in every slot, by predictor; sent packed."""

    def __init__(self) -> None:
        self.zeros, self.ones = ([np.zeros(1 << b, np.float32) for b in TABLE_BITS] for _ in range(2))

    def __getstate__(self) -> list[bytes]:
        return [_packed(t) for t in (*self.zeros, *self.ones)]

    def __setstate__(self, packed: list[bytes]) -> None:
        found = [_opened(b, np.float32) for b in packed]
        self.zeros, self.ones = found[: len(TABLE_BITS)], found[len(TABLE_BITS) :]

    @cached_property
    def stretched(self) -> list[np.ndarray]:
        return [np.log((one + PSEUDO) / (zero + PSEUDO)) for zero, one in zip(self.zeros, self.ones, strict=True)]

    @cached_property
    def gate(self) -> np.ndarray:
        return _gate(self.zeros[-1] + self.ones[-1])


@dataclass
class Mixer:
    """Counts of bits by predictor, gated weights, and the adaptive refinement of the mixed bit."""

    code: Code
    tables: Tables | None
    weights: np.ndarray
    refined: np.ndarray | None = None

    def inputs(self, slots: list[np.ndarray], bit: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions of each bit, a row a predictor, and the gate: how often the whole prefix was seen.

        ``own`` takes one occurrence of the word away from the counts, as if the bit came before it was learned.
        """
        if not own:
            rows, gate = [t[slot] for t, slot in zip(self.tables.stretched, slots, strict=True)], self.tables.gate[slots[-1]]
        else:
            rows = []
            for zero, one, slot in zip(self.tables.zeros, self.tables.ones, slots, strict=True):
                n0, n1 = np.maximum(zero[slot] - (1 - bit), 0), np.maximum(one[slot] - bit, 0)
                rows.append(np.log((n1 + PSEUDO) / (n0 + PSEUDO)))
            gate = _gate(n0 + n1)
        return np.array([*rows, np.full(len(bit), 0.3)]), gate

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The mixed prediction, stretched and held within what a double can tell from certainty."""
        return np.clip(np.einsum("ij,ij->j", self.weights[gate].T, x), -12, 12)

    def learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, count: np.ndarray) -> None:
        """A step of online gradient for each gate that occurs."""
        error = (bit - _squash(self.mixed(x, gate))) * count
        total = np.bincount(gate, weights=count, minlength=GATES)
        for k in range(len(x)):
            self.weights[:, k] += RATE * np.bincount(gate, weights=error * x[k], minlength=GATES) / np.maximum(total, 1e-9) * (total > 0)

    def bucket(self, mixed: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return gate * BUCKETS + np.clip(np.rint(mixed * (BUCKETS // 2) / 12), -(BUCKETS // 2), BUCKETS // 2).astype(np.int64) + BUCKETS // 2

    def costs(self, found: list[bytes]) -> np.ndarray:
        """Bits that each word takes after its first symbol, a row each: by all counts, and with the word itself left out once."""
        owner, bit, slots = _decisions(found, self.code)
        out = []
        for own in (False, True):
            x, gate = self.inputs(slots, bit, own)
            mixed = self.mixed(x, gate)
            if self.refined is not None:
                mixed = (mixed + self.refined[self.bucket(mixed, gate)]) / 2
            out.append(np.bincount(owner, weights=np.log1p(np.exp(np.where(bit == 1, -mixed, mixed))) / math.log(2), minlength=len(found)))
        return np.array(out)


def _parts(found: list[bytes], size: int = 100_000) -> Iterator[slice]:
    """Cut a list of words into parts of about ``size`` bytes."""
    start = total = 0
    for k, w in enumerate(found):
        total += len(w) + 1
        if total >= size:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(found):
        yield slice(start, len(found))


def _learned(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of the packed vocabulary that training texts hold, with their counts."""
    for frame in frames:
        for blob, packed in zip(frame["words"], frame["counts"], strict=True):
            found, counts = _split(blob), _opened(packed, np.int64).reshape(-1, CLASSES).sum(axis=1)
            keep = np.flatnonzero(counts)
            yield [found[k] for k in keep], counts[keep].astype(np.float64)


def _symbol_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(256)
    for found, counts in _learned(frames):
        for part in _parts(found, 1_000_000):
            symbols, owner, place = _spelled(found[part])
            total += np.bincount(symbols[place > 0], weights=counts[part][owner[place > 0]], minlength=256)
    yield pd.DataFrame({"symbol": np.arange(256), "n": total})


SPAN = 1 << 16


def _bit_counts(code: Code):
    """Zeros and ones of every slot of every table, from one partition of the words; sent in spans of slots."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, seen = [[np.zeros(1 << b) for b in TABLE_BITS] for _ in range(2)], False
        for found, counts in _learned(frames):
            for part in _parts(found, 200_000):
                seen = True
                owner, bit, slots = _decisions(found[part], code)
                weight = counts[part][owner]
                for k, slot in enumerate(slots):
                    for value in (0, 1):
                        sums[value][k] += np.bincount(slot, weights=weight * (bit == value), minlength=1 << TABLE_BITS[k])
        release()
        for k, b in enumerate(TABLE_BITS if seen else ()):
            for span in range(max(1, (1 << b) // SPAN)):
                part = slice(span * SPAN, (span + 1) * SPAN)
                yield pd.DataFrame({"table": [k], "span": [span], "zeros": [_packed(sums[0][k][part].astype(np.float32))], "ones": [_packed(sums[1][k][part].astype(np.float32))]})

    return run


def _sum_spans(frame: pd.DataFrame) -> pd.DataFrame:
    total = [sum(_opened(b, np.float32).astype(np.float64) for b in frame[c]) for c in ("zeros", "ones")]
    return pd.DataFrame({"table": frame["table"].iloc[:1], "span": frame["span"].iloc[:1], "zeros": [_packed(total[0].astype(np.float32))], "ones": [_packed(total[1].astype(np.float32))]})


def _learned_weights(shared, given: Mixer):
    """Weights learned online on the words of one learner's buckets, each word left out once: sums by gate."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        mixer, total = replace(given, tables=shared.value, weights=given.weights.copy()), np.zeros(GATES)
        for found, counts in _learned([frame.sort_values("bucket")]):
            order = sorted(range(len(found)), key=found.__getitem__)
            found, counts = [found[k] for k in order], counts[order]
            for part in _parts(found):
                owner, bit, slots = _decisions(found[part], mixer.code)
                x, gate = mixer.inputs(slots, bit, True)
                count = counts[part][owner]
                total += np.bincount(gate, weights=count, minlength=GATES)
                for start in range(0, len(bit), 4096):
                    now = slice(start, start + 4096)
                    mixer.learn(x[:, now], gate[now], bit[now], count[now])
        release()
        return pd.DataFrame({"gate": np.arange(GATES), "n": total, "w": (mixer.weights * total[:, None]).tolist()})

    return run


def _refinement(shared, given: Mixer):
    """Zeros and ones of all training words by bucket of the mixed bit, each word left out once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mixer, sums = replace(given, tables=shared.value), np.zeros((2, GATES * BUCKETS))
        for found, counts in _learned(frames):
            for part in _parts(found):
                owner, bit, slots = _decisions(found[part], mixer.code)
                x, gate = mixer.inputs(slots, bit, True)
                at, count = mixer.bucket(mixer.mixed(x, gate), gate), counts[part][owner]
                for value in (0, 1):
                    sums[value] += np.bincount(at, weights=count * (bit == value), minlength=GATES * BUCKETS)
        release()
        yield pd.DataFrame({"at": np.arange(GATES * BUCKETS), "zeros": sums[0], "ones": sums[1]})

    return run


def _fitted(mixer: Mixer, shared, vocabulary: DataFrame, n_words: int) -> Mixer:
    """The mixer with weights and refinement learned on every training word; sums by gate and bucket reach the driver."""
    learner = (F.col("bucket") % max(1, n_words // LEARNER_WORDS)).alias("learner")
    learned = vocabulary.select(learner, "bucket", "words", "counts").groupBy("learner").applyInPandas(_learned_weights(shared, mixer), "gate int, n double, w array<double>")
    learned = learned.groupBy("gate").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("w", F.lit(k))) for k in range(mixer.weights.shape[1])]).alias("w"))
    weights = mixer.weights.copy()
    for r in learned.filter("n > 0").collect():
        weights[r["gate"]] = np.array(r["w"]) / r["n"]
    mixer = replace(mixer, weights=weights)
    sums = vocabulary.select("words", "counts").mapInPandas(_refinement(shared, mixer), "at int, zeros double, ones double")
    counted = sums.groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas()
    near = _squash((np.arange(GATES * BUCKETS) % BUCKETS - BUCKETS // 2) * 12 / (BUCKETS // 2))
    zeros, ones = np.zeros((2, GATES * BUCKETS))
    zeros[counted["at"].to_numpy(np.int64)], ones[counted["at"].to_numpy(np.int64)] = counted["zeros"], counted["ones"]
    return replace(mixer, refined=np.clip(np.log((ones + 2 * near) / (zeros + 2 * (1 - near))), -12, 12))


def _class_codes(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log frequency of each word in each class, rounded down to a byte; 0 for none."""
    with np.errstate(divide="ignore"):
        log = np.log(counts / np.maximum(totals, 1)) + CLASS_FLOOR
    return np.where(counts > 0, np.clip(np.floor(log * CLASS_STEP), 0, 255), 0).astype(np.uint8)


CLASS_VALUES = np.r_[0.0, np.exp(np.arange(1, 256) / CLASS_STEP - CLASS_FLOOR)]


def _priced(shared, given: Mixer, totals: np.ndarray, by_symbol: np.ndarray):
    """Prices of each bucket's words, and the log likelihood of its training words under each of ``SHARES``, each word left out once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mixer = replace(given, tables=shared.value)
        for frame in frames:
            for bucket, blob, packed in zip(frame["bucket"], frame["words"], frame["counts"], strict=True):
                found, counts = _split(blob), _opened(packed, np.int64).reshape(-1, CLASSES)
                cost, fair = np.concatenate([mixer.costs(found[part]) for part in _parts(found)], axis=1)
                total = counts.sum(axis=1)
                seen = np.maximum(total - 1, 0) / np.maximum(by_symbol[[w[0] for w in found]] - 1, 1)
                likely = [float((total * np.log(s * seen + (1 - s) * np.exp2(-fair) + 1e-300)).sum()) for s in SHARES]
                yield pd.DataFrame({"bucket": [bucket], "words": [blob], "c": [_packed(total)], "cost": [_packed(cost.astype(np.float32))], "codes": [_packed(_class_codes(counts, totals))], "likely": [likely]})
        release()

    return run


def _sent_back(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Prices of a bucket's words for each chunk, in the order of its words."""
    found = _split(right["words"].iloc[0])
    total, cost = _opened(right["c"].iloc[0], np.int64), _opened(right["cost"].iloc[0], np.float32)
    codes = _opened(right["codes"].iloc[0], np.uint8).reshape(-1, CLASSES)
    number = dict(zip(found, range(len(found)), strict=True))
    out = []
    for chunk, blob in zip(left["chunk"], left["words"], strict=True):
        at = np.array(list(map(number.__getitem__, _split(blob))), np.int64)
        out.append((chunk, right["bucket"].iloc[0], _packed(total[at]), _packed(cost[at]), _packed(codes[at])))
    del number, found, total, cost, codes
    release()
    return pd.DataFrame(out, columns=["chunk", "bucket", "c", "cost", "codes"])


def _first_table(cells: np.ndarray, code: Code) -> np.ndarray:
    """log10 probability of a word's first symbol by gate: bits along its code, mixed from three contexts.

    The contexts are the gate, the last symbol alone, and none. A bit's prediction leans on the wider context by as
    much as its own count is small, so the weights are gated by confidence.
    """
    by_gate = cells.reshape(FIRST_GATES, 256).astype(np.float64)
    levels = [by_gate.sum(axis=0, keepdims=True).repeat(FIRST_GATES, 0), by_gate.reshape(256, 4, 256).sum(axis=1).repeat(4, 0), by_gate]
    out = np.zeros((FIRST_GATES, 256))
    for s in range(256):
        for k in range(code.length[s]):
            node, bit = code.node[s, k], code.bit[s, k]
            under = (code.node == node) & (np.arange(code.node.shape[1]) < code.length[:, None])
            one = (under & (code.bit == 1)).any(axis=1)
            zero = (under & (code.bit == 0)).any(axis=1)
            x = np.zeros(FIRST_GATES)
            for level in levels:
                n0, n1 = level[:, zero].sum(axis=1), level[:, one].sum(axis=1)
                trust = (n0 + n1) / (n0 + n1 + 4)
                x = trust * np.log((n1 + 0.4) / (n0 + 0.4)) + (1 - trust) * x
            x = np.clip(x, -12, 12)
            out[:, s] -= np.log1p(np.exp(-x if bit else x)) / math.log(10)
    return out


RESULT = {"held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double", "bits_per_byte": "double"}


def _score_chunk(shared):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        first_log, lam, n_train, vocabulary, by_symbol, prior, end_count, end_codes = shared.value
        right = right.sort_values("bucket")
        c = np.concatenate([[end_count], *(_opened(b, np.int64) for b in right["c"])])
        cost = np.concatenate([[0.0], *(_opened(b, np.float32).astype(np.float64) for b in right["cost"])])
        codes = np.concatenate([[end_codes], *(_opened(b, np.uint8).reshape(-1, CLASSES) for b in right["codes"])])
        (chunk,) = left.itertuples(index=False)
        seq, first, gate = _opened(chunk.seq, np.int32), _opened(chunk.first, np.uint8), _opened(chunk.gate, np.int32)
        lengths = np.asarray(chunk.lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        base = np.log10((c + 0.1) / (n_train + 0.1 * (vocabulary + 1)))
        rest = np.where(first == END, 1.0, lam * c / np.maximum(by_symbol[first], 1) + (1 - lam) * np.exp2(-cost))
        prob = 10.0**first_log[gate[_previous(seq, lengths)], first[seq]] * np.maximum(rest, 1e-300)[seq]
        score = np.zeros(len(lengths))
        at = 0
        while at < len(lengths):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + TOKENS_AT_ONCE)))
            span = slice(starts[at], starts[to - 1] + lengths[to - 1])
            own = lengths[at:to]
            here = _with_classes(prob[span], CLASS_VALUES[codes[seq[span]]], prior, own)
            score[at:to] = np.add.reduceat(_with_cache(seq[span], here, own), starts[at:to] - starts[at]) / math.log(10)
            at = to
        release()
        return pd.DataFrame(
            {
                "id": chunk.ids,
                "held_out": ~np.asarray(chunk.train, bool),
                "n_tokens": lengths,
                "n_known": np.add.reduceat((c > 0)[seq].astype(np.int64), starts),
                "train_tokens": n_train,
                "base_score": np.add.reduceat(base[seq], starts),
                "score": score,
                "bits_per_byte": -score / math.log10(2) / np.maximum(np.asarray(chunk.bytes), 1),
            }
        )

    return run


def _mixed_online(probs: np.ndarray, prior: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of each token's probability under a mixture of models (rows), each trusted by its probability of the text before."""
    logs = np.log(np.maximum(probs, 1e-300))
    run = np.cumsum(logs, axis=1) - logs
    run -= np.repeat(run[:, np.cumsum(lengths) - lengths], lengths, axis=1)
    run += np.log(prior)[:, None]
    run -= run.max(axis=0)
    trust = np.exp(run, out=run)
    trust /= trust.sum(axis=0)
    return np.log((trust * np.maximum(probs, 1e-300)).sum(axis=0))


def _with_classes(prob: np.ndarray, classes: np.ndarray, prior: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities when word frequencies of the classes are gated in, as the text so far tells its class."""
    models = np.vstack([prob, (1 - CLASS_REST) * classes.T + CLASS_REST * prob])
    return np.exp(_mixed_online(models, prior, lengths))


def _with_cache(seq: np.ndarray, prob: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log probabilities when some fixed shares of the text's own word frequencies so far are gated in."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(seq)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.lexsort((seq, owner))  # stable: equal words of a text stay in order
    s, o = seq[order], owner[order]
    at = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (o[1:] != o[:-1])])
    seen = np.zeros(len(seq), np.int64)
    seen[order] = np.arange(len(seq)) - np.repeat(at, np.diff(np.r_[at, len(seq)]))
    own = seen / np.maximum(place, 1)
    models = np.array([prob if share == 0 else np.where(place > 0, (1 - share) * prob + share * own, prob) for share in CACHE_SHARES])
    return _mixed_online(models, np.full(len(models), 1 / len(models)), lengths)


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of the rows where ``train`` holds.

    (id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), a row per input row. Tokens are
    lower-cased words and one end. ``base_score`` is the add-0.1 unigram's log10 probability, ``score`` the
    model's. The model, a distribution over token sequences:

    1. Words of every chunk of rows are numbered; the distinct words of a chunk, with their counts in training
       rows, are dealt to buckets by hash and summed. This table holds every word of the corpus and grows with it.
    2. A word is spelled as bits of a Huffman code of its symbols. Bit predictors with hashed contexts (1, 3 and 5
       symbols, the whole prefix) hold counts of all training words in tables of fixed size; logistic mixing weighs
       them by gates of the prefix's count, and an adaptive refinement corrects the mixed bit. Weights are learned
       online on every training word by learners over some buckets each, and averaged by the bits that they saw;
       the refinement is summed over every training word. Words are left out of the counts once for both. A word's
       first symbol comes from the end of the word before.
    3. Each word is priced once in its bucket; spelling and frequency are mixed by one share, the likeliest over every
       training word.
    4. Prices go back to the chunks. There the frequencies of classes of texts, and then the text's own words so
       far, are mixed in online, gated by how well each did on the text before the token.

    A chunk holds about 12 MB of text, and a word one entry a chunk, however frequent, so neither chunks nor buckets
    have hot ones. Null and empty texts have the end only. Null ids and repeated rows are rows like others; other
    columns are not looked at; a null ``train`` counts as held out. An empty table gives an empty result; without
    training rows the scores come from empty counts.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    buckets = scale_parts(rows, text_bytes(rows, "text"), BUCKET_BYTES, least=16)
    types = _chunk_types(to_arrow_type(id_type))
    folder = scratch(spark, "lm")
    schema = T.StructType([T.StructField(c, from_arrow_type(t)) for c, t in types.items()])
    schema["ids"].dataType.elementType = id_type
    rows.mapInArrow(_chunks(types["ids"].value_type, buckets), schema).write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(schema).parquet(f"{folder}/chunks")
    texts, held = chunks.filter("bucket < 0"), chunks.filter("bucket >= 0").select("chunk", "bucket", "words", "counts")

    held.groupBy("bucket").applyInPandas(_merged, "bucket int, words binary, counts binary, n bigint, totals array<bigint>").write.parquet(f"{folder}/vocabulary")
    vocabulary = spark.read.schema("bucket int, words binary, counts binary, n bigint, totals array<bigint>").parquet(f"{folder}/vocabulary")
    by_class = [F.coalesce(F.sum(F.get("totals", F.lit(k))), F.lit(0)) for k in range(CLASSES)]
    n_words, *class_totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), *by_class).first()
    ends = np.array(texts.agg(*[F.coalesce(F.sum(F.get("ends", F.lit(k))), F.lit(0)) for k in range(CLASSES)]).first(), np.int64)
    totals = np.array(class_totals, np.int64) + ends
    n_train, n_words = int(totals.sum()), n_words + int(ends.sum() > 0)
    cells = np.zeros(FIRST_GATES * 256, np.int64)
    counted = texts.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("z")).groupBy(F.col("z.cells").alias("cell")).agg(F.sum("z.cell_counts").alias("n")).toPandas()
    cells[counted["cell"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    by_symbol = cells.reshape(FIRST_GATES, 256).sum(axis=0)

    packed = vocabulary.select("words", "counts")
    symbols = packed.mapInPandas(_symbol_counts, "symbol int, n double").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    frequency = by_symbol.astype(float)
    frequency[symbols["symbol"].to_numpy(np.int64)] += symbols["n"].to_numpy()
    code = Code.build(frequency)
    spans = packed.coalesce(max(2, context.defaultParallelism)).mapInPandas(_bit_counts(code), "table int, span int, zeros binary, ones binary")
    spans = spans.groupBy("table", "span").applyInPandas(_sum_spans, "table int, span int, zeros binary, ones binary")
    tables = Tables()
    for r in spans.collect():  # tables of fixed size
        for table, blob in ((tables.zeros, r["zeros"]), (tables.ones, r["ones"])):
            part = _opened(bytes(blob), np.float32)
            table[r["table"]][r["span"] * SPAN : r["span"] * SPAN + len(part)] = part
    sent = context.broadcast(tables)
    mixer = _fitted(Mixer(code, None, np.tile([0.1, 0.2, 0.3, 0.4, 0.0], (GATES, 1))), sent, vocabulary, n_words)

    kinds = "bucket int, words binary, c binary, cost binary, codes binary, likely array<double>"
    vocabulary.select("bucket", "words", "counts").mapInPandas(_priced(sent, mixer, totals, by_symbol), kinds).write.parquet(f"{folder}/priced")
    priced = spark.read.schema(kinds).parquet(f"{folder}/priced")
    likely = priced.agg(*[F.sum(F.get("likely", F.lit(k))) for k in range(len(SHARES))]).first()
    share = max(zip(likely, SHARES, strict=True), key=lambda x: x[0])[1] if sum(class_totals) else 0.5
    prices = held.select("chunk", "bucket", "words").groupBy("bucket").cogroup(priced.select(F.col("bucket").alias("of"), "bucket", "words", "c", "cost", "codes").groupBy("of"))
    prices = prices.applyInPandas(_sent_back, "chunk bigint, bucket int, c binary, cost binary, codes binary")
    prior = np.r_[0.1, 0.9 * (totals + 1) / (totals + 1).sum()]
    shared = context.broadcast((_first_table(cells, code), share, n_train, n_words, by_symbol, prior, int(ends.sum()), _class_codes(ends[None], totals)[0]))
    lean = texts.select("chunk", "ids", "train", "lengths", "bytes", "seq", "first", "gate")
    kind = id_type.simpleString()
    scored = lean.groupBy("chunk").cogroup(prices.withColumnRenamed("chunk", "of").groupBy("of"))
    return scored.applyInPandas(_score_chunk(shared), f"id {kind}, " + ", ".join(f"{c} {t}" for c, t in RESULT.items())).withColumnRenamed("id", id_col)
