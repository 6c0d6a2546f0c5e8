"""Byte-level BPE by recursive queries of an in-process DuckDB in every task."""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import slices

# The recursion takes a step a merge, so a word of n bytes costs n * n rows; longer words go by a heap instead.
LONGEST_RECURSIVE = 128
WORDS_A_QUERY = 15_000
KEPT_WORDS = 300_000
ENCODE_CHARS = 1_000_000

# A step spreads the words that go on into token-position rows, joins adjacent pairs with the merges, takes each word's
# pair of least rank (the leftmost of equal ones), and contracts it; a word without one is done.
ENCODE = """
WITH RECURSIVE step(word, ids, done) AS (
  SELECT word, list(id ORDER BY pos), false FROM start GROUP BY word
  UNION ALL
  SELECT word,
    CASE WHEN best IS NULL THEN ids
         ELSE list_concat(list_append(ids[:best & 65535], (best >> 16)::INT), ids[(best & 65535) + 3:]) END,
    best IS NULL
  FROM (SELECT step.word, ids, best
        FROM step LEFT JOIN (
          SELECT word, min(merged::BIGINT * 65536 + pos) AS best
          FROM (SELECT word, unnest(ids[:-2]) AS a, unnest(ids[2:]) AS b, generate_subscripts(ids[2:], 1) - 1 AS pos FROM step WHERE NOT done)
          JOIN merges ON pair = a::BIGINT * 65536 + b
          GROUP BY word) USING (word)
        WHERE NOT done))
SELECT word, ids FROM step WHERE done ORDER BY word"""

# The rows are put in order once and aggregated in that order, by the one thread this database has.
DECODE = """
SELECT doc, string_agg(hex, '') AS hex
FROM (SELECT doc, hex FROM tokens LEFT JOIN vocabulary USING (id) ORDER BY pos) GROUP BY doc ORDER BY doc"""


def read_ranks(lines: list[str]) -> dict[bytes, int]:
    """Ranks from the lines of a rank file: base64 of the bytes, a space, the rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Words(dict):
    """Words by number, in the order they are first met; ``new`` are those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Codec:
    """Merge and vocabulary tables of one set of ranks in a DuckDB of this process, and words already encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self._forget()
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # two adjacent tokens merge when their bytes together are a token, whichever way it was learned
        merges = [(a, b, rank) for token, rank in ranks.items() for k in range(1, len(token)) for a, b in [(ranks.get(token[:k]), ranks.get(token[k:]))] if a is not None and b is not None]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        self._load("split", {c: np.array([m[k] for m in merges], np.int32) for k, c in enumerate(("a", "b", "merged"))})
        self.db.execute("CREATE TABLE merges AS SELECT a::BIGINT * 65536 + b AS pair, merged FROM split")
        self._load("vocabulary", {"id": list(ranks.values()), "hex": [t.hex() for t in ranks]})

    def _forget(self) -> None:
        """Words met so far, by number, and their ids one after the other."""
        self.kept = _Words()
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _load(self, name: str, columns: dict) -> None:
        given = pa.table(columns)
        self.db.register("given", given)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _query(self, sql: str, name: str, columns: dict) -> pa.Table:
        self.db.register(name, pa.table(columns))
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    def _recursive(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        found = self._query(ENCODE, "start", {"word": word, "pos": pos, "id": self.bytes[np.frombuffer(b"".join(words), np.uint8)]})
        ids = found.column("ids").combine_chunks()
        return ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy())

    def _by_heap(self, word: bytes) -> np.ndarray:
        """The same merges for one long word: pairs wait in a heap by rank and place."""
        parts: list[bytes | None] = [bytes([b]) for b in word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                pair = parts[at] + parts[after[at]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, at, pair))

        for k in range(len(parts)):
            offer(k)
        while heap:
            _, at, pair = heapq.heappop(heap)
            nxt = after[at]
            if parts[at] is None or nxt >= len(parts) or parts[at] + parts[nxt] != pair:
                continue
            parts[at], parts[nxt] = pair, None
            after[at] = after[nxt]
            if after[at] < len(parts):
                before[after[at]] = at
            offer(at)
            offer(before[at])
        return np.array([self.ranks[p] for p in parts if p is not None], np.int32)

    def _learn(self, words: list[str]) -> None:
        """Encode words and put their ids behind those known, in the order of the words."""
        raws = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = np.array([self.ranks.get(raw, -1) for raw in raws], np.int32)
        sizes = np.ones(len(raws), np.int64)
        open_ = np.flatnonzero(whole < 0).tolist()
        long = [k for k in open_ if len(raws[k]) > LONGEST_RECURSIVE]
        work = [k for k in open_ if len(raws[k]) <= LONGEST_RECURSIVE]
        found: list[tuple[list[int], np.ndarray, np.ndarray]] = []
        for k in long:
            ids = self._by_heap(raws[k])
            found.append(([k], ids, np.array([len(ids)])))
        for at in range(0, len(work), WORDS_A_QUERY):
            part = work[at : at + WORDS_A_QUERY]
            found.append((part, *self._recursive([raws[k] for k in part])))
        for part, _, counts in found:
            sizes[part] = counts
        ends = np.cumsum(sizes)
        flat = np.repeat(whole, sizes)
        for part, ids, counts in found:
            starts = (ends - sizes)[part]
            flat[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts one after the other, and where each text's begin and end.

        Each match of the pattern is encoded when it is first met and looked up afterwards.
        """
        found = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.kept) > KEPT_WORDS:
            self._forget()
        rows = [list(map(self.kept.__getitem__, ws)) for ws in found]
        if self.kept.new:
            self._learn(self.kept.new)
            self.kept.new = []
        count = [len(row) for row in rows]
        word = np.fromiter(chain.from_iterable(rows), np.int64, sum(count))
        starts = self.ends[word]
        sizes = self.ends[word + 1] - starts
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(upto[-1]) + np.repeat(starts - upto[:-1], sizes)]
        return ids, upto[np.concatenate([[0], np.cumsum(count, dtype=np.int64)])]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of the ids of each document, by a join with the vocabulary and an ordered aggregation."""
        out = [b""] * (len(ends) - 1)
        if len(ids):
            doc = np.repeat(np.arange(len(out), dtype=np.int32), np.diff(ends))
            found = self._query(DECODE, "tokens", {"doc": doc, "pos": np.arange(len(doc), dtype=np.int32), "id": ids})
            for k, text in zip(found.column("doc").to_pylist(), found.column("hex").to_pylist(), strict=True):
                out[k] = bytes.fromhex(text or "")
        return out


@lru_cache(maxsize=2)
def codec(packed: bytes, pattern: str) -> Codec:
    """The codec of this process for the given ranks."""
    return Codec(_unpack(packed), pattern)


def _pack(ranks: dict[bytes, int]) -> bytes:
    return b"".join(struct.pack("<IH", rank, len(token)) + token for token, rank in ranks.items())


def _unpack(packed: bytes) -> dict[bytes, int]:
    ranks, at = {}, 0
    while at < len(packed):
        rank, size = struct.unpack_from("<IH", packed, at)
        ranks[packed[at + 6 : at + 6 + size]] = rank
        at += 6 + size
    return ranks


def _added(df: DataFrame, new: dict[str, T.DataType]) -> tuple[list[str], T.StructType]:
    """Columns of ``df`` that stay, and the schema with the new columns behind them."""
    fields = [f for f in df.schema.fields if f.name not in new]
    return [f.name for f in fields], T.StructType([*fields, *(T.StructField(n, t) for n, t in new.items())])


def bpe_encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str | None = None) -> DataFrame:
    """``df`` with the token ids (array of int) of its text in ``ids_col``, which replaces a column of that name.

    With ``bytes_col``, the ids are decoded in the same task and their bytes put there. Each match of ``pattern`` is
    encoded by itself, without special tokens. Ranks are sent with a broadcast, as large as the given
    vocabulary. Null and empty texts have no ids. Any other column, null or repeated row goes through as it is; an
    empty table gives an empty result. A word of over 128 bytes is merged by a heap, since the recursion would
    take as many steps as it has bytes; the result is the same.
    """
    shared = df.sparkSession.sparkContext.broadcast(_pack(ranks))
    new: dict[str, T.DataType] = {ids_col: T.ArrayType(T.IntegerType())} | ({bytes_col: T.BinaryType()} if bytes_col else {})
    names, schema = _added(df, new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for batch in slices(batches, text_col, ENCODE_CHARS):
            flat, ends = own.encode(batch.column(text_col).to_pylist())
            made = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]
            if bytes_col:
                made.append(pa.array(own.decode(flat, ends), pa.binary()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], [*names, *new])

    return df.mapInArrow(run, schema)


def bpe_decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """``df`` with the bytes of its token ids in ``bytes_col``. Null ids or arrays give no bytes; unknown ids none."""
    shared = df.sparkSession.sparkContext.broadcast(_pack(ranks))
    names, schema = _added(df, {bytes_col: T.BinaryType()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                docs = [np.array([], np.int32) if not v.is_valid else v.values.drop_null().to_numpy() for v in part.column(ids_col)]
                ends = np.cumsum([0, *map(len, docs)])
                made = pa.array(own.decode(np.concatenate(docs or [np.zeros(0, np.int32)]).astype(np.int32), ends), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), made], [*names, bytes_col])

    return df.mapInArrow(run, schema)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file on the driver: a fixed table, not data of the corpus."""
    with open(path, encoding="ascii") as file:
        return read_ranks(file.readlines())


def ids_digest(ids_col: str) -> Column:
    """Hex SHA-256 of decimal ids joined by one space."""
    return F.sha2(F.array_join(ids_col, " "), 256)
