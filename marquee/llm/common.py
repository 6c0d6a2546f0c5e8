"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir

ROOT = str(Path(__file__).resolve().parents[2])

# Python works on slices of about this many characters of text at a time, whatever the batch Spark sends.
SLICE_CHARS = 4_000_000
ARROW_ROWS = 2_000


def importable(spark: SparkSession) -> SparkSession:
    """Make a session ready for this package's Python tasks.

    Workers can import the package when the driver found it without PYTHONPATH, and get ``ARROW_ROWS`` rows at a time:
    texts are long, and a batch is held by the executor and by its worker at once.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (ROOT, env.get("PYTHONPATH", "")) if p)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8, A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of the text column, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def gathered(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``size`` bytes of the text column, or one row."""
    held, total = [], 0
    for part in slices(batches, text, size):
        bytes_ = pc.sum(pc.binary_length(part.column(text))).as_py() or 0
        if held and total + bytes_ > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(part)
        total += bytes_
    if held:
        yield pa.concat_batches(held)


def release() -> None:
    """Give memory that Python no longer uses back to the machine; a worker process lives on for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


class WordHashes(dict):
    """Word -> 64-bit hash, kept for words already seen."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _S32)) * _M2
    x = (x ^ (x >> _S32)) * _M2
    return x ^ (x >> _S32)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes; of the whole sequence when it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(width, n)
    out = np.full(n - size + 1, np.uint64(size), np.uint64)
    for k in range(size):
        out = mixed(out * _M1 + hashes[k : n - size + 1 + k])
    return out


def scale_parts(df: DataFrame, amount: int, each: int, least: int = 64) -> int:
    """How many parts to deal ``amount`` units to, at about ``each`` units a part."""
    return max(least, -(-int(amount) // each))


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of a text column, by one aggregate."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
