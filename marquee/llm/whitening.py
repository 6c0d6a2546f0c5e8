"""Whitening of embeddings by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marquee.llm.common import importable
from marquee.session import cut_lineage

SCALE, SHIFT = 1024, 100_000
BYTES_A_PART = 64_000_000
MERGED_PARTS = 64
DEGREE = 10
LANCZOS_STEPS = 10
TOLERANCE = 2e-13
MOST_ROUNDS = 60
BIGGEST = float(2**52)


def _entries(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The batch's vectors as integers ``floor(1024 * c) + 100000``, a row each."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * values) + SHIFT).astype(np.int64).reshape(-1, dim)


def _pack(dim: int, id_type: pa.DataType):
    schema = pa.schema([("ids", pa.list_(id_type)), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([_entries(batch, dim).tobytes()], pa.binary())], schema=schema)

    return run


def _sum_frames(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"total": [sum(np.frombuffer(t) for t in frame["total"]).tobytes()]})


@dataclass
class Vectors:
    """Packed integer vectors, their number, dimension and exact sums; every pass over them is one job."""

    packed: DataFrame
    n: int
    dim: int
    sums: list[int]

    def total(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum of ``part(x - mean)`` over blocks of rows. Tasks send one array each, merged by Spark beyond 64 tasks."""
        dim, mean = self.dim, np.array([s / self.n for s in self.sums])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for batch in batches:
                for block in batch.column("x"):
                    out += part(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim) - mean)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["total"])

        sums = self.packed.mapInArrow(run, "total binary")
        if self.packed.rdd.getNumPartitions() > MERGED_PARTS:
            sums = sums.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGED_PARTS)).alias("at")).applyInPandas(_sum_frames, "total binary")
        return np.sum([np.frombuffer(r["total"]) for r in sums.collect()], axis=0).reshape(shape)

    def times(self, q: np.ndarray) -> np.ndarray:
        """Covariance times ``q``: one pass of centred products, the covariance itself is never made."""
        return self.total(lambda x: x.T @ (x @ q), q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([np.einsum("ij,ij->", x, x)]), (1,))[0]) / self.n


def _sums(dim: int):
    def run(batches):
        n, sums = 0, np.zeros(dim, np.int64)
        for batch in batches:
            for block in batch.column("x"):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)
                n += len(x)
                sums += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))], ["n", "sums"])

    return run


def pack_vectors(table: DataFrame, id_col: str, vector_col: str) -> Vectors | None:
    """The usable vectors in blocks, written once to the checkpoint folder; None when there are none."""
    importable(table.sparkSession)
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda c: F.coalesce(F.abs(c) < BIGGEST / SCALE, F.lit(False)) & ~F.isnan(c))
    rows = rows.filter(usable)
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    dim = most["dim"]
    rows = rows.filter(F.size("vector") == dim)
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-most["n"] * dim * 8 // BYTES_A_PART))
    id_type = rows.schema["id"].dataType
    packed = rows.coalesce(parts).mapInArrow(_pack(dim, to_arrow_type(id_type)), f"ids array<{id_type.simpleString()}>, x binary")
    packed = cut_lineage(packed)
    totals = packed.mapInArrow(_sums(dim), "n bigint, sums array<bigint>")
    merged = totals.select("n", F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = merged.orderBy("place").collect()
    return Vectors(packed, found[0]["n"], dim, [int(r["value"]) for r in found])


def least_eigenvalue(times: Callable[[np.ndarray], np.ndarray], dim: int, steps: int = LANCZOS_STEPS, seed: int = 1) -> float:
    """A bound from below for the covariance's spectrum: the least Ritz value of a few Lanczos steps less the remainder."""
    rng = np.random.default_rng(seed)
    basis = [rng.standard_normal(dim)]
    basis[0] /= np.linalg.norm(basis[0])
    alpha: list[float] = []
    beta: list[float] = []
    for _ in range(min(steps, dim)):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            for v in basis:
                w = w - (w @ v) * v
        rest = float(np.linalg.norm(w))
        beta.append(rest)
        if rest <= 1e-12 * max(map(abs, alpha)):
            break
        basis.append(w / rest)
    off = beta[: len(alpha) - 1]
    ritz = np.linalg.eigvalsh(np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, float(ritz[0]) - beta[-1])


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance on ``q``: small on [low, high], growing fast above it.

    ``vq`` is the covariance times ``q``, known from the step before; the other ``degree - 1`` terms take a pass each.
    """
    middle, half = (high + low) / 2, max((high - low) / 2, 1e-300)
    first = scale = half / (top - middle)
    before, now = q, (vq - middle * q) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (times(now) - middle * now) * (2 * after / half) - (scale * after) * before
        scale = after
    return now


def leading_components(times: Callable[[np.ndarray], np.ndarray], dim: int, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    A block of ``2 * count + 8`` directions is filtered, made orthonormal by QR, and turned by Rayleigh-Ritz, until
    the residuals ``|V q - e q|`` of all wanted pairs are at rounding error: below 2e-13 of the largest eigenvalue,
    or below 1e-10 of it and no longer falling. The block's last direction is drawn anew each round, so a direction
    that the start did not hold would come up. Raises ``ArithmeticError`` when that is not reached.
    """
    rng = np.random.default_rng(seed)
    width = min(dim, 2 * count + 8)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    vq = times(q)
    low = 0.0 if width == dim else least_eigenvalue(times, dim)
    last = np.inf
    for _ in range(MOST_ROUNDS):
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = float(values[0])
        if top <= 0:
            return values[:0], q[:, :0]
        worst = float(np.linalg.norm(vq[:, :count] - q[:, :count] * values[:count], axis=0).max()) / top
        if worst <= TOLERANCE or (worst <= 1e-10 and worst > last / 2):
            return values[:count], q[:, :count]
        last = worst
        if width == dim:
            q = np.linalg.qr(q)[0]
        else:
            high = float(values[width - 2])
            bottom = min(low, high * (1 - 1e-9))
            fresh = rng.standard_normal(dim)
            q[:, -1] = fresh / np.linalg.norm(fresh)
            vq[:, -1] = times(q[:, -1:])[:, 0]
            q = np.linalg.qr(chebyshev(times, q, vq, bottom, high, top))[0]
        vq = times(q)
    raise ArithmeticError(f"components not certified: residual {worst:.1e} of the largest eigenvalue")


def _whitened(vectors: Vectors, basis: np.ndarray, names: dict, id_type: pa.DataType):
    n, dim, sums = vectors.n, vectors.dim, vectors.sums
    mean = np.array([s / n for s in sums])
    shares, error, count = names["explained"], names["identity_error"], basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in zip(batch.column("ids"), batch.column("x"), strict=True):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)
                scores = (x - mean) @ basis
                rough = (((x - mean) * n) ** 2).sum(1)
                if rough.max(initial=0) < 2.0**62 and n * float(np.abs(x).max(initial=0)) < 2.0**62:
                    moved = n * x - np.array(sums, np.int64)
                    deviation = (moved * moved).sum(1).tolist()
                else:
                    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
                    deviation = [d if d < 2**63 else None for d in deviation]
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(np.repeat(np.arange(rows), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), count))),
                        pa.array(scores.ravel()),
                        pa.array(np.tile(shares, rows)),
                        pa.array(np.full(rows * count, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Leading principal components of the table's vectors, whitened: a row per vector and component.

    Vectors become integers x = floor(1024 c) + 100000, so n, their sums and ``deviation``, the sum over dimensions of
    (n x - sum)^2, are exact. Components are eigenvectors of the covariance (divisor n), numbered from 1 by falling
    eigenvalue e, found by Chebyshev-filtered subspace iteration: every product of the covariance with a narrow block is one
    distributed pass over centred vectors; only such blocks (dimension times two dozen) reach the driver. Returns
    (id, component, n, deviation, whitened, explained = e / trace, identity_error), the last one measured on the result: the
    largest entry of the whitened covariance less the identity.

    Rows whose vector is null, empty, or holds a null, a NaN, an infinity or an entry of 2^42 or more are left out; so are
    rows whose vector has another length than most have (ties: the longer). Fewer dimensions, or fewer eigenvalues above
    1e-12 of the largest, give fewer components; equal vectors only give none, so no rows. A deviation beyond a long is null.
    Null and repeated ids stay as they are, a row each. An empty table gives an empty result. Other columns are not looked at.
    """
    id_type = table.schema[id_col].dataType
    schema = f"id {id_type.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors = pack_vectors(table, id_col, vector_col)
    values, basis = (np.empty(0), np.empty((0, 0))) if vectors is None else leading_components(vectors.times, vectors.dim, min(components, vectors.dim))
    if vectors is not None and len(values):
        held = values > 1e-12 * values[0]
        values, basis = values[held], basis[:, held]
    if vectors is None or not len(values):
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    basis = basis / np.sqrt(values)
    covariance = vectors.total(lambda x: (x @ basis).T @ (x @ basis), (len(values), len(values))) / vectors.n
    names = {"explained": values / vectors.trace(), "identity_error": float(np.abs(covariance - np.eye(len(values))).max())}
    return vectors.packed.mapInArrow(_whitened(vectors, basis, names, to_arrow_type(id_type)), schema).withColumnRenamed("id", id_col)
