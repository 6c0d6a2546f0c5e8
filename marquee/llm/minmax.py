"""Near-duplicate classes by min-max hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, mixed, slices, windows, words
from marquee.llm.graph import components
from marquee.session import cut_lineage, fits_broadcast

ROWS_A_BAND = 4
MISSED = 1e-7
MEMBERS_A_TASK = 1024
PROBES_A_TASK = 256
EDGES_A_CENTRE = 1024


def bands_for(percent: int, rows: int = ROWS_A_BAND, missed: float = MISSED) -> int:
    """Bands of ``rows`` values, an even number, that miss a pair at the threshold with a chance of ``missed`` at most."""
    bands = math.ceil(math.log(missed) / math.log(1 - (percent / 100) ** rows))
    return bands + bands % 2


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of the whole sequence when there are fewer words."""
    return np.unique(windows(hashes.of(words(text)), width))


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def min_max(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Signatures, a row a set: the minimum under each permutation, then the maximum under each.

    A permutation is one multiplication of the tokens' low 32 bits, which are random already; it is worked out once
    and gives two values.
    """
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    tokens = np.concatenate(sets).astype(np.uint32)
    keys = mixed(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    out = np.empty((2 * permutations, len(sets)), np.uint32)
    for k in range(permutations):
        moved = (tokens ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint32(1))
        moved ^= moved >> np.uint32(15)
        moved *= np.uint32(0x2C1B3C6D)
        out[k] = np.minimum.reduceat(moved, starts)
        out[permutations + k] = np.maximum.reduceat(moved, starts)
    return out.T


def band_keys(signatures: np.ndarray, rows: int = ROWS_A_BAND) -> np.ndarray:
    """A 64-bit key for each band of each set. A band holds minima only or maxima only, so its values are independent."""
    n, size = signatures.shape
    values = signatures.reshape(n, size // rows, rows).astype(np.uint64)
    key = mixed(np.arange(1, size // rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[None, :].repeat(n, 0)
    for r in range(rows):
        key = mixed((key ^ values[:, :, r]) * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _signatures(width: int, bands: int):
    permutations = bands * ROWS_A_BAND // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width, hashes) for t in batch.column("text").to_pylist()]
            n = [len(s) for s in sets]
            held = np.flatnonzero(n)
            keys: list[np.ndarray | None] = [None] * len(sets)
            if len(held):
                for place, row in zip(held, band_keys(min_max([sets[k] for k in held], permutations)), strict=True):
                    keys[place] = row
            columns = [batch.column("id"), batch.column("own"), pa.array([set_key(s) for s in sets], pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "own", "sid", "n", "bands"])

    return run


def _full_sets(width: int):
    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width, hashes) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sid", "tokens"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sorted sets share enough: ``100 * common >= percent * union``."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


def _confirm(percent: int):
    """Rows sorted so that a centre comes before the members dealt to it: the members linked with it."""

    def run(batches):
        centre, tokens = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for c, sid, own in zip(batch.column("c").to_pylist(), batch.column("sid").to_pylist(), batch.column("tokens"), strict=True):
                mine = np.frombuffer(own.as_buffer(), np.uint64)
                if sid == c:
                    centre, tokens = c, mine.copy()
                elif centre == c and linked(tokens, mine, percent):
                    a.append(c)
                    b.append(sid)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _confirm_block(percent: int):
    """Links between probes and members of different classes; as few as connect those classes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame[~frame["probe"]].reset_index(drop=True)
        probes = frame[frame["probe"]]
        sets = [np.frombuffer(t, np.uint64) for t in members["tokens"]]
        n = np.array([len(s) for s in sets])
        label, sid = members["label"].to_numpy(), members["sid"].to_numpy()
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        tokens, holders = tokens[order], np.repeat(np.arange(len(sets)), n)[order]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        links = []
        for mine, own, x in zip(probes["label"], probes["tokens"], probes["sid"], strict=True):
            own = np.frombuffer(own, np.uint64)
            lo, hi = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            runs = [holders[i:j] for i, j in zip(lo, hi, strict=True) if i < j]
            if not runs:
                continue
            common = np.bincount(np.concatenate(runs), minlength=len(sets))
            for y in np.flatnonzero((100 * common >= percent * (n + len(own) - common)) & (label != mine)):
                p, q = top(int(mine)), top(int(label[y]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    links.append((int(x), int(sid[y])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 85) -> DataFrame:
    """Classes of documents connected by links ``100 * |A and B| >= percent * |A or B|`` of their shingle sets.

    Returns a row per input row: (id, n_shingles, component_id, kept); ``component_id`` is the least id that links
    reach, ``kept`` tells the rows that carry it. Method:

    1. Every text gives its set of 64-bit shingle hashes and a min-max signature: of each permutation both the least
       and the greatest value. Rows with one set are one node from here on.
    2. Signatures are cut into bands of four values; ``bands_for`` gives so many that a pair at the threshold shares
       none with a chance of 1e-7 at most. Sets with a band in common lie in a bucket.
    3. In each bucket every set is compared, on full sets, with the bucket's least one. A bucket whose other sets are
       in one class then is done. In those left, sets outside the bucket's most frequent class are compared
       with all others of another class, in blocks of bounded size. So no pair of a bucket is left unseen unless
       its two sets are in one class already, and no pair is ever a row unless it is compared or linked.

    Null or wordless texts have an empty set and are their own component. Null ids take part in links, are never a
    component's id, and have a null component when no id is linked with them; such rows are kept. Rows with one id are all
    kept or none. An empty table gives an empty result. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("own", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    sets = cut_lineage(rows.mapInArrow(_signatures(width, bands_for(percent)), f"id {id_type}, own bigint, sid bigint, n bigint, bands array<bigint>"))
    nodes = sets.filter("n > 0").groupBy("sid").agg(F.min("id").alias("id"), F.min(F.struct("own", "id")).alias("seen"), F.first("bands").alias("bands"))
    nodes = cut_lineage(nodes)

    # buckets with more than one set, and each one's least set
    dealt = nodes.select("sid", F.explode("bands").alias("key"))
    stars = dealt.groupBy("key").agg(F.min("sid").alias("c"), F.max("sid").alias("last"), F.count(F.lit(1)).alias("size")).filter("c < last").drop("last")
    side = F.broadcast(stars) if fits_broadcast(stars) else stars
    buckets = cut_lineage(dealt.join(side, "key").filter("sid <> c"))

    open_ids = buckets.select("sid").union(buckets.select(F.col("c").alias("sid"))).distinct()
    wanted = nodes.join(open_ids, "sid", "left_semi").select("seen.own", F.col("seen.id").alias("id"))
    wanted = cut_lineage(wanted.select(F.col("own").alias("of"), F.col("id").alias("as")).distinct())
    side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    texts = rows.join(side, (rows["own"] == side["of"]) & rows["id"].eqNullSafe(side["as"]), "left_semi").select("text")
    found = cut_lineage(texts.mapInArrow(_full_sets(width), "sid bigint, tokens binary").groupBy("sid").agg(F.first("tokens").alias("tokens")))

    # a centre with many members is dealt to 2^k tasks; part numbers of different k differ
    spread = F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.col("size") / EDGES_A_CENTRE)))).cast("bigint")
    edges = buckets.groupBy("c", "sid").agg(F.max(spread).alias("spread"))
    edges = edges.select("c", "sid", (F.col("spread") + F.pmod(F.xxhash64("sid"), F.col("spread"))).alias("part"))
    centres = edges.select("c", F.col("c").alias("sid"), "part").distinct()
    compared = edges.union(centres).join(found, "sid").select("c", "part", "sid", "tokens")
    compared = compared.repartition("c", "part").sortWithinPartitions("c", "part", F.col("sid") != F.col("c"))
    links = cut_lineage(compared.select("c", "sid", "tokens").mapInArrow(_confirm(percent), "a bigint, b bigint"))
    joined = components(links.select(F.lit(0).alias("grp"), "a", "b")).select(F.col("node").alias("sid"), "label")

    # buckets whose sets, the centre left out, are in more than one class
    named = buckets.join(joined, "sid", "left").select("key", "sid", F.coalesce("label", "sid").alias("label"))
    shares = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("sid").cast("decimal(38,0)")).alias("trace"))
    left = shares.groupBy("key").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("most"), F.sum("trace").alias("trace"))
    left = left.filter("classes > 1").groupBy("size", "trace", "most").agg(F.min("key").alias("key"))  # buckets with the same sets once
    left = cut_lineage(left.select("key", F.col("most.label").alias("main"), F.col("size"), (F.col("size") - F.col("most.n")).alias("others")))
    if not left.isEmpty():
        side = F.broadcast(left) if fits_broadcast(left) else left
        blocks = named.join(side, "key").withColumns({"js": F.ceil(F.col("size") / MEMBERS_A_TASK), "ps": F.ceil(F.col("others") / PROBES_A_TASK)})
        member = blocks.select("key", "sid", "label", F.lit(False).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("ps") - 1)).alias("i"), F.pmod(F.xxhash64("sid"), F.col("js")).alias("j"))
        probe = blocks.filter("label <> main").select("key", "sid", "label", F.lit(True).alias("probe"), F.pmod(F.xxhash64("sid"), F.col("ps")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("js") - 1)).alias("j"))
        blocks = member.union(probe).join(found, "sid")
        more = blocks.groupBy("key", "i", "j").applyInPandas(_confirm_block(percent), "a bigint, b bigint")
        links = cut_lineage(links.union(more))
        joined = components(links.select(F.lit(0).alias("grp"), "a", "b")).select(F.col("node").alias("sid"), "label")

    classes = nodes.join(joined, "sid", "left").select("sid", "id", F.coalesce("label", "sid").alias("label"))
    least = classes.groupBy("label").agg(F.min("id").alias("component_id"))
    classes = cut_lineage(classes.join(least, "label").select("sid", "component_id"))
    out = sets.join(classes, "sid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
