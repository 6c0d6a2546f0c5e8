"""The trie of conversation prefixes by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import importable, scratch
from marquee.session import cut_lineage, fits_broadcast

KEY = 16
ROOT = bytes(KEY)
ENTRIES_A_TASK = 16_384
LEVELS_A_BLOCK = 16
CHILDREN_A_TASK = 10_000
CHUNK_IDS = 50_000

PATHS = "conv bigint, top binary, keys binary, words array<bigint>, depth int, ended boolean"
NODES = "key binary, depth int, parent binary, conv bigint, n bigint, children bigint, leaves bigint, saved bigint"
SUMS = ["n", "children", "leaves", "saved"]


def shared_head(conv: Column) -> Column:
    """How many turns a conversation takes over from the first one of its block: crc32 of its number, modulo 4."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def rebuilt_turns(conversations: DataFrame, block: int = 20) -> DataFrame:
    """(conv, place, digest, words): the turns of every rebuilt conversation, numbered from 1.

    A conversation c takes its first h turns (``shared_head``) from conversation c - c % block and the rest from
    itself. A conversation left with no turn has one row with place 0. Turns are told by 16 bytes of SHA-256 over role
    and text; texts go no further than this step.
    """
    conv = F.col("conv_id").cast("bigint")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(conv.alias("conv"), "turn", role.alias("role"), text.alias("text")).filter("conv IS NOT NULL")
    own = turns.withColumn("rn", F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * KEY))
    own = own.select("conv", "rn", digest.alias("digest"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"), shared_head(F.col("conv")).alias("h"))
    own = cut_lineage(own)
    heads = own.filter((F.col("conv") % block == 0) & (F.col("rn") <= 3)).select(F.col("conv").alias("first"), "rn", "digest", "words")
    heads = heads.groupBy("first").agg(F.array_sort(F.collect_list(F.struct("rn", "digest", "words"))).alias("head"))  # three turns at most
    convs = own.filter("rn = 1").select("conv", "h").withColumn("first", F.col("conv") - F.col("conv") % block)
    side = F.broadcast(heads) if fits_broadcast(heads) else heads
    convs = convs.join(side, "first", "left").select("conv", "h", F.slice(F.coalesce("head", F.expr("array()").cast(heads.schema["head"].dataType)), F.lit(1), "h").alias("head"))
    convs = cut_lineage(convs.withColumn("size", F.size("head")))
    taken = convs.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.rn").alias("place"), "t.digest", "t.words")
    sizes = convs.filter("h > 0").select("conv", "size")
    kept = own.filter("rn > h").join(sizes, "conv", "left").select("conv", (F.col("rn") - F.col("h") + F.coalesce("size", F.lit(0))).alias("place"), "digest", "words")
    empty = convs.filter("size = 0").join(own.filter("rn = h + 1").select("conv"), "conv", "left_anti")
    return taken.union(kept).union(empty.select("conv", F.lit(0), F.lit(None).cast("binary"), F.lit(0).cast("bigint")))


def block_ends(lengths: dict[int, int], entries: int = ENTRIES_A_TASK, levels: int = LEVELS_A_BLOCK) -> list[tuple[int, bool]]:
    """Depths at which blocks of levels end, and whether a block is small enough to be peeled inside tasks.

    ``lengths``: conversations by number of turns. A block takes as many levels as hold ``entries`` turns together; where
    that is less than ``levels``, it takes ``levels`` and is peeled level by level.
    """
    deepest = max(lengths, default=0)
    alive = np.zeros(deepest + 2, np.int64)  # conversations with at least so many turns
    for length, n in lengths.items():
        alive[length] += n
    alive = np.cumsum(alive[::-1])[::-1]
    total = np.concatenate([[0], np.cumsum(alive[1:])])  # turns up to a depth
    ends, low = [], 0
    while low < deepest:
        high = int(np.searchsorted(total, total[low] + entries, side="right")) - 1
        small = high >= min(low + levels, deepest)
        high = min(high if small else low + levels, deepest)
        ends.append((high, small))
        low = high
    return ends


def _paths(ends: list[int]):
    """Rows sorted by conversation and place: a row per conversation and block with the keys of its prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key, top, depth = None, ROOT, ROOT, 0
        keys: list[bytes] = []
        words: list[int] = []
        out: list[tuple] = []

        def close(ended: bool) -> None:
            out.append((conv, top, b"".join(keys), list(words), depth, ended))
            keys.clear()
            words.clear()

        def flush() -> pa.RecordBatch:
            types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.bool_()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv", "top", "keys", "words", "depth", "ended"])

        stops = set(ends)
        for batch in batches:
            for c, place, digest, n in zip(*(batch.column(k).to_pylist() for k in ("conv", "place", "digest", "words")), strict=True):
                if c != conv:
                    if conv is not None:
                        close(True)
                    conv, key, top, depth = c, ROOT, ROOT, 0
                if place > 0:
                    if keys and depth in stops:
                        close(False)
                        top = key
                    key = hashlib.sha256(key + digest).digest()[:KEY]
                    keys.append(key)
                    words.append(n)
                    depth += 1
            if out:
                yield flush()
        if conv is not None:
            close(True)
            yield flush()

    return run


def _peel_block(low: int, high: int):
    """All levels of one subtree of a small block, deepest first: its nodes, and what they add up to at its top."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        levels: dict[int, dict[bytes, list]] = {d: {} for d in range(low, high + 1)}
        paths: dict[bytes, tuple[bytes, list, int]] = {}

        def node(depth: int, key: bytes) -> list:
            return levels[depth].setdefault(key, [0, None, 0, 0, 0])

        def least(a, b):
            return b if a is None else a if b is None else min(a, b)

        top = bytes(frame["top"].iloc[0])
        for r in frame.itertuples():
            keys = b"" if r.keys is None else bytes(r.keys)
            key = keys[-KEY:] or top
            at = node(int(r.depth), key)
            at[0] += int(r.n)
            at[1] = least(at[1], None if pd.isna(r.conv) else int(r.conv))
            for k, v in enumerate((r.children, r.leaves, r.saved)):
                at[2 + k] += int(v)
            if r.words is not None and len(r.words):
                paths[key] = (keys, r.words, int(r.depth))
        rows = []
        for depth in range(high, low, -1):
            for key, (n, conv, children, leaves, saved) in levels[depth].items():
                keys, words, last = paths[key]
                place = len(words) - (last - depth) - 1
                parent = keys[KEY * (place - 1) : KEY * place] if place else top
                leaves = leaves if children else 1
                saved += (n - 1) * int(words[place])
                rows.append((key, depth, parent, conv, n, children, leaves, saved))
                up = node(depth - 1, parent)
                if place:
                    paths[parent] = (keys, words, last)
                up[0] += n
                up[1] = least(up[1], conv)
                up[2] += 1
                up[3] += leaves
                up[4] += saved
        for key, (n, conv, children, leaves, saved) in levels[low].items():
            rows.append((key, low, None, conv, n, children, leaves, saved))
        return pd.DataFrame(rows, columns=["key", "depth", "parent", "conv", "n", "children", "leaves", "saved"]).astype({"conv": "Int64"})

    return run


def _zeros(names: list[str]) -> list[Column]:
    return [F.lit(0).cast("bigint").alias(c) for c in names]


def _peel_levels(paths: DataFrame, below: DataFrame, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Peel a large block level by level: at each depth newly ended conversations and stripped nodes meet by key."""
    ended = F.col("ended").cast("bigint")
    starts = paths.filter(F.col("ended") | (F.col("depth") == high)).select(
        F.expr(f"substring(keys, length(keys) - {KEY - 1}, {KEY})").alias("key"), "top", "keys", "words", F.when(F.col("ended"), F.col("conv")).alias("conv"), ended.alias("n"), *_zeros(SUMS[1:]), "depth"
    )
    bare = [F.lit(None).cast("binary").alias(c) for c in ("top", "keys")] + [F.lit(None).cast("array<bigint>").alias("words")]
    survivors = below.select("key", *bare, "conv", *SUMS)
    nodes = []
    for depth in range(high, low, -1):
        here = starts.filter(F.col("depth") == depth).drop("depth").unionByName(survivors)
        met = here.groupBy("key").agg(F.max_by(F.struct("top", "keys", "words"), F.when(F.col("keys").isNotNull(), 1)).alias("path"), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in SUMS))
        met = met.select("key", "path.*", "conv", "n", "children", F.when(F.col("children") > 0, F.col("leaves")).otherwise(1).alias("leaves"), (F.col("saved") + (F.col("n") - 1) * F.element_at("words", -1)).alias("saved"))
        parent = F.when(F.size("words") > 1, F.expr(f"substring(keys, length(keys) - {2 * KEY - 1}, {KEY})")).otherwise(F.col("top"))
        met = cut_lineage(met.withColumn("parent", parent))
        nodes.append(met.select("key", F.lit(depth).alias("depth"), "parent", "conv", *SUMS))
        stripped = [F.expr(f"substring(keys, 1, length(keys) - {KEY})").alias("keys"), F.slice("words", F.lit(1), F.size("words") - 1).alias("words")]
        survivors = met.select(F.col("parent").alias("key"), "top", *stripped, "conv", "n", F.lit(1).cast("bigint").alias("children"), "leaves", "saved")
    return nodes, survivors.groupBy("key").agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in SUMS))


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and number: runs of one key as comma-joined texts of bounded length, in their order."""
    held, ids = None, []

    def chunk() -> pa.RecordBatch:
        row = pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "ids"])
        ids.clear()
        return row

    for batch in batches:
        done = []
        for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (key != held or len(ids) >= CHUNK_IDS):
                done.append(chunk())
            held = key
            ids.append(conv)
        if done:
            yield pa.concat_batches(done)
    if ids:
        yield chunk()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by key and first number: the digest of each key's joined text, one chunk held at a time."""
    held, state = None, hashlib.sha256()
    for batch in batches:
        keys, digests = [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != held:
                if held is not None:
                    keys.append(held)
                    digests.append(state.hexdigest())
                held, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): SHA-256 of each key's numbers, ascending, comma-joined.

    Numbers are sorted by range over all tasks, also those of one key, and joined to texts of up to 50,000; only
    such texts of a key meet in one task, which hashes them one after the other.
    """
    chunks = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(_id_chunks, "key binary, first bigint, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = 20) -> DataFrame:
    """The trie of all prefixes of the rebuilt conversations (``rebuilt_turns``), a row per node.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest
    member; the number of turns; the parent's smallest member; members; children; childless nodes below or at the node;
    the sum over its subtree of (members - 1) times the words of a node's last turn; the digest of members that end there.

    Method: prefixes are told by chained SHA-256 keys (16 bytes). From the greatest depth up, conversations that end at a
    depth meet the nodes left from below, grouped by key; a group is a node and takes their sums; its last turn is
    stripped and it goes on to the next depth. So nodes are found and summed up in one pass over the levels, and a level
    moves nodes, not conversations. Levels are peeled in blocks, by which a row holds the keys of one block only; where a
    block holds few turns, as deep down, all of its levels are peeled inside tasks, by subtree. A very long
    conversation thus takes few jobs, and a hot prefix is reduced before every shuffle.

    Null roles and texts are empty; turns are ordered by ``turn`` (null first), then role and text; repeated rows are turns of
    their own. Rows without conv_id belong to no conversation and count nowhere. A conversation that is left without
    turns is a member of the root. An empty table has no members and gives an empty result. Other columns are not looked at.
    """
    spark = importable(conversations.sparkSession)
    turns = cut_lineage(rebuilt_turns(conversations, block))
    lengths = turns.groupBy("conv").agg(F.max("place").alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    ends = block_ends({r["length"]: r["n"] for r in lengths.collect()})
    paths = turns.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(_paths([e for e, _ in ends]), PATHS)
    low = F.lit(0)
    for before, _ in ends[:-1]:
        low = F.when(F.col("depth") > before, before).otherwise(low)
    folder = scratch(spark, "paths")
    paths.withColumn("low", low).write.partitionBy("low").parquet(folder)
    paths = spark.read.schema(PATHS + ", low int").parquet(folder)

    last = F.expr(f"CASE WHEN length(keys) > 0 THEN substring(keys, length(keys) - {KEY - 1}, {KEY}) ELSE top END")
    found: list[DataFrame] = []
    below = spark.createDataFrame([], "key binary, conv bigint, n bigint, children bigint, leaves bigint, saved bigint")
    for k in reversed(range(len(ends))):
        high, small = ends[k]
        lowest = ends[k - 1][0] if k else 0
        here = paths.filter((F.col("low") == lowest) & (F.col("depth") > lowest))
        if small:
            mine = here.filter(F.col("ended") | (F.col("depth") == high))
            tops = mine.filter(F.col("depth") == high).select(last.alias("key"), "top").distinct()
            carried = below.join(tops, "key").select("top", F.col("key").alias("keys"), F.lit(None).cast("array<bigint>").alias("words"), F.lit(high).alias("depth"), "conv", *SUMS)
            mine = mine.select("top", "keys", "words", "depth", F.when(F.col("ended"), F.col("conv")).alias("conv"), F.col("ended").cast("bigint").alias("n"), *_zeros(SUMS[1:]))
            peeled = cut_lineage(mine.unionByName(carried).groupBy("top").applyInPandas(_peel_block(lowest, high), NODES))
            found.append(peeled.filter(F.col("depth") > lowest))
            below = peeled.filter(F.col("depth") == lowest).select("key", "conv", *SUMS)
        else:
            nodes, below = _peel_levels(here, below, lowest, high)
            found += nodes
    bare = paths.filter("depth = 0").select(F.lit(ROOT).alias("key"), "conv", F.lit(1).cast("bigint").alias("n"), *_zeros(SUMS[1:]))
    root = below.unionByName(bare).groupBy("key").agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in SUMS))
    nodes = root.select("key", F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("parent"), "conv", "n", "children", F.when(F.col("children") > 0, F.col("leaves")).otherwise(1).alias("leaves"), "saved")
    for level in found:
        nodes = nodes.unionByName(level)
    nodes = cut_lineage(nodes)

    digests = ends_digests(paths.filter("ended").select(last.alias("key"), "conv"))
    nodes = nodes.join(digests, "key", "left")
    parents = nodes.filter("children > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"), F.col("children").alias("siblings"))
    hot = parents.filter(F.col("siblings") > CHILDREN_A_TASK).drop("siblings")
    if fits_broadcast(hot):  # children of a hot parent stay where they are
        named = nodes.join(F.broadcast(hot.withColumnRenamed("parent_conv", "hot_conv")), "parent", "left")
        cold = parents.filter(F.col("siblings") <= CHILDREN_A_TASK).drop("siblings")
        asked = F.when(F.col("hot_conv").isNull(), F.col("parent")).otherwise(F.col("key"))  # named ones are spread by their own key
        named = named.withColumn("ask", asked).join(cold.withColumnRenamed("parent", "ask"), "ask", "left").withColumn("parent_conv", F.coalesce("hot_conv", "parent_conv"))
    else:
        named = nodes.join(parents.drop("siblings"), "parent", "left")
    return named.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.col("parent_conv").cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
