"""N-gram Jaccard join by prefix filters under several global orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, scale_parts, slices, text_bytes, windows, words
from marquee.llm.graph import components
from marquee.session import cut_lineage, fits_broadcast

POSTINGS_A_PART = 1_500_000
BYTES_A_POSTING = 6
BLOCK_DOCS = 1024


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of the whole sequence when there are fewer words."""
    return np.unique(windows(hashes.of(words(text)), width))


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Two sets with ``100 * common >= percent * union`` share a token among their first so many, in any order."""
    return n - (n * percent + 99) // 100 + 1


def _packed(sids: np.ndarray, owner: np.ndarray, tokens: np.ndarray, parts: int) -> Iterator[dict]:
    """Postings dealt to ``parts`` by token: a row per part with its sets, tokens a set, and tokens."""
    part = ((tokens >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    owner, tokens = owner[order], tokens[order]
    for p in range(parts):
        mine = owner[ends[p] : ends[p + 1]]
        if len(mine):
            starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            yield {"part": p, "sids": sids[mine[starts]].tobytes(), "counts": np.diff(np.r_[starts, len(mine)]).astype(np.int32).tobytes(), "tokens": tokens[ends[p] : ends[p + 1]]}


def _set_rows(id_col: str, text_col: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, text_col):
            sets = [shingles(t, width, hashes) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())], ["id", "sid", "n"]
            )

    return run


def _postings(text_col: str, width: int, parts: int):
    """Tokens of the distinct sets of each slice, dealt by token; only 32 bits of a token are sent with its part."""
    schema = pa.schema([("part", pa.int32()), ("sids", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, text_col):
            sets = {}
            for t in batch.column(text_col).to_pylist():
                s = shingles(t, width, hashes)
                if len(s):
                    sets[set_id(s)] = s
            if sets:
                found = list(sets.values())
                owner = np.repeat(np.arange(len(found)), [len(s) for s in found])
                rows = _packed(np.array(list(sets), np.int64), owner, np.concatenate(found), parts)
                yield pa.RecordBatch.from_pylist([r | {"tokens": r["tokens"].astype(np.uint32).tobytes()} for r in rows], schema)

    return run


def _unpacked(frame: pd.DataFrame, kind) -> tuple[np.ndarray, np.ndarray]:
    sids = np.concatenate([np.repeat(np.frombuffer(s, np.int64), np.frombuffer(c, np.int32)) for s, c in zip(frame["sids"], frame["counts"], strict=True)])
    return sids, np.concatenate([np.frombuffer(t, kind) for t in frame["tokens"]])


def _shared_counts(ranges: int):
    """Of one part of the tokens: how many of each set's tokens another set holds too, dealt by set."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sids, tokens = _unpacked(frame, np.uint32)
        order = np.lexsort((sids, tokens))
        sids, tokens = sids[order], tokens[order]
        same_token = tokens[1:] == tokens[:-1]
        first = np.r_[True, ~same_token | (sids[1:] != sids[:-1])]  # a set found in several slices counts once
        sids, tokens = sids[first], tokens[first]
        near = tokens[1:] == tokens[:-1]
        shared = np.r_[near, False] | np.r_[False, near]
        held, counts = np.unique(sids[shared], return_counts=True)
        place = held.view(np.uint64) % np.uint64(ranges)
        rows = []
        for p in np.unique(place):
            mine = place == p
            rows.append((int(p), held[mine].tobytes(), counts[mine].astype(np.int32).tobytes()))
        return pd.DataFrame(rows, columns=["place", "sids", "counts"])

    return run


def _sum_counts(frame: pd.DataFrame) -> pd.DataFrame:
    sids = np.concatenate([np.frombuffer(s, np.int64) for s in frame["sids"]])
    counts = np.concatenate([np.frombuffer(c, np.int32) for c in frame["counts"]])
    held, place = np.unique(sids, return_inverse=True)
    return pd.DataFrame({"sid": held, "shared": np.bincount(place, weights=counts).astype(np.int64)})


def _open_sets(width: int):
    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            out = {"sid": [], "docs": [], "tokens": []}
            for sid, docs, t in zip(*(batch.column(c).to_pylist() for c in ("sid", "docs", "text")), strict=True):
                s = shingles(t, width, hashes)
                if len(s) and set_id(s) == sid:
                    out["sid"].append(sid)
                    out["docs"].append(docs)
                    out["tokens"].append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["sid"], pa.int64()), pa.array(out["docs"], pa.int64()), pa.array(out["tokens"], pa.binary())], ["sid", "docs", "tokens"])

    return run


def _deal_sets(parts: int):
    schema = pa.schema([("part", pa.int32()), ("sids", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
            if found:
                owner = np.repeat(np.arange(len(found)), [len(s) for s in found])
                rows = _packed(batch.column("sid").to_numpy(zero_copy_only=False), owner, np.concatenate(found), parts)
                yield pa.RecordBatch.from_pylist([r | {"tokens": r["tokens"].tobytes()} for r in rows], schema)

    return run


def _frequencies(ranges: int):
    """Each posting with the number of sets that hold its token, dealt by set."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sids, tokens = _unpacked(frame, np.uint64)
        _, place, df = np.unique(tokens, return_inverse=True, return_counts=True)
        df = df[place].astype(np.int32)
        at = sids.view(np.uint64) % np.uint64(ranges)
        rows = [(int(p), sids[m].tobytes(), tokens[m].tobytes(), df[m].tobytes()) for p in np.unique(at) for m in [at == p]]
        return pd.DataFrame(rows, columns=["place", "sids", "tokens", "dfs"])

    return run


def _prefixes(percent: int, orders: int):
    """Prefix tokens of each set under each order: rare tokens first, ties by a hash of the order's own."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sids, tokens, df = (np.concatenate([np.frombuffer(b, kind) for b in frame[c]]) for c, kind in (("sids", np.int64), ("tokens", np.uint64), ("dfs", np.int32)))
        out = []
        for k in range(orders):
            tie = (tokens ^ np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x51ED2701)
            order = np.lexsort((tie ^ (tie >> np.uint64(29)), df, sids))
            s, t, d = sids[order], tokens[order], df[order]
            starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            n = np.diff(np.r_[starts, len(s)])
            rank = np.arange(len(s)) - np.repeat(starts, n)
            keep = (rank < np.repeat(prefix_length(n, percent), n)) & (d > 1)
            out.append(pd.DataFrame({"grp": k, "token": t[keep].view(np.int64), "sid": s[keep]}))
        return pd.concat(out).astype({"grp": "int32"})

    return run


def _verify(percent: int):
    """Exact links among the sets of a block, or between two sub-blocks of it: links a set has, and a link forest."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        frame = frame.sort_values("sid", ignore_index=True)
        sets = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
        n = np.array([len(s) for s in sets])
        side, docs = frame["sub"].to_numpy(), frame["docs"].to_numpy()
        owner = np.repeat(np.arange(len(sets)), n)
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(token, kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(token))]
        holders = owner[order]
        root = np.arange(len(sets))
        links = np.zeros(len(sets), np.int64)

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        at = np.r_[0, np.cumsum(n)]
        for x in range(len(sets)):
            mine = token[at[x] : at[x + 1]]
            common = np.bincount(np.concatenate([holders[ends[t] : ends[t + 1]] for t in mine]), minlength=len(sets))
            linked = 100 * common >= percent * (n[x] + n - common)
            linked[: x + 1] = False  # each pair once
            if i != j:
                linked &= side != side[x]
            for y in np.flatnonzero(linked):
                links[x] += docs[y]
                links[y] += docs[x]
                a, b = top(x), top(y)
                root[max(a, b)] = min(a, b)
        sid = frame["sid"].to_numpy()
        found = links > 0
        return pd.DataFrame({"sid": sid[found], "links": links[found], "root": sid[[top(x) for x in np.flatnonzero(found)]]})

    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, orders: int = 3) -> DataFrame:
    """Classes of documents connected by links ``100 * |A and B| >= percent * |A or B|`` of their n-gram sets.

    Returns a row per input row: (id, n_shingles, component_id, n_links). ``n_links`` counts the other rows
    linked with it, copies included. Method, exact but for 64-bit hash collisions:

    1. Every text gives its set of n-gram hashes; rows with one set are one node from here on.
    2. Postings are dealt by token. A set whose rare-first prefix holds only tokens of its own can link with
       nothing and is closed; the others are open.
    3. Open sets are ordered rare tokens first under ``orders`` orders with different ties. Sets that share a
       prefix token under an order are connected for it; sets connected under every order make a block, so the
       filters are intersected before any pair is looked at. The edges are stars, as many as postings.
    4. A block is verified by counting common tokens; a block of over 1,024 sets in sub-block pairs, each a task.

    Null or wordless texts have an empty set, no links, and are their own component. Null ids take part in
    links, are never a component's id, and stand alone as component null. Repeated rows link like copies.
    An empty table gives an empty result. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    parts = scale_parts(rows, text_bytes(rows, "text") // BYTES_A_POSTING, POSTINGS_A_PART)
    sets = cut_lineage(rows.mapInArrow(_set_rows("id", "text", width), f"id {id_type}, sid bigint, n bigint"))
    nodes = sets.filter("n > 0").groupBy("sid").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("docs"), F.min("n").alias("n"))

    packed = "part int, sids binary, counts binary, tokens binary"
    postings = rows.select("text").mapInArrow(_postings("text", width, parts), packed)
    shared = postings.groupBy("part").applyInPandas(_shared_counts(parts), "place int, sids binary, counts binary")
    shared = shared.groupBy("place").applyInPandas(_sum_counts, "sid bigint, shared bigint")
    # open: fewer tokens of its own than the prefix is long
    open_nodes = cut_lineage(nodes.join(shared, "sid").filter(f"n - shared < n - floor((n * {percent} + 99) / 100) + 1").select("sid", "id", "docs"))

    side = F.broadcast(open_nodes) if fits_broadcast(open_nodes) else open_nodes
    texts = rows.join(side, rows["id"].eqNullSafe(side["id"])).select("sid", "docs", "text")
    found = texts.mapInArrow(_open_sets(width), "sid bigint, docs bigint, tokens binary")
    found = cut_lineage(found.groupBy("sid").agg(F.first("docs").alias("docs"), F.first("tokens").alias("tokens")))

    amount = found.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0] // 8
    parts = scale_parts(found, amount, POSTINGS_A_PART)
    dealt = found.mapInArrow(_deal_sets(parts), packed).groupBy("part").applyInPandas(_frequencies(parts), "place int, sids binary, tokens binary, dfs binary")
    prefixes = cut_lineage(dealt.groupBy("place").applyInPandas(_prefixes(percent, orders), "grp int, token bigint, sid bigint"))
    stars = prefixes.groupBy("grp", "token").agg(F.min("sid").alias("b"))
    edges = prefixes.join(stars, ["grp", "token"]).select("grp", F.col("sid").alias("a"), "b")
    under = components(edges)
    blocks = under.groupBy(F.col("node").alias("sid")).agg(F.count(F.lit(1)).alias("k"), F.xxhash64(F.array_sort(F.collect_list(F.struct("grp", "label")))).alias("block"))
    blocks = cut_lineage(blocks.filter(F.col("k") == orders).select("sid", "block"))
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    subs = F.ceil(F.col("size") / BLOCK_DOCS).cast("int")
    dealt = blocks.join(sizes, "block").select("sid", "block", subs.alias("subs"), F.pmod(F.xxhash64("sid"), subs).cast("int").alias("sub"))
    dealt = dealt.join(found, "sid")
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("other"))
    dealt = dealt.select("sid", "docs", "tokens", "block", "sub", F.least("sub", "other").alias("i"), F.greatest("sub", "other").alias("j"))
    links = cut_lineage(dealt.groupBy("block", "i", "j").applyInPandas(_verify(percent), "sid bigint, links bigint, root bigint"))

    joined = components(links.select(F.lit(0).alias("grp"), F.col("sid").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("sid").agg(F.sum("links").alias("links"))
    named = joined.select(F.col("node").alias("sid"), "label").join(counts, "sid", "left")
    classes = nodes.join(named, "sid", "left").select("sid", "docs", "id", F.coalesce("label", "sid").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    least = classes.groupBy("label").agg(F.min("id").alias("component_id"))
    classes = cut_lineage(classes.join(least, "label").select("sid", "component_id", (F.col("links") + F.col("docs") - 1).alias("n_links")))
    known = F.col("component_id").isNotNull() | (F.col("n") > 0)
    out = sets.join(classes, "sid", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(known, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def first_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the least id stays.

    A row is told by its id and a hash of its text, so rows that share an id and differ in text are judged apart,
    and of rows that share both, one stays. Null ids come before others.
    """
    tagged = docs.withColumn("__key", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("own")))
    classes = jaccard_classes(tagged.select("__key", F.col(text_col).alias("text")), "__key", "text", width, percent)
    keys = cut_lineage(classes.groupBy("__key").agg(F.min("component_id").alias("first"), F.count(F.lit(1)).alias("n")))
    gone = keys.filter("first <> __key").select(F.col("__key.id").alias("__gone_id"), F.col("__key.own").alias("__gone_own"))
    again = keys.filter("first = __key AND n > 1").select(F.col("__key.id").alias("__gone_id"), F.col("__key.own").alias("__gone_own"))

    def among(rows: DataFrame, few: DataFrame, how: str) -> DataFrame:
        side = F.broadcast(few) if fits_broadcast(few) else few
        return rows.join(side, rows["__key"]["id"].eqNullSafe(side["__gone_id"]) & rows["__key"]["own"].eqNullSafe(side["__gone_own"]), how)

    kept = among(tagged, gone, "left_anti")
    if not again.isEmpty():
        kept = among(kept, again, "left_anti").unionByName(among(kept, again, "left_semi").dropDuplicates(["__key"]))
    return kept.select(*docs.columns)
