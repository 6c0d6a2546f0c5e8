import hashlib
import random
import re
import zlib

import pytest

from marquee.llm import prefix_trie as trie
from marquee.llm.common import importable
from marquee.llm.prefix_trie import block_ends, prefix_trie

CONVS = "conv_id bigint, turn bigint, role string, text string, key string, depth string, n string"


def conversations(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], CONVS)


def brute(rows):
    """Nodes by looking at every prefix of every rebuilt conversation."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members, ended = {}, {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ended.setdefault(seq, []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = hashlib.sha256(",".join(map(str, sorted(ended.get(p, [])))).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], ends))
    return out


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sample(seed, convs=70, copies=25):
    rng = random.Random(seed)
    texts = ["a b", "A b", "", None, " x\ty ", "one two three", "wörter\x0bund 日本"]
    rows = []
    for c in rng.sample(range(-30, 300), convs):
        rows += [(c, k, rng.choice(["user", "assistant", None]), rng.choice(texts)) for k in range(rng.randint(1, 6))]
    for c in range(1000, 1000 + copies):
        rows += [(c, k, "user", "the same") for k in range(4)]
    return rows


@pytest.mark.parametrize("entries, levels", [(16_384, 16), (1, 2), (40, 3)])
def test_like_every_prefix(spark, monkeypatch, entries, levels):
    """The same nodes, whether levels are peeled in tasks, one by one, or in blocks of both kinds."""
    monkeypatch.setattr(block_ends, "__defaults__", (entries, levels))
    rows = sample(entries)
    assert result(prefix_trie(conversations(spark, rows))) == sorted(brute(rows), key=repr)


def test_long_conversation_and_hot_parent(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHILDREN_A_TASK", 5)
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(block_ends, "__defaults__", (60, 4))
    rows = [(7, k, "user", f"turn {k}") for k in range(300)]
    rows += [(c, 0, "user", f"first {c}") for c in range(20, 60)] + [(c, 0, "user", "equal") for c in range(100, 140)]
    assert result(prefix_trie(conversations(spark, rows))) == sorted(brute(rows), key=repr)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (5, None, None, None),
        (5, 0, "user", None),
        (5, 0, "user", None),
        (20, 1, "b", "z"),
        (20, 1, "a", "z"),
        (20, None, "c", "first " * 50_000),
        (21, 0, "c", "own"),
        (41, 0, "c", "loses its only turn"),
        (43, 0, "c", "too"),
    ]
    assert result(prefix_trie(conversations(spark, rows))) == sorted(brute(rows), key=repr)
    assert prefix_trie(conversations(spark, [])).count() == 0
    assert prefix_trie(conversations(spark, rows[:1])).count() == 0


def test_blocks_cover_all_levels():
    assert block_ends({}) == []
    assert block_ends({3: 10}) == [(3, True)]
    ends = block_ends({8: 25_000, 399: 1})
    assert [e for e, _ in ends] == [16, 399] and not ends[0][1] and ends[1][1]
    assert [e for e, _ in block_ends({10**6: 1})][:2] == [16_384, 32_768]
