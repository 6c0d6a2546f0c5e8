import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import lm
from marquee.llm.common import importable, words
from tests.llm.helpers import documents, odd_documents


def train():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0


def base(rows):
    """The add-0.1 unigram, plainly."""
    train = [zlib.crc32(str(i).encode()) % 10 != 0 if i is not None else False for i, *_ in rows]
    counts = Counter(w for (_, text, *_), t in zip(rows, train, strict=True) if t for w in [*words(text), b""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for (ident, text, *_), t in zip(rows, train, strict=True):
        found = [*words(text), b""]
        out.append((ident, not t, len(found), sum(counts[w] > 0 for w in found), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found), 6)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect()), key=repr)


def test_table(spark, data):
    importable(spark)
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = lm.score_documents(docs, train()).cache()
    assert result(found) == base([(r["doc_id"], r["text"]) for r in docs.collect()])
    held = found.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]  # better than the unigram on rows it has not learned from
    assert found.filter("score >= 0 OR bits_per_byte <= 0 OR bits_per_byte > 8").count() == 0


def test_odd_rows(spark):
    df, rows = odd_documents(spark)
    found = lm.score_documents(df, train())
    assert result(found) == base(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found.collect())
    assert lm.score_documents(documents(spark, []), train()).count() == 0
    assert lm.score_documents(df, F.lit(False)).filter("n_known = 0 AND train_tokens = 0").count() == len(rows)


def test_chunks_do_not_change_the_base(spark, monkeypatch):
    rows = [(k, f"alpha beta w{k % 13} gamma w{k % 7}") for k in range(120)]
    df = documents(spark, rows).repartition(3)
    assert result(lm.score_documents(df, train())) == base(rows)


def test_code_is_complete():
    code = lm.Code.build(np.arange(256) ** 2)
    assert math.isclose(sum(2.0 ** -code.length), 1)
    paths = {tuple(zip(code.node[s, : code.length[s]], code.bit[s, : code.length[s]], strict=True)) for s in range(256)}
    assert len(paths) == 256


@pytest.fixture
def mixer():
    rng = np.random.default_rng(0)
    tables = lm.Tables()
    for t in (*tables.zeros, *tables.ones):
        t[:] = rng.integers(0, 5, len(t))
    code = lm.Code.build(rng.integers(0, 1000, 256))
    return lm.Mixer(code, tables, rng.normal(0.2, 0.1, (lm.GATES, 5)), rng.normal(0, 1, lm.GATES * lm.BUCKETS))


def test_spellings_are_a_distribution(mixer):
    """After "a", the shares of all next symbols, the stop among them, sum to one: prices are those of a proper code."""
    total = 0.0
    for s in range(256):
        owner, bit, slots = lm._decisions([b"a"] if s == lm.STOP else [bytes([ord("a"), s])], mixer.code)
        x, gate = mixer.inputs(slots, bit, False)
        m = mixer.mixed(x, gate)
        m = (m + mixer.refined[mixer.bucket(m, gate)]) / 2
        total += np.exp(-np.log1p(np.exp(np.where(bit == 1, -m, m)))[: mixer.code.length[s]].sum())
    assert math.isclose(total, 1, rel_tol=1e-9)


def test_first_symbols_are_a_distribution():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 3, lm.FIRST_GATES * 256) * (rng.random(lm.FIRST_GATES * 256) < 0.05)
    table = lm._first_table(cells, lm.Code.build(cells.reshape(-1, 256).sum(axis=0)))
    assert np.allclose((10**table).sum(axis=1), 1)


def test_online_mixture_looks_back_only():
    rng = np.random.default_rng(2)
    probs, lengths = rng.random((3, 50)), np.array([20, 30])
    prior = np.array([0.2, 0.3, 0.5])
    whole = lm._mixed_online(probs, prior, lengths)
    for start, size in ((0, 20), (20, 30)):  # a mixture of products, text by text
        part = probs[:, start : start + size]
        assert math.isclose(whole[start : start + size].sum(), math.log((prior * part.prod(axis=1)).sum()), rel_tol=1e-9)


def test_packed_classes_never_give_more():
    counts = np.array([[0, 1, 5, 1000] * 4, [7, 0, 0, 3] * 4])
    totals = np.array([10, 2, 7, 2000] * 4)
    back = lm.CLASS_VALUES[lm._class_codes(counts, totals)]
    real = counts / totals
    assert ((back <= real * (1 + 1e-12)) & (back >= real * 0.9)).all() and ((back == 0) == (counts == 0)).all()


def test_every_training_word_is_fitted_on(spark):
    """Refinement sums and weights take in all training words, the hot one too, whatever the size of the vocabulary."""
    importable(spark)
    found = [b"hot", *(b"word%d" % k for k in range(400)), b"unseen"]
    counts = np.zeros((len(found), lm.CLASSES), np.int64)
    counts[:-1, 0] = [10_000, *range(1, 401)]
    rows = [(b, lm._joined(found[b::4]), lm._packed(counts[b::4])) for b in range(4)]
    vocabulary = spark.createDataFrame(rows, "bucket int, words binary, counts binary")
    code, tables = lm.Code.build(np.ones(256)), lm.Tables()
    owner, bit, slots = lm._decisions(found, code)
    weight = counts.sum(axis=1)[owner].astype(float)
    for k, slot in enumerate(slots):
        np.add.at(tables.zeros[k], slot, weight * (bit == 0))
        np.add.at(tables.ones[k], slot, weight * (bit == 1))
    start = lm.Mixer(code, None, np.tile([0.1, 0.2, 0.3, 0.4, 0.0], (lm.GATES, 1)))
    mixer = lm._fitted(start, spark.sparkContext.broadcast(tables), vocabulary, 10**9)
    assert not np.allclose(mixer.weights, start.weights)
    whole = lm.Mixer(code, tables, mixer.weights)
    x, gate = whole.inputs(slots, bit, True)
    at = whole.bucket(whole.mixed(x, gate), gate)
    zeros, ones = (np.bincount(at, weights=weight * (bit == v), minlength=lm.GATES * lm.BUCKETS) for v in (0, 1))
    near = lm._squash((np.arange(lm.GATES * lm.BUCKETS) % lm.BUCKETS - lm.BUCKETS // 2) * 12 / (lm.BUCKETS // 2))
    assert np.allclose(mixer.refined, np.clip(np.log((ones + 2 * near) / (zeros + 2 * (1 - near))), -12, 12))
