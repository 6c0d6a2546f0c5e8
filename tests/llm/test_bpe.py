import random

import public_tokenizers
import pytest
import tiktoken

from marquee.llm.bpe import _pack, bpe_decode, bpe_encode, codec, load_ranks
from tests.llm.helpers import documents, odd_documents

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_random_texts(ranks, plain):
    own, rng = codec(_pack(ranks), PATTERN), random.Random(1)
    alphabet = "abcdefghij ABC  \n\t.,'s't'll0123é日本😀 ​_-#"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    texts += ["<|endoftext|>", "a" * 127, "a" * 128, "a" * 129, "ab" * 5000, " " * 3000, "\n" * 500 + "x", "é" * 400, "=" * 3000, "日本語" * 500]
    flat, ends = own.encode(texts)
    for k, text in enumerate(texts):
        assert flat[ends[k] : ends[k + 1]].tolist() == plain(text), text[:50]
    decoded = own.decode(flat, ends)
    assert [d.decode() for d in decoded] == texts


def test_recursion_and_heap_agree(ranks):
    own, rng = codec(_pack(ranks), PATTERN), random.Random(2)
    found = ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randint(2, 60))).encode() for _ in range(500)]
    flat, counts = own._recursive(found)
    assert flat.tolist() == [k for word in found for k in own._by_heap(word).tolist()]
    assert counts.tolist() == [len(own._by_heap(word)) for word in found]


def test_words_are_forgotten_and_learned_again(ranks, plain, monkeypatch):
    monkeypatch.setattr("marquee.llm.bpe.KEPT_WORDS", 3)
    own = codec(_pack(ranks), PATTERN)
    for text in ("one two three four", "five six", "one two seven"):
        flat, ends = own.encode([text])
        assert flat.tolist() == plain(text)


def test_rows(spark, ranks, plain):
    df, rows = odd_documents(spark)
    out = bpe_decode(bpe_encode(df, ranks, PATTERN), ranks, PATTERN).collect()
    assert sorted((repr((r["doc_id"], r["ids"], bytes(r["bytes"]).decode())) for r in out)) == sorted(repr((r[0], plain(r[1] or ""), r[1] or "")) for r in rows)
    both = bpe_encode(df, ranks, PATTERN, bytes_col="bytes").select("doc_id", "ids", "bytes").collect()
    assert sorted((repr((r["doc_id"], r["ids"], bytes(r["bytes"]).decode())) for r in both)) == sorted(repr((r[0], plain(r[1] or ""), r[1] or "")) for r in rows)


def test_empty_table_and_unknown_ids(spark, ranks):
    empty = documents(spark, [])
    assert bpe_decode(bpe_encode(empty, ranks, PATTERN), ranks, PATTERN).count() == 0
    df = spark.createDataFrame([(1, [64, 999_999, None, 65]), (2, None), (3, [])], "doc_id int, ids array<int>")
    table = {r["doc_id"]: bytes(r["bytes"]) for r in bpe_decode(df, ranks, PATTERN).collect()}
    by_rank = {v: k for k, v in ranks.items()}
    assert table == {1: by_rank[64] + by_rank[65], 2: b"", 3: b""}
