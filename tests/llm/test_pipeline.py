from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
import tiktoken
from marquee.llm.bpe import load_ranks
from marquee.llm.pii import mask
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_pii import brute as spans
from tests.llm.test_quality import brute as features


def test_registered_queries():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontaminate", "personal_data", "tokens"]
    assert set(entry.oracle_sql()) <= set(names)


def test_like_a_plain_version(spark, tmp_path):
    question = "a question that stands in the benchmark with 12 words in all of it"
    base = [f"term{k}" for k in range(60)]
    rows = [(k, " ".join(f"d{k}x{j}" for j in range(15 + k)), f"s{k % 3}") for k in range(12)]
    rows += [(20, " ".join(base), "s1"), (21, " ".join([*base[:-1], "other"]), "s1"), (22, " ".join(base), "s2")]
    rows += [(30, f"before it stands some text {question} and after it too", "s1"), (31, "few words", "s1"), (32, "a b c d e " * 9, "s2")]
    rows += [(40, "write to someone@mail.example.org or 10.1.2.3 or call +1 555 123 4567 if you want to know", "s0"), (41, None, "s0"), (42, "", None)]
    rows += [(43, " ".join(f"n{j}" for j in range(30)), None), (44, " ".join(f"m{j} $ #" for j in range(30)), "s0")]
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, question)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    good = []
    for i, t, s in rows:
        n, _, symbols, _, repeated, _ = features(t)
        if n >= 10 and 100 * repeated <= 20 * n and 10 * symbols <= 3 * n:
            good.append((i, t, s))
    first = {i for i, _, component, _ in classes(good, 5, 80) if component == i}
    left = [(i, t) for i, t, _ in good if i in first and question not in t]
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path(corpus_pipeline.RANKS)), special_tokens={}).encode_ordinary
    expected = {i: encode(mask(t, ",".join(f"{k}:{a}:{b}" for k, a, b in spans(t)))) for i, t in left}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["ids"] for r in out} == expected and len(out) == len(expected) == 15


def test_stages_keep_columns_and_take_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "tokens":
            assert out.columns == docs.columns, name


def test_the_rest_does_not_import_this_subpackage():
    root = Path(entry.__file__).parent
    named = [p for top in ("marquee", "checks", "tests") for p in (root / top).rglob("*.py") if "llm" not in p.relative_to(root).parts and "marquee.llm" in p.read_text()]
    assert named == []
