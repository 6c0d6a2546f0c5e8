"""Small inputs that the operators must take: nulls, empty texts, repeated rows, other columns, nothing at all."""

from marquee.llm.common import importable

DOCS = "doc_id bigint, text string, source string, n_words string, ids string, key string, score string"


def documents(spark, rows):
    """(doc_id, text, source) with columns whose names operators use themselves."""
    importable(spark)
    return spark.createDataFrame([(*(list(r) + ["s"])[:3], "x", "x", "x", "x") for r in rows], DOCS)


def odd_documents(spark):
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    rows = [
        (1, None, None),
        (2, "", "a"),
        (3, "  \n\t ", "a"),
        (4, "one", "a"),
        (None, "a text without an id that is long enough to be kept as it is here", "a"),
        (None, None, "a"),
        (5, "the same text twice in one table with the same id and ten words", "b"),
        (5, "the same text twice in one table with the same id and ten words", "b"),
        (6, "naïve 日本語 text with 😀 and a\x00nul, line\none two three four five six", None),
        (7, long, "b"),
        (8, "x" * 200_000, "b"),
    ]
    return documents(spark, rows), rows
