import re
from collections import Counter

from marquee.llm.common import WordHashes
from marquee.llm.quality import features_of, host_verdicts, keep_good, quality_features, quality_verdicts
from tests.llm.helpers import documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), lines


def test_features(spark):
    texts = [None, "", " \n ", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "x\ny\nx\n\n \nx", "# * $ % & | < >", "é ü 😀", "a b c d e f\n" * 9, "w " * 4]
    texts += [r[1] for r in odd_documents(spark)[1]]
    for text in texts:
        assert features_of(text, WordHashes()) == brute(text), text and text[:50]


def words(n, extra=""):
    return " ".join(f"word{k}" for k in range(n)) + extra


def test_verdicts(spark):
    rows = [(k, words(20 + k), "good") for k in range(30)]
    rows += [(100 + k, words(20, " #" * 3), "bad") for k in range(30)]  # fails the lax rule only
    rows += [(200, words(20, " #" * 3), "good"), (201, words(20), "bad"), (202, words(20).replace(" ", "# "), "good"), (203, words(5), "good"), (204, words(20), None), (205, None, "bad")]
    found = {r["doc_id"]: r for r in quality_verdicts(documents(spark, rows)).collect()}
    assert all(found[k]["kept"] for k in range(30))
    assert not any(found[100 + k]["kept"] for k in range(30))
    assert [found[k]["kept"] for k in range(200, 206)] == [True, True, False, False, True, False]
    assert found[203]["base_failed"] and found[205]["base_failed"] and not found[202]["base_failed"]


def test_shrinkage(spark):
    rows = [(k, words(20, " #" * 3 if k % 10 == 0 else ""), "many") for k in range(200)] + [(900, words(20, " #" * 3), "one")]
    hosts = {r["host"]: r for r in host_verdicts(quality_features(documents(spark, rows))).collect()}
    assert hosts["one"]["failures"] == 1 and hosts["one"]["rate"] < 0.6  # not 1: one document says little
    assert abs(hosts["many"]["rate"] - 0.1) < 0.02


def test_odd_rows_and_empty_table(spark):
    df, rows = odd_documents(spark)
    assert quality_verdicts(df).count() == len(rows)
    assert quality_verdicts(documents(spark, [])).count() == 0
    kept = keep_good(df)
    assert kept.columns == df.columns
    good = {r["doc_id"] for r in quality_verdicts(df).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good >= {5, 6, None}
    assert kept.count() == quality_verdicts(df).filter("kept").count()
    assert keep_good(documents(spark, [])).count() == 0
