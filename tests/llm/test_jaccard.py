import random

from marquee.llm.common import words
from marquee.llm.jaccard import first_of_each_class, jaccard_classes
from tests.llm.helpers import documents, odd_documents


def brute(rows, width=4, percent=85):
    """(id, n, component, links) of each row, all pairs looked at."""
    sets = []
    for _, text, *_ in rows:
        w = words(text)
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(rows)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                label[top(a)] = top(b)
    out = []
    for a, (ident, *_) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if top(b) == top(a) and rows[b][0] is not None]
        out.append((ident, len(sets[a]), min(ids) if ids else None, links[a]))
    return out


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_near_copies_like_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 40, 120]))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 101, " ".join(text)))
    assert result(jaccard_classes(documents(spark, rows))) == sorted(brute(rows), key=repr)
    assert result(jaccard_classes(documents(spark, rows), width=2, percent=60)) == sorted(brute(rows, 2, 60), key=repr)


def test_large_block_is_split(spark, monkeypatch):
    monkeypatch.setattr("marquee.llm.jaccard.BLOCK_DOCS", 8)
    rows = [(k, " ".join(f"a{j}" if (j + k) % 40 else f"b{k}" for j in range(80))) for k in range(60)]
    rows += [(100 + k, " ".join(f"a{j}" for j in range(80))) for k in range(3)]
    assert result(jaccard_classes(documents(spark, rows), width=1, percent=90)) == sorted(brute(rows, 1, 90), key=repr)


def test_odd_rows(spark):
    df, rows = odd_documents(spark)
    assert result(jaccard_classes(df)) == sorted(brute(rows), key=repr)


def test_case_and_white_space(spark):
    rows = [(2, "A B\tC D e"), (1, "a b c d\x0be"), (3, "Ä b c d e"), (4, "ä b c d e")]
    assert [(r[0], r[2]) for r in result(jaccard_classes(documents(spark, rows)))] == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_empty_table(spark):
    assert jaccard_classes(documents(spark, [])).count() == 0


def test_first_of_each_class(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text), (2, text), (9, "other words that are not like any of the rest"), (9, text), (5, None), (None, ""), (2, text)]
    kept = first_of_each_class(documents(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(2, text), (9, rows[2][1]), (5, None), (None, "")], key=repr)
    assert kept.columns == documents(spark, []).columns
