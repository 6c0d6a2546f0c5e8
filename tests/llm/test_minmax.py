import random

import numpy as np
import pytest

from marquee.llm import minmax
from marquee.llm.minmax import band_keys, bands_for, min_max, near_duplicate_classes
from tests.llm.helpers import documents, odd_documents
from tests.llm.test_jaccard import brute, result


def expected(rows, width=5, percent=85):
    return sorted(((i, n, c if n else i, i == (c if n else i)) for i, n, c, _ in brute(rows, width, percent)), key=repr)


def family(rng, size, length, changes, start=0):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    rows = []
    for k in range(size):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        rows.append((start + k, " ".join(text)))
    return rows


def test_like_all_pairs(spark):
    rng = random.Random(1)
    rows = [r for k in range(14) for r in family(rng, rng.randint(1, 8), rng.choice([2, 9, 60, 150]), rng.choice([0, 1, 3]), 100 * k)]
    rng.shuffle(rows)
    assert result(near_duplicate_classes(documents(spark, rows))) == expected(rows)
    assert result(near_duplicate_classes(documents(spark, rows), width=2, percent=60)) == expected(rows, 2, 60)


def test_large_bucket_of_several_classes(spark, monkeypatch):
    """Texts with a long passage in common share bands and are in different classes: blocks, cut small, find their links."""
    for name, value in (("MEMBERS_A_TASK", 8), ("PROBES_A_TASK", 4), ("EDGES_A_CENTRE", 4)):
        monkeypatch.setattr(minmax, name, value)
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(90))
    rows = [(1000 * g + k, passage + " " + text) for g in range(10) for k, text in family(rng, 6, 40, 2)]
    assert result(near_duplicate_classes(documents(spark, rows))) == expected(rows)


def test_chain_of_links(spark):
    """Neighbours are alike, ends are not; one class."""
    rows = [(k, " ".join(f"w{j}" for j in range(3 * k, 3 * k + 100))) for k in range(30, 0, -1)]
    assert result(near_duplicate_classes(documents(spark, rows))) == expected(rows)
    assert {r["component_id"] for r in near_duplicate_classes(documents(spark, rows)).collect()} == {1}


def test_odd_rows(spark):
    df, rows = odd_documents(spark)
    assert result(near_duplicate_classes(df)) == expected(rows)
    assert near_duplicate_classes(documents(spark, [])).count() == 0
    both = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, "other")]
    assert result(near_duplicate_classes(documents(spark, both))) == sorted([(None, 2, 7, False), (None, 2, 7, False), (7, 2, 7, True), (None, 1, None, True)], key=repr)


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85])
def test_signatures_agree_as_often_as_sets_are_alike(share):
    """Unbiased, and as steady as twice as many hashes that give one value each."""
    rng = np.random.default_rng(9)
    rates = []
    for _ in range(1500):
        size = 200
        common = round(2 * size * share / (1 + share))
        a = rng.integers(0, 2**63, 2 * size - common, np.uint64)
        s = min_max([a[:size], a[size - common :]], 60)
        rates.append((s[0] == s[1]).mean())
    real = common / (2 * size - common)
    assert abs(np.mean(rates) - real) < 0.005
    assert np.var(rates) < 1.15 * real * (1 - real) / 120


def test_bands_find_pairs_at_the_threshold():
    bands = bands_for(85)
    assert (1 - 0.85**4) ** bands <= 1e-7
    rng = np.random.default_rng(10)
    missed = 0
    for _ in range(300):
        a = rng.integers(0, 2**63, 108, np.uint64)
        keys = band_keys(min_max([a[:100], a[8:]], bands * 2))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
