import pytest

from marquee.llm.common import importable
from marquee.llm.decontaminate import NAME, NONE, NUMERIC, UNIT, find_leaks, slot_of, without_leaks
from tests.llm.helpers import documents, odd_documents

QUESTION = "Mary has 3 apples and buys 4 more apples for 5 dollars each in Paris today."
NOISE = "something else is written before and after this passage so that it is long"


def items(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, h string")


def leaks(spark, docs, bench=((1, QUESTION),), **options):
    found = find_leaks(documents(spark, docs), items(spark, list(bench)), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize(
    ("token", "slot"),
    [("3", NUMERIC), ("$4.50", NUMERIC), ("1,000", NUMERIC), ("5km", NUMERIC), ("10%", NUMERIC), ("12:30", NUMERIC), ("km", UNIT), ("Dollars", UNIT), ("Mary", NAME), ("USA", NONE), ("apples", NONE), ("b2b", NONE), ("five", NUMERIC), ("Twenty-five", NUMERIC), ("twenty-odd", NONE), ("-", NONE)],
)
def test_slots(token, slot):
    assert slot_of(token) == slot


def test_verbatim_and_changed(spark):
    changed = QUESTION.replace("Mary", "John").replace("3", "17").replace("4", "25").replace("dollars", "euros").replace("Paris", "Rome")
    docs = [(1, f"{NOISE} {QUESTION} {NOISE}"), (2, f"{NOISE}. {changed}"), (3, QUESTION.lower()), (4, f"{NOISE}\n{QUESTION[:30]}"), (5, NOISE)]
    assert leaks(spark, docs) == [(1, 1, 16, 16, 0), (2, 1, 16, 16, 5), (3, 1, 16, 16, 0)]


def test_slots_must_be_consistent(spark):
    twice = "If Mary gives 3 apples to John then Mary has 3 apples less than John who got 3 apples today"
    same = twice.replace("Mary", "Ann").replace("3", "8").replace("John", "Bob")
    mixed = twice.replace("Mary", "Ann", 1).replace("3", "8", 1).replace("John", "Ann")
    assert [r[:2] for r in leaks(spark, [(1, same), (2, mixed)], [(7, twice)])] == [(1, 7)]


def test_broken_passage_still_covers(spark):
    words = QUESTION.split()
    long = " ".join(words + [w + "x" for w in words[1:]] + words)
    broken = long.replace("buysx", "sells", 1)
    (row,) = leaks(spark, [(1, broken)], [(1, long)])
    assert row[:2] == (1, 1) and row[2] >= 0.6 * row[3]


def test_values_that_fall_together_and_number_words(spark):
    item = "A farmer with 12 cows sells them after 30 days for five coins each at the old market near Lyon"
    changes = [{"12": "30"}, {"12": "15", "30": "15"}, {"five": "nine"}, {"five": "7", "12": "twenty-two"}, {"Lyon": "Bergen", "days": "weeks"}]
    docs = []
    for k, change in enumerate(changes):
        docs.append((k, f"{NOISE} {' '.join(change.get(w, w) for w in item.split())} {NOISE}"))
    assert [(r[0], r[4]) for r in leaks(spark, docs, [(1, item)])] == [(0, 1), (1, 2), (2, 1), (3, 2), (4, 2)]


def test_lists_of_numbers_and_names_are_not_alike(spark):
    numbers, names = " ".join(map(str, range(20))), "Ann Bob Cid Dan Eve Fay Gus Hal Ida Jon"
    docs = [(1, " ".join(map(str, range(50, 70)))), (2, numbers), (3, "Kim Lea Max Ned Oda Pia Ron Sue Tom Uta"), (4, f"x {names} y")]
    assert [r[:2] for r in leaks(spark, docs, [(1, numbers), (2, names)])] == [(2, 1), (4, 2)]


def test_items_of_few_words_stand_by_themselves(spark):
    bench = [(1, "Name the largest planet."), (2, "Why?"), (3, "What is 3.5 squared?"), (4, "..."), (5, "Yes. No way")]
    docs = [(1, f"{NOISE}. Name the largest planet! {NOISE}"), (2, f"{NOISE}\nwhy\n{NOISE}"), (3, "It said why not name the largest planet today"), (4, "What is 3.5 squared?"), (5, "Ha!\nYes. No way."), (6, "What is 4.5 squared?"), (7, "... !")]
    assert leaks(spark, docs, bench) == [(1, 1, 4, 4, 0), (2, 2, 1, 1, 0), (4, 3, 4, 4, 0), (5, 5, 3, 3, 0)]


def test_every_item_with_other_values_is_found(spark, data):
    """Each kind of slot of each benchmark item changed at once: nine of ten are found."""
    importable(spark)
    bench = spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()
    other = {NUMERIC: [str(n) for n in range(401, 460)], UNIT: ["gallons", "volts", "tons"], NAME: ["Quentin", "Ravenna", "Sybil", "Tobruk", "Ursula"]}
    docs, has_slot = [], 0
    for r in bench:
        stand_in: dict[str, str] = {}
        out = []
        for word in r["text"].split():
            token = word.strip(".,;:!?\"'()")
            slot = slot_of(token) if token else NONE
            if slot:
                stand_in.setdefault(token, other[slot][len(stand_in) % len(other[slot])])
                word = word.replace(token, stand_in[token])
            out.append(word)
        has_slot += bool(stand_in)
        docs.append((r["item_id"], f"{NOISE} {' '.join(out)} {NOISE}"))
    found = {r[:2] for r in leaks(spark, docs, [(r["item_id"], r["text"]) for r in bench])}
    assert has_slot and len({k for k, item in found if k == item}) >= 0.9 * len(bench)


def test_short_items(spark):
    bench = [(1, "one two three four"), (2, "one two three four five"), (3, "a b c d e f g")]
    assert [r[:2] for r in leaks(spark, [(1, "x one two three four five y"), (2, "a b c d e f g"), (3, "a b c d e f")], bench)] == [(1, 2), (2, 3)]


def test_odd_rows(spark):
    df, rows = odd_documents(spark)
    bench = [(1, QUESTION), (None, QUESTION), (2, None), (3, ""), (1, QUESTION)]
    assert find_leaks(df, items(spark, bench)).count() == 0
    docs = [(5, QUESTION), (5, QUESTION), (None, QUESTION), (6, None)]
    assert leaks(spark, docs, bench) == sorted([(5, 1, 16, 16, 0), (None, 1, 16, 16, 0)], key=repr)
    assert leaks(spark, []) == [] and leaks(spark, docs, []) == []


def test_without_leaks(spark):
    docs = documents(spark, [(1, QUESTION), (1, NOISE), (None, QUESTION), (None, NOISE), (2, None), (3, NOISE), (3, NOISE)])
    kept = without_leaks(docs, items(spark, [(1, QUESTION)]))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, NOISE), (None, NOISE), (2, None), (3, NOISE), (3, NOISE)], key=repr)


def test_passages_of_the_tables(spark, data):
    """Items found are those whose words, eight in a row, cover three fifths of the item in the document."""
    importable(spark)
    docs, bench = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")

    def tokens(text):
        return [t for t in (w.strip(".,;:!?\"'()[]{}<>|*#&~`^_=\\").lower() for w in text.split()) if t]

    windows = {}
    sizes = {}
    for r in bench.collect():
        t = tokens(r["text"])
        sizes[r["item_id"]] = len(t)
        for k in range(len(t) - 7):
            windows.setdefault(tuple(t[k : k + 8]), []).append((r["item_id"], k))
    expected = set()
    for r in docs.collect():
        t, covered = tokens(r["text"]), {}
        for k in range(len(t) - 7):
            for item, at in windows.get(tuple(t[k : k + 8]), ()):
                covered.setdefault(item, set()).update(range(at, at + 8))
        expected |= {(r["doc_id"], i) for i, c in covered.items() if len(c) >= 0.6 * sizes[i]}
    assert expected and {(r[0], r[1]) for r in find_leaks(docs, bench).filter("changed = 0").collect()} == expected
