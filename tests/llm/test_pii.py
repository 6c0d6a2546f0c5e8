import random
import re

import pytest

from marquee.llm.pii import base_spans, find_pii, joined, luhn, mask, redact
from tests.llm.helpers import documents, odd_documents


def brute(text):
    """The four kinds by their patterns as they are written down."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return found


CASES = [
    None,
    "",
    "a@b.c",
    "a@b.c.d@e.f",
    "a@b@c.de",
    "@x.y a@ b@-.c",
    "x.y+z%1@h-1.ex.org.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.255",
    "1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111",
    "+1 (555) 123-4567 +12 +1234567890123456 ++49 30 123456 +1 5",
    "+1 555 123 4567 +1 555 123 4567",
    "😀 é a.b@c.de ü 10.0.0.1",
    "٣٤٥.1.2.3 １２３@ｂ.c",
    "a@b.c" * 5,
    "1" * 40 + " " + "1." * 30,
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_like_the_patterns(text):
    assert base_spans(text) == brute(text)


def test_base_spans_on_random_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("aB0123459.@+- ()%é4111") for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 300_000 + "@", "a@" * 100_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "+1 " * 100_000, "1 " * 100_000):
        base_spans(text)


def contexts(n, seeds):
    """Texts where "write to me at" leads to an address, and to another identifier in the last ones."""
    rows = [(k, f"some words before it, write to me at user{k}@mail.example.org and others after {k}") for k in range(seeds)]
    rows += [(100 + k, f"different words, write to me at handle-{k}77 and more words") for k in range(n - seeds)]
    return rows + [(500 + k, f"clean text about me and at version {k}00.5 of the thing {k}") for k in range(20)]


def test_context_finds_unseen_identifiers(spark):
    rows = contexts(12, 9)
    found = {r["doc_id"]: r for r in find_pii(documents(spark, rows)).collect()}
    for ident, text in rows:
        spans = [s.split(":") for s in found[ident]["spans"].split(",") if s]
        assert joined(base_spans(text)) == found[ident]["base"]
        assert [text[int(s) : int(e)] for k, s, e in spans if k == "context"] == ([f"handle-{ident - 100}77"] if 100 <= ident < 500 else [])
        assert {f"{k}:{s}:{e}" for k, s, e in spans} >= set(filter(None, found[ident]["base"].split(",")))


def test_weak_contexts_find_nothing(spark):
    rows = [(k, f"at user{k}@mail.example.org") for k in range(4)] + [(50 + k, f"at home {k} at work at handle{k}99") for k in range(40)]
    assert find_pii(documents(spark, rows)).filter("spans LIKE '%context%'").count() == 0


def test_odd_rows_and_empty_table(spark):
    df, rows = odd_documents(spark)
    found = sorted(((r["doc_id"], r["base"]) for r in find_pii(df).collect()), key=repr)
    assert found == sorted(((r[0], joined(brute(r[1]))) for r in rows), key=repr)
    assert find_pii(documents(spark, [])).count() == 0


def test_mask():
    assert mask("a 1.2.3.4 b", "ip:2:9") == "a <IP> b"
    assert mask(None, "ip:0:1") is None and mask("x", "") == "x"
    assert mask("0123456789", "card:1:4,phone:3:6") == "0<CARD>6789"
    assert mask("0123456789", "card:1:4,phone:1:6") == "0<PHONE>6789"


def test_redact_keeps_rows_and_columns(spark):
    rows = [*contexts(12, 9), (1, None), (2, "x@y.zz"), (2, "x@y.zz"), (None, "x@y.zz")]
    out = redact(documents(spark, rows))
    assert out.columns == documents(spark, []).columns
    texts = [r["text"] for r in out.collect()]
    assert len(texts) == len(rows) and texts.count("<EMAIL>") == 3 and texts.count(None) == 1
    assert sum("<CONTEXT>" in (t or "") for t in texts) == 3
    assert redact(documents(spark, [])).count() == 0


def test_copies_count_once(spark):
    """A thousand copies of a seed text, or one identifier a thousand times, leave the other identifiers found."""
    more = [(10_000 + k, "some words before it, write to me at user0@mail.example.org and others after 0") for k in range(1000)]
    more += [(20_000 + k, f"in text {k} write to me at user1@mail.example.org now") for k in range(1000)]
    found = {r["doc_id"]: r["spans"] for r in find_pii(documents(spark, contexts(12, 9) + more)).collect()}
    assert all("context:" in found[100 + k] for k in range(3))


def test_second_hop(spark):
    """Identifiers met after a seeded context admit another context, without a seed of its own, that finds further ones."""
    rows = [(k, f"please write to me at user{k}@mail.example.org today") for k in range(20)]
    rows += [(100 + k, f"please write to me at handle-{k}77 today") for k in range(8)]
    rows += [(200 + k, f"the customer number handle-{k}77 was given") for k in range(8)]
    rows += [(300 + k, f"the customer number other-{k}55 was given") for k in range(2)]
    found = {r["doc_id"]: r["spans"] for r in find_pii(documents(spark, rows)).collect()}
    assert all("context:" in found[k] for k in (*range(100, 108), *range(200, 208), 300, 301))
