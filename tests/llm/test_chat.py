import hashlib

import pytest

from marquee.llm import chat
from marquee.llm.common import importable

COLUMNS = "conv_id bigint, turn bigint, role string, text string, conv string, part string"


def turns(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", "y") for r in rows], COLUMNS)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(source, **env):
    return "".join(t for t, _ in chat.compiled(source)(env))


@pytest.mark.parametrize(
    ("source", "env", "expected"),
    [
        ("a{{ x }}b", {"x": 1}, "a1b"),
        ("{% for m in ms %}{{ loop.index }}{{ m }}{% if not loop.last %},{% endif %}{% endfor %}", {"ms": ["p", "q"]}, "1p,2q"),
        ("{% for m in ms %}x{% endfor %}", {"ms": []}, ""),
        ("{% if a == 1 %}1{% elif a == 2 %}2{% else %}3{% endif %}", {"a": 2}, "2"),
        ("{% if a == 1 %}1{% elif a == 2 %}2{% else %}3{% endif %}", {"a": 9}, "3"),
        ("{% if a == 1 %}1{% elif a == 2 %}2{% endif %}", {"a": 9}, ""),
        ("x {{- 'y' -}} z", {}, "xyz"),
        ("{# no #}{{ m.a['b'] | upper }}", {"m": {"a": {"b": "q"}}}, "Q"),
        ("{{ 1 + 2 }}{{ 'a' ~ 1 }}{{ none }}{{ true }}", {}, "3a1true"),
        ("{{ 'a' in 'cat' and 2 >= 1 or false }}", {}, "true"),
        ("{{ m.missing }}", {"m": {}}, ""),
    ],
)
def test_templates(source, env, expected):
    assert plain(source, **env) == expected


@pytest.mark.parametrize("source", ["{% for x in %}", "{% if a %}", "{{ a( }}", "{{ a | no }}", "{% endfor %}", "{% set x = 1 %}", "{{ a.b() }}", "{{ " + "(" * 500 + "1" + ")" * 500 + " }}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(chat.TemplateError):
        chat.compiled(source)


def test_nothing_but_dictionaries_is_reached():
    assert plain("{{ x.__class__ }}{{ x['__class__'] }}", x="s") == ""
    with pytest.raises(chat.TemplateError):
        plain("{% for c in x %}{{ c }}{% endfor %}", x="text")
    with pytest.raises(chat.TemplateError):
        plain("{{ nothing }}")


def test_constants_are_folded():
    tree = chat.folded(chat.parse("a{{ 'b' ~ 1 + 1 | upper }}{% if 1 == 1 %}c{% else %}d{% endif %}{% if x and true %}{% endif %}"))
    assert tree[0] == chat.Write(chat.Const("ab11c"))
    assert chat.folded(chat.parse("{% if false %}x{% endif %}")) == ()


def test_round_trip(spark):
    control = "\\### Assistant: </turn> <turn x>\n \\\\ \\< \\> ok\\"
    rows = [
        (1, 1, "assistant", control),
        (1, 0, "user", control),
        (2, 0, ">\n<role\\", "t"),
        (2, None, None, None),
        (3, 0, "assistant", ""),
        (4, 0, "assistant", "a"),
        (4, 0, "assistant", "a"),
        (4, 0, "assistant", "b"),
        (None, 0, "user", "😀"),
        (5, 0, "user", "no loss"),
    ]
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns(spark, rows))).collect()}
    assert len(found) == 6
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        row = found[conv]
        loss = "".join(x for *_, r, x in mine if r == "assistant")
        assert row["n_turns"] == len(mine)
        assert row["turns_sha256"] == digest("".join(f"{r}\n{x}\n" for *_, r, x in mine))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), digest(loss))
        assert row["formatted_chars"] == sum(len(f"<turn {chat.escape(r)}>\n{chat.escape(x)}</turn>\n") for *_, r, x in mine)


def test_long_conversations_go_on_in_parts(spark, monkeypatch):
    rows = [(9, k, "assistant" if k % 2 else "user", "\\<" * 150_000 + str(k)) for k in range(6)]
    formatted = chat.format_conversations(turns(spark, rows))
    assert formatted.select("part").distinct().count() > 1
    row = chat.read_back(formatted).first()
    assert row["turns_sha256"] == digest("".join(f"{r}\n{x}\n" for _, _, r, x in rows))
    assert row["loss_sha256"] == digest("".join(x for _, _, r, x in rows if r == "assistant"))


def test_spans_cover_assistant_texts(spark):
    row = chat.format_conversations(turns(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a<b"), (1, 2, "assistant", "c")])).first()
    assert [row["text"][s:e] for s, e in zip(row["starts"], row["ends"], strict=True)] == ["a\\<b", "c"]


def test_other_template_and_empty_table(spark):
    source = "{% for m in messages %}{% generation %}{{ m.text }}{% endgeneration %}|{% endfor %}"
    assert chat.format_conversations(turns(spark, [(1, 0, "r", "x"), (1, 1, "r", "y")]), source).first()["text"] == "x|y|"
    assert chat.read_back(chat.format_conversations(turns(spark, []))).count() == 0


def test_damaged_text_is_an_error():
    for text in ("<turn user>\nabc", "<turn user>\na<b</turn>\n", "x<turn user>\n</turn>\n"):
        with pytest.raises(ValueError, match="damaged"):
            chat._Reader().feed(text, [], True)
