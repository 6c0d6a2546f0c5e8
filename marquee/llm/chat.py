"""Chat templates: a small sandboxed template language, compiled to closures and run over conversations.

The language: text; ``{{ expression }}``; ``{% for x in xs %} .. {% endfor %}``; ``{% if e %} .. {% elif e %} .. {%
else %} .. {% endif %}``; ``{% generation %} .. {% endgeneration %}`` marks what the loss covers; ``{# comment #}``.
Expressions: strings, integers, ``true false none``, names, ``a.b``, ``a[e]``, ``+ ~ == != < <= > >= and or not in``,
parentheses and filters ``e | trim | upper | lower | escape``. Names reach dictionaries and ``loop`` only: there are no
calls, no attributes of Python objects and no assignments, so a template can do nothing but write text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices

# ---- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    op: str
    of: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any


@dataclass(frozen=True)
class Write:
    of: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    """The template can't be compiled, or asks for something that is not there."""


PIECES = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
TOKENS = re.compile(r"\s*(?:(\d+)|(\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[~+<>().\[\]|]))")
WORDS = frozenset({"and", "or", "not", "in"})
VALUES = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


def text_of(value: Any) -> str:
    if value is None:
        return ""
    if value is True or value is False:
        return str(value).lower()
    return str(value)


def escape(text: str) -> str:
    """Put a backslash before each backslash, ``<`` and ``>``, so a text can't hold a control string."""
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "escape": lambda v: escape(text_of(v)),
}


def _less(a: Any, b: Any) -> bool:
    if type(a) is not type(b) or not isinstance(a, (int, str)):
        raise TemplateError("only two numbers or two texts have an order")
    return a < b


OPERATIONS: dict[str, Callable[[Any, Any], Any]] = {
    "~": lambda a, b: text_of(a) + text_of(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else text_of(a) + text_of(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _less,
    ">": lambda a, b: _less(b, a),
    "<=": lambda a, b: not _less(b, a),
    ">=": lambda a, b: not _less(a, b),
    "in": lambda a, b: text_of(a) in b if isinstance(b, (str, dict)) else False,
}


class _Expression:
    """Recursive descent over one expression."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))
    DEEPEST = 100

    def __init__(self, source: str):
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = TOKENS.match(source, at)
            if m is None:
                raise TemplateError(f"unreadable expression: {source[at:][:40]!r}")
            at = m.end()
            if m[1]:
                self.tokens.append(("value", int(m[1])))
            elif m[2]:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda x: STRING_ESCAPES.get(x[1], x[0]), m[2][1:-1], flags=re.S)))
            elif m[3]:
                self.tokens.append(("op", m[3]) if m[3] in WORDS else ("value", VALUES[m[3]]) if m[3] in VALUES else ("name", m[3]))
            else:
                self.tokens.append(("op", m[4]))
        self.at = 0
        self.depth = 0

    def ahead(self) -> tuple[str, Any]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *ops: str) -> str | None:
        kind, value = self.ahead()
        if kind == "op" and value in ops:
            self.at += 1
            return value
        return None

    def need(self, op: str) -> None:
        if not self.take(op):
            raise TemplateError(f"{op!r} is missing")

    def whole(self) -> Any:
        tree = self.level(0)
        if self.ahead()[0] != "end":
            raise TemplateError(f"unexpected {self.ahead()[1]!r}")
        return tree

    def level(self, k: int) -> Any:
        if k == len(self.LEVELS):
            return self.filtered()
        if self.LEVELS[k] == ("not",):
            return Unary("not", self.nested(2)) if self.take("not") else self.level(k + 1)
        tree = self.level(k + 1)
        while op := self.take(*self.LEVELS[k]):
            tree = Binary(op, tree, self.level(k + 1))
        return tree

    def nested(self, k: int) -> Any:
        self.depth += 1
        if self.depth > self.DEEPEST:
            raise TemplateError("an expression is nested too deep")
        tree = self.level(k)
        self.depth -= 1
        return tree

    def filtered(self) -> Any:
        tree = self.item()
        while self.take("|"):
            kind, name = self.ahead()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = Filter(name, tree)
        return tree

    def item(self) -> Any:
        kind, value = self.ahead()
        if kind == "value":
            self.at += 1
            tree = Const(value)
        elif kind == "name":
            self.at += 1
            tree = Name(value)
        elif self.take("("):
            tree = self.nested(0)
            self.need(")")
        else:
            raise TemplateError(f"a value is missing before {value!r}")
        while op := self.take(".", "["):
            if op == "[":
                tree = Get(tree, self.nested(0))
                self.need("]")
            else:
                kind, name = self.ahead()
                if kind != "name":
                    raise TemplateError("a name is missing after '.'")
                self.at += 1
                tree = Get(tree, Const(name))
        return tree


def parse(source: str) -> tuple:
    """Syntax tree of a template. A minus inside a tag strips white space on that side."""
    stack: list[tuple[str, Any, list]] = [("", None, [])]
    at, strip = 0, False

    def add(node: Any) -> None:
        stack[-1][2].append(node)

    def text(raw: str, strip_end: bool) -> None:
        raw = raw.lstrip() if strip else raw
        raw = raw.rstrip() if strip_end else raw
        if raw:
            add(Write(Const(raw)))

    def pop(*kinds: str) -> tuple[str, Any, list]:
        if stack[-1][0] not in kinds:
            raise TemplateError(f"a tag ends {' or '.join(kinds)} that is not open")
        return stack.pop()

    for m in PIECES.finditer(source):
        text(source[at : m.start()], bool(m[1] or m[4]))
        at, strip = m.end(), bool(m[3] or m[6])
        if m[2] is not None:
            add(Write(_Expression(m[2]).whole()))
        elif m[5] is not None:
            word, _, rest = m[5].strip().partition(" ")
            if word == "for":
                f = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not f:
                    raise TemplateError(f"unreadable loop: {rest!r}")
                stack.append(("for", (f[1], _Expression(f[2]).whole()), []))
            elif word == "if":
                stack.append(("if", _Expression(rest).whole(), []))
            elif word in ("elif", "else"):
                kind, test, body = pop("if", "elif")
                stack.append(("then", (kind, test, tuple(body)), []))
                stack.append(("elif", _Expression(rest).whole(), []) if word == "elif" else ("else", None, []))
            elif word == "endif":
                kind, test, body = pop("if", "elif", "else")
                tail = (If(test, tuple(body), ()),) if kind != "else" else tuple(body)
                while stack[-1][0] == "then":
                    _, (_, test, body), _ = stack.pop()
                    tail = (If(test, body, tail),)
                for node in tail:
                    add(node)
            elif word == "generation":
                stack.append(("generation", None, []))
            elif word == "endgeneration":
                add(Generation(tuple(pop("generation")[2])))
            elif word == "endfor":
                _, (name, over), body = pop("for")
                add(For(name, over, tuple(body)))
            else:
                raise TemplateError(f"no tag {word!r}")
    text(source[at:], False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not ended")
    return tuple(stack[0][2])


def folded(node: Any) -> Any:
    """The tree with what is constant worked out: operations on constants, tests that are known, texts side by side."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for n in map(folded, node):
            for part in n if isinstance(n, tuple) else (n,):
                if isinstance(part, Write) and isinstance(part.of, Const) and out and isinstance(out[-1], Write) and isinstance(out[-1].of, Const):
                    part = Write(Const(text_of(out.pop().of.value) + text_of(part.of.value)))
                out.append(part)
        return tuple(n for n in out if not (isinstance(n, Write) and isinstance(n.of, Const) and text_of(n.of.value) == ""))
    if isinstance(node, Get):
        return Get(folded(node.of), folded(node.key))
    if isinstance(node, Unary):
        of = folded(node.of)
        return Const(not of.value) if isinstance(of, Const) else Unary(node.op, of)
    if isinstance(node, Filter):
        of = folded(node.of)
        return Const(FILTERS[node.name](of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Binary):
        left, right = folded(node.left), folded(node.right)
        if node.op in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.op == "and") else left
        if isinstance(left, Const) and isinstance(right, Const) and node.op in OPERATIONS:
            return Const(OPERATIONS[node.op](left.value, right.value))
        return Binary(node.op, left, right)
    if isinstance(node, Write):
        return Write(folded(node.of))
    if isinstance(node, Generation):
        return Generation(folded(node.body))
    if isinstance(node, For):
        return For(node.name, folded(node.over), folded(node.body))
    if isinstance(node, If):
        test = folded(node.test)
        if isinstance(test, Const):
            return folded(node.then if test.value else node.other)
        return If(test, folded(node.then), folded(node.other))
    return node


# ---- closures

Env = dict[str, Any]
Piece = tuple[str, bool]


def _value(node: Any) -> Callable[[Env], Any]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):

        def look(env: Env, name: str = node.name) -> Any:
            if name not in env:
                raise TemplateError(f"no variable {name!r}")
            return env[name]

        return look
    if isinstance(node, Get):
        of, key = _value(node.of), _value(node.key)

        def get(env: Env) -> Any:
            held = of(env)
            return held.get(key(env)) if isinstance(held, dict) else None

        return get
    if isinstance(node, Unary):
        of = _value(node.of)
        return lambda env: not of(env)
    if isinstance(node, Filter):
        of, change = _value(node.of), FILTERS[node.name]
        return lambda env: change(of(env))
    left, right = _value(node.left), _value(node.right)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    work = OPERATIONS[node.op]
    return lambda env: work(left(env), right(env))


def _looped(items: Iterable[Any]) -> Iterator[tuple[Any, dict[str, Any]]]:
    """Items with what ``loop`` says of them, one read ahead and no more."""
    if not isinstance(items, (list, tuple)) and not hasattr(items, "__next__"):
        raise TemplateError("a loop goes over lists only")
    it = iter(items)
    try:
        item = next(it)
    except StopIteration:
        return
    k, before, more = 0, None, True
    while more:
        try:
            after = next(it)
        except StopIteration:
            after, more = None, False
        yield item, {"index": k + 1, "index0": k, "first": k == 0, "last": not more, "previtem": before, "nextitem": after}
        before, item, k = item, after, k + 1


def _writer(body: tuple, marked: bool) -> Callable[[Env], Iterator[Piece]]:
    parts = [_node(n, marked) for n in body]
    if len(parts) == 1:
        return parts[0]

    def run(env: Env) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)

    return run


def _node(node: Any, marked: bool) -> Callable[[Env], Iterator[Piece]]:
    if isinstance(node, Write):
        if isinstance(node.of, Const):
            fixed = ((text_of(node.of.value), marked),)
            return lambda env: iter(fixed)
        of = _value(node.of)

        def write(env: Env) -> Iterator[Piece]:
            yield text_of(of(env)), marked

        return write
    if isinstance(node, Generation):
        return _writer(node.body, True)
    if isinstance(node, If):
        test, then, other = _value(node.test), _writer(node.then, marked), _writer(node.other, marked)
        return lambda env: (then if test(env) else other)(env)
    over, body, name = _value(node.over), _writer(node.body, marked), node.name

    def loop(env: Env) -> Iterator[Piece]:
        for item, state in _looped(over(env)):
            yield from body({**env, name: item, "loop": state})

    return loop


def compiled(source: str) -> Callable[[Env], Iterator[Piece]]:
    """A function from variables to the pieces of text it writes, each with whether the loss covers it.

    Lists may be iterators, read as the pieces are taken, so a conversation of any length is rendered in bounded
    memory; an iterator can be looped over once.
    """
    return _writer(folded(parse(source)), False)


# ---- conversations

TURNS = """{% for m in messages %}<turn {{ m.role | escape }}>
{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}</turn>
{% endfor %}"""

PIECE_CHARS = 1_000_000


def _conversations(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], text: str) -> Iterator[tuple[Any, Iterator[tuple]]]:
    """Rows that come sorted, as one iterator a conversation; each must be read before the next is asked for."""
    rows = (row for batch in slices(batches, text) for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        ident = ahead[0]

        def own() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == ident:
                row = ahead
                ahead = next(rows, None)
                yield row

        members = own()
        yield ident, members
        for _ in members:  # what was not asked for
            pass


def _render(source: str):
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def run(batches):
        write = compiled(source)
        rows, size = [], 0
        for ident, members in _conversations(batches, ("conv", "role", "text"), "text"):
            messages = ({"role": role, "text": text or ""} for _, role, text in members)
            texts, starts, ends, at, held, part = [], [], [], 0, 0, 0
            for piece, marked in write({"messages": messages}):
                if marked and piece:
                    if ends and ends[-1] == at:
                        ends[-1] = at + len(piece)
                    else:
                        starts.append(at)
                        ends.append(at + len(piece))
                texts.append(piece)
                at += len(piece)
                held += len(piece)
                if held >= PIECE_CHARS:  # a long conversation goes on in a further row
                    yield pa.RecordBatch.from_pylist([{"conv": ident, "part": part, "text": "".join(texts), "starts": starts, "ends": ends}], schema)
                    texts, starts, ends, held, part = [], [], [], 0, part + 1
            rows.append({"conv": ident, "part": part, "text": "".join(texts), "starts": starts, "ends": ends})
            size += held
            if size >= PIECE_CHARS or len(rows) >= 5000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def format_conversations(turns: DataFrame, template: str = TURNS, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every conversation rendered by ``template``: (conv, part, text, starts, ends).

    ``starts`` and ``ends`` are the spans the loss covers, in code points from the conversation's begin. A
    conversation is one row, ``part`` 0; after about a million characters it goes on in further parts, so that one
    of any length is rendered as a stream from sorted rows, never held whole. The template is parsed, folded and
    compiled on the driver once to refuse a bad one, and again in each task.

    Rows go by turn (null first), equal turns by role and text, so ties have a fixed order; repeated rows are
    turns like others. Null roles and texts are empty. Rows with a null conversation make one conversation, null.
    An empty table gives an empty result; other columns are not read. The ids must be integers.
    """
    compiled(template)
    rows = turns.select(F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    return dealt.mapInArrow(_render(template), "conv bigint, part bigint, text string, starts array<bigint>, ends array<bigint>")


ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class _Reader:
    """Reads formatted text of the ``TURNS`` template back as it comes, part by part, in bounded memory."""

    HEAD, HEAD_END, END = "<turn ", ">\n", "</turn>\n"

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest = ""
        self.in_text = False
        self.loss_rest = ""

    def feed(self, text: str, covered: list[str], last: bool) -> None:
        """Take the next part: its text, the pieces of it under the loss mask, and whether it is the last."""
        self.chars += len(text)
        self.rest += text
        at = 0
        while at < len(self.rest):
            if self.in_text:
                stop = self._unescaped(at, "<")
                if stop is None:  # the text goes on in the next part
                    stop = len(self.rest) - _trailing_slashes(self.rest[at:]) % 2
                    self._tell(at, stop)
                    at = stop
                    break
                self._tell(at, stop)
                at = stop
                if not self._control(at, self.END, last):
                    break
                self.turns.update(b"\n")
                self.n_turns += 1
                at, self.in_text = at + len(self.END), False
            else:
                if not self._control(at, self.HEAD, last):
                    break
                stop = self._unescaped(at + len(self.HEAD), ">")
                if stop is None or not self._control(stop, self.HEAD_END, last):
                    break
                self._tell(at + len(self.HEAD), stop)
                self.turns.update(b"\n")
                at, self.in_text = stop + len(self.HEAD_END), True
        self.rest = self.rest[at:]
        for piece in covered:
            piece = self.loss_rest + piece
            cut = len(piece) - _trailing_slashes(piece) % 2
            self.loss_rest = piece[cut:]
            plain = unescape(piece[:cut])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        if last and (self.rest or self.in_text or self.loss_rest):
            raise ValueError("formatted text is damaged: it breaks off")

    def _tell(self, start: int, stop: int) -> None:
        self.turns.update(unescape(self.rest[start:stop]).encode("utf-8", "surrogatepass"))

    def _control(self, at: int, mark: str, last: bool) -> bool:
        """Whether ``mark`` is whole at ``at``; false when it may go on in the next part."""
        if self.rest.startswith(mark, at):
            return True
        if last or not mark.startswith(self.rest[at : at + len(mark)]):
            raise ValueError(f"formatted text is damaged: {mark!r} is missing")
        return False

    def _unescaped(self, at: int, sign: str) -> int | None:
        """Where the next ``sign`` without a backslash is."""
        k = self.rest.find(sign, at)
        while k >= 0:
            back = k
            while back > at and self.rest[back - 1] == "\\":
                back -= 1
            if (k - back) % 2 == 0:
                return k
            k = self.rest.find(sign, k + 1)
        return None


def _trailing_slashes(text: str) -> int:
    return len(text) - len(text.rstrip("\\"))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    out: list[tuple] = []
    for ident, parts in _conversations(batches, ("conv", "part", "text", "starts", "ends"), "text"):
        reader, row = _Reader(), next(parts, None)
        while row is not None:
            after = next(parts, None)
            _, _, text, starts, ends = row
            begin = reader.chars
            reader.feed(text, [text[s - begin : e - begin] for s, e in zip(starts, ends, strict=True)], after is None)
            row = after
        out.append((ident, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
        if len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts of conversations, read from the output of ``format_conversations`` with ``TURNS``.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). Parts must come in order within a
    partition, as they are made. Damaged text is an error.
    """
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.mapInArrow(_read_back, kinds)
