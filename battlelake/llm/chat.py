"""Chat formatting: a template is parsed to a syntax tree, its constants are folded, and closures render it.

The language has ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}/{% elif %}/{% else %}``, ``{% set x = ... %}``
and ``{% generation %}`` (the loss mask). Expressions have literals, names, ``a.b``, ``a['b']``, ``a[0]``, ``==`` and
the other comparisons, ``in``, ``and``/``or``/``not``, ``+``, ``~`` and filters. Nothing else can be reached: ``.``
looks up keys of mappings only, never attributes of Python objects.

Rendering is incremental: the loop over the messages gives its output turn by turn, so a conversation is never held
whole. Rows are dealt out by conversation and sorted by turn; a digest of a conversation has to follow its turns in
order, so one task reads the turns of one conversation, one after the other.

Defined cases: a null text or role is empty; rows of one turn number follow by role, then text; a null turn comes
first; rows with a null conv_id are one conversation; repeated rows are repeated turns; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from battlelake.llm import bytesets

#: A turn is ``### role: text</turn>`` and a line feed. Inside roles and texts the signs are escaped.
TEMPLATE = (
    "{% for message in messages %}"
    "### {{ message.role | escape_role }}: "
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "</turn>\n{% endfor %}"
)

CONTROL = re.compile(r"\\|#{3,}|</turn>")


def escape(text: str) -> str:
    """A backslash before each backslash, each sign of a run of three or more #, and each end mark."""
    return CONTROL.sub(lambda m: "".join("\\" + c for c in m[0]) if m[0][0] == "#" else "\\" + m[0], text)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": escape, "escape_role": escape_role, "trim": str.strip, "upper": str.upper, "lower": str.lower,
    "capitalize": str.capitalize, "length": len, "string": str,
}

TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-<>+~|.,()\[\]=]))""")

COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


class TemplateError(ValueError):
    """The template isn't in the language."""


# Expressions are tuples: ("const", value), ("name", n), ("item", e, e), ("filter", f, e), ("op", name, *operands).

class _Expression:
    """A parser of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, *values: str) -> str | None:
        if (v := self.peek()) in values and v is not None:
            self.at += 1
            return v
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def whole(self) -> tuple:
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"not understood: {self.tokens[self.at][1]!r}")
        return out

    def either(self) -> tuple:
        out = self.both()
        while self.take("or"):
            out = ("op", "or", out, self.both())
        return out

    def both(self) -> tuple:
        out = self.negated()
        while self.take("and"):
            out = ("op", "and", out, self.negated())
        return out

    def negated(self) -> tuple:
        return ("op", "not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        out = self.summed()
        while sign := self.take(*COMPARE, "in"):
            out = ("op", sign, out, self.summed())
        return out

    def summed(self) -> tuple:
        out = self.filtered()
        while sign := self.take("+", "~"):
            out = ("op", sign, out, self.filtered())
        return out

    def filtered(self) -> tuple:
        out = self.single()
        while True:
            if self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = ("filter", name, out)
            elif self.take("."):
                out = ("item", out, ("const", self.name()))
            elif self.take("["):
                out = ("item", out, self.either())
                self.need("]")
            else:
                return out

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def single(self) -> tuple:
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return ("const", int(value))
        if kind == "name":
            constants = {"true": True, "false": False, "none": None}
            return ("const", constants[value.lower()]) if value.lower() in constants else ("name", value)
        raise TemplateError(f"not understood: {value!r}")


def parse(source: str) -> list[tuple]:
    """Statements: ("text", s), ("print", e), ("for", name, e, body), ("if", [(e, body)...]), ("set", name, e), ("generation", body)."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[list[tuple], str, str]:
        nonlocal at
        out: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                out.append(("print", _Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return out, word, rest
                if word == "for":
                    m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                    if not m:
                        raise TemplateError(f"not a loop: {rest!r}")
                    out.append(("for", m[1], _Expression(m[2]).whole(), block("endfor")[0]))
                elif word == "if":
                    branches, end, condition = [], "if", rest
                    while end != "endif":
                        own = ("const", True) if end == "else" else _Expression(condition).whole()
                        body, end, condition = block("endif") if end == "else" else block("elif", "else", "endif")
                        branches.append((own, body))
                    out.append(("if", branches))
                elif word == "set":
                    m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(.+)", rest, re.S)
                    if not m:
                        raise TemplateError(f"not an assignment: {rest!r}")
                    out.append(("set", m[1], _Expression(m[2]).whole()))
                elif word == "generation":
                    out.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"no statement {word!r} here")
            elif part:
                out.append(("text", part))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return out, "", ""

    return block()[0]


def fold_expression(e: tuple) -> tuple:
    if e[0] in ("const", "name"):
        return e
    parts = tuple(fold_expression(x) if isinstance(x, tuple) else x for x in e)
    if all(x[0] == "const" for x in parts[1:] if isinstance(x, tuple)):
        return ("const", _expression(parts)({}))
    return parts


def fold(statements: list[tuple]) -> list[tuple]:
    """The same template with constant expressions evaluated, dead branches gone and neighbouring texts joined."""
    out: list[tuple] = []

    def add(s: tuple) -> None:
        if s[0] == "text" and out and out[-1][0] == "text":
            s = ("text", out.pop()[1] + s[1])
        if s != ("text", ""):
            out.append(s)

    for s in statements:
        if s[0] == "print":
            e = fold_expression(s[1])
            add(("text", _written(e[1])) if e[0] == "const" else ("print", e))
        elif s[0] == "if":
            branches = []
            for condition, body in s[1]:
                e = fold_expression(condition)
                if e[0] == "const" and not e[1]:
                    continue
                branches.append((e, fold(body)))
                if e[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":
                for x in branches[0][1]:
                    add(x)
            elif branches:
                add(("if", branches))
        elif s[0] == "for":
            add(("for", s[1], fold_expression(s[2]), fold(s[3])))
        elif s[0] == "set":
            add(("set", s[1], fold_expression(s[2])))
        elif s[0] == "generation":
            add(("generation", fold(s[1])))
        else:
            add(s)
    return out


def _written(value: Any) -> str:
    return "" if value is None else str(value)


def _item(value: Any, key: Any) -> Any:
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (str, list)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _expression(e: tuple) -> Callable[[dict], Any]:
    """A closure from the names' values to the expression's value."""
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda names: value
    if kind == "name":
        name = e[1]
        return lambda names: names.get(name)
    if kind == "item":
        of, key = _expression(e[1]), _expression(e[2])
        return lambda names: _item(of(names), key(names))
    if kind == "filter":
        function, inner = FILTERS[e[1]], _expression(e[2])
        if e[1] == "length":
            return lambda names: function(inner(names) or "")
        return lambda names: function(_written(inner(names)))
    sign, operands = e[1], [_expression(x) for x in e[2:]]
    if sign == "not":
        return lambda names: not operands[0](names)
    a, b = operands
    if sign == "and":
        return lambda names: a(names) and b(names)
    if sign == "or":
        return lambda names: a(names) or b(names)
    if sign == "in":
        return lambda names: a(names) in (b(names) or ())
    if sign == "~":
        return lambda names: _written(a(names)) + _written(b(names))
    if sign == "+":
        return lambda names: a(names) + b(names)
    compare = COMPARE[sign]
    return lambda names: compare(a(names), b(names))


@dataclass
class Output:
    """Text not handed on yet and its masked spans; ``at`` counts code points from the conversation's start."""

    at: int = 0
    texts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.texts.append(text)
        self.at += len(text)

    def taken(self) -> tuple[str, list[tuple[int, int]]]:
        out = "".join(self.texts), self.spans
        self.texts, self.spans = [], []
        return out


def _statements(statements: list[tuple]) -> Callable[[dict, Output], Iterator[None]]:
    """A closure that writes the statements' output; it pauses after each turn of a loop outside of a mask."""
    parts = [_statement(s) for s in statements]

    def run(names: dict, out: Output) -> Iterator[None]:
        for part in parts:
            yield from part(names, out)

    return run


def _statement(s: tuple) -> Callable[[dict, Output], Iterator[None]]:
    kind = s[0]
    if kind in ("text", "print"):
        value = _expression(s[1] if kind == "print" else ("const", s[1]))

        def write(names: dict, out: Output) -> Iterator[None]:
            out.write(_written(value(names)))
            return iter(())

        return write
    if kind == "set":
        target, value = s[1], _expression(s[2])

        def assign(names: dict, out: Output) -> Iterator[None]:
            names[target] = value(names)
            return iter(())

        return assign
    if kind == "if":
        branches = [(_expression(c), _statements(b)) for c, b in s[1]]

        def choose(names: dict, out: Output) -> Iterator[None]:
            return next((body(names, out) for condition, body in branches if condition(names)), iter(()))

        return choose
    if kind == "generation":
        body = _statements(s[1])

        def masked(names: dict, out: Output) -> Iterator[None]:
            start = out.at
            for _ in body(names, out):
                pass  # a mask is handed on whole
            out.spans.append((start, out.at))
            return iter(())

        return masked
    target, source, body = s[1], _expression(s[2]), _statements(s[3])

    def loop(names: dict, out: Output) -> Iterator[None]:
        items, index = iter(source(names) or ()), 0
        item = next(items, _END)
        while item is not _END:
            following = next(items, _END)
            inner = {**names, target: item, "loop": {"index0": index, "index": index + 1, "first": index == 0, "last": following is _END}}
            yield from body(inner, out)
            yield
            item, index = following, index + 1

    return loop


_END = object()


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self._run = _statements(self.tree)

    def parts(self, messages: Iterable[dict], **names: Any) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """The output in parts, each with its masked spans counted from the output's start."""
        out = Output()
        for _ in self._run({**names, "messages": messages}, out):
            yield out.taken()
        if out.texts:
            yield out.taken()

    def render(self, messages: Iterable[dict], **names: Any) -> tuple[str, list[tuple[int, int]]]:
        parts = list(self.parts(messages, **names))
        return "".join(t for t, _ in parts), [s for _, spans in parts for s in spans]


TURN_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)


def read_turns(parts: Iterable[tuple[str, list[tuple[int, int]]]]) -> Iterator[tuple[str, str, str, int]]:
    """Roles, texts, texts under the mask, and lengths of the turns in the production template's output."""
    begun = 0
    for text, spans in parts:
        at, marks = 0, iter(spans)
        span = next(marks, None)
        while at < len(text):
            head = TURN_HEAD.match(text, at)
            end = _end_of_text(text, head.end()) if head else -1
            if end < 0:
                raise ValueError("not a turn of this template")
            to, masked = end + len("</turn>\n"), ""
            while span and span[0] < begun + to:
                masked += unescape(text[span[0] - begun:span[1] - begun])
                span = next(marks, None)
            yield unescape(head[1]), unescape(text[head.end():end]), masked, to - at
            at = to
        begun += len(text)


def _end_of_text(text: str, at: int) -> int:
    """The place of the first end mark that no backslash escapes."""
    while (end := text.find("</turn>", at)) >= 0:
        slashes = end
        while slashes > at and text[slashes - 1] == "\\":
            slashes -= 1
        if (end - slashes) % 2 == 0:
            return end
        at = end + 1
    return -1


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows dealt by conversation, in order of turn."""
    rows = bytesets.only(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Each conversation of sorted rows with its messages, read as they are asked for."""
    from itertools import groupby

    def rows() -> Iterator[tuple[int | None, dict]]:
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                yield conv, {"role": role or "", "text": text or ""}

    for conv, group in groupby(rows(), key=lambda r: r[0]):
        yield conv, (message for _, message in group)


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, text, mask): the output of each conversation in consecutive parts of about a million
    characters, with the masked spans (start, end) counted in code points from the conversation's start."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Template(template)
        for conv, messages in _conversations(batches):
            for number, (text, spans) in enumerate(_gathered(own.parts(messages))):
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": conv, "part": number, "text": text, "mask": [list(s) for s in spans]}], schema=pa.schema([
                        ("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("mask", pa.list_(pa.list_(pa.int64())))]))

    return bytesets.map_arrow(ordered_turns(conversations), render, "conv_id long, part int, text string, mask array<array<bigint>>")


def _gathered(parts: Iterator[tuple[str, list]], least: int = 1_000_000) -> Iterator[tuple[str, list]]:
    texts, spans, size = [], [], 0
    for text, own in parts:
        texts.append(text)
        spans += own
        size += len(text)
        if size >= least:
            yield "".join(texts), spans
            texts, spans, size = [], [], 0
    if texts:
        yield "".join(texts), spans


#: The conversation that holds the template's own signs. Fixed values.
CONTROL_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def with_control(conversations: DataFrame) -> DataFrame:
    """The conversations and the one of ``CONTROL_TURNS``."""
    rows = bytesets.only(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    literal = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(rows.columns, r, strict=True)]) for r in CONTROL_TURNS])
    return rows.unionByName(conversations.sparkSession.range(1).select(F.inline(literal)))


def report(conversations: DataFrame) -> DataFrame:
    """Per conversation, read back from its output: turns, their digest, the text under the mask, all characters."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Template(TEMPLATE)
        rows: list[tuple] = []
        for conv, messages in _conversations(batches):
            turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, text, masked, length in read_turns(own.parts(messages)):
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(masked.encode())
                n, loss_chars, chars = n + 1, loss_chars + len(masked), chars + length
            rows.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(rows) >= 1000:
                yield _batch(rows, names)
                rows = []
        if rows:
            yield _batch(rows, names)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return bytesets.map_arrow(ordered_turns(with_control(conversations)), digests, kinds)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
