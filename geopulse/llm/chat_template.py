"""Chat formatting: a template compiler for conversations of any length.

A sandboxed template language (no attribute access beyond the named values, no
calls but the listed filters) is parsed into a syntax tree; constants are folded
(filters of literals, branches with constant tests, adjacent text) and the tree
becomes Python closures.  A closure yields ``(text, in_generation)`` parts
lazily and takes messages from an iterator, so a conversation is rendered while
its turns stream by and a giant one needs no more memory than its longest turn.

    {{ expr }}                              a value; filters: escape, role, upper, lower, trim
    {% for m in messages %} ... {% endfor %}
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   marks what a model learns to produce
    {# comment #}
    expr: 'text', m.role, m.text, m.index, ==, !=, and, or, not, ( ), expr | filter

Texts can't forge control strings: ``escape`` writes a backslash as two and
breaks each control string with ``\\|``; :func:`unescape` undoes it.

Defined results: null texts and roles are empty; turns with equal numbers are
ordered by role and text; a null conversation key is a conversation of its own;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import parallelism

HEAD, TAIL = "###", "</turn>"
#: One block for each turn; only the assistant's text is learned.
DEFAULT_TEMPLATE = (
    "{% for m in messages %}" + HEAD + " {{ m.role | role }}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}" + TAIL + "\n{% endfor %}")


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</", "<\\|/")
    return re.sub("#(?=##)", r"#\\|", text)


_CODES = {"\\": "\\", "|": "", "n": "\n"}


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _CODES[m[1]], text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "role": lambda s: escape(s).replace("\n", "\\n"),
    "upper": str.upper, "lower": str.lower, "trim": str.strip,
}
_FIELDS = ("role", "text", "index")
_TOKEN = re.compile(r"\s*(?:'((?:[^'\\]|\\.)*)'|(==|!=|[()|.])|([A-Za-z_]\w*))")
_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.DOTALL)


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent over one expression; nodes are tuples."""

    def __init__(self, source: str, names: tuple[str, ...]):
        self.tokens, self.names, at = [], names, 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            text, mark, name = m.groups()
            self.tokens.append(("text", re.sub(r"\\(.)", lambda x: {"n": "\n"}.get(x[1], x[1]), text)) if text is not None
                               else ("mark", mark) if mark else ("name", name))
            at = m.end()

    def parse(self) -> tuple:
        tree = self._either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def _take(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0][0] != "text" and self.tokens[0][1] in wanted:
            return self.tokens.pop(0)[1]
        return None

    def _either(self) -> tuple:
        tree = self._both()
        while self._take("or"):
            tree = fold(("or", tree, self._both()))
        return tree

    def _both(self) -> tuple:
        tree = self._negated()
        while self._take("and"):
            tree = fold(("and", tree, self._negated()))
        return tree

    def _negated(self) -> tuple:
        return fold(("not", self._negated())) if self._take("not") else self._compared()

    def _compared(self) -> tuple:
        tree = self._filtered()
        if op := self._take("==", "!="):
            tree = fold((op, tree, self._filtered()))
        return tree

    def _filtered(self) -> tuple:
        tree = self._value()
        while self._take("|"):
            name = self.tokens.pop(0)[1] if self.tokens else ""
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = fold(("filter", name, tree))
        return tree

    def _value(self) -> tuple:
        if self._take("("):
            tree = self._either()
            if not self._take(")"):
                raise TemplateError("missing )")
            return tree
        kind, value = self.tokens.pop(0) if self.tokens else ("end", "")
        if kind == "text":
            return ("text", value)
        if kind == "name" and value in self.names:
            if self._take(".") and self.tokens and self.tokens[0][1] in _FIELDS:
                return ("field", self.tokens.pop(0)[1])
        raise TemplateError(f"unknown value {value!r}")


_APPLY = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b,
          "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node: tuple) -> tuple:
    """The node with constant parts computed."""
    kind = node[0]
    if kind == "filter" and node[2][0] == "text":
        return ("text", FILTERS[node[1]](node[2][1]))
    if kind == "not" and node[1][0] == "text":
        return ("text", "" if node[1][1] else "1")
    if kind in _APPLY and node[1][0] == node[2][0] == "text":
        value = _APPLY[kind](node[1][1], node[2][1])
        return ("text", value if isinstance(value, str) else "1" if value else "")
    return node


def parse(source: str) -> list[tuple]:
    """Syntax tree of a template."""
    parts = [p for p in _TAG.split(source) if p and not p.startswith("{#")]
    tree = _block(parts, (), ())
    if parts:
        raise TemplateError(f"unexpected {parts[0]!r}")
    return tree


def _tag(part: str) -> list[str]:
    return part[2:-2].split(None, 1) if part.startswith("{%") else []


def _block(parts: list[str], ends: tuple[str, ...], names: tuple[str, ...]) -> list[tuple]:
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    while parts:
        tag = _tag(parts[0])
        if tag and tag[0] in ends:
            return out
        part = parts.pop(0)
        if part.startswith("{{"):
            add(_Expression(part[2:-2], names).parse())
        elif not tag:
            add(("text", part))
        elif tag[0] == "for":
            m = re.fullmatch(r"(\w+) in messages\s*", tag[1] if len(tag) > 1 else "")
            if not m:
                raise TemplateError(f"only 'for x in messages' is known, not {part!r}")
            add(("for", _closed(parts, "endfor", (*names, m[1]))))
        elif tag[0] == "generation":
            add(("generation", _closed(parts, "endgeneration", names)))
        elif tag[0] == "if":
            for node in _branches(parts, tag, names):
                add(node)
        else:
            raise TemplateError(f"unknown tag {part!r}")
    if ends:
        raise TemplateError(f"missing {ends[0]}")
    return out


def _closed(parts: list[str], end: str, names: tuple[str, ...]) -> list[tuple]:
    body = _block(parts, (end,), names)
    parts.pop(0)
    return body


def _branches(parts: list[str], tag: list[str], names: tuple[str, ...]) -> list[tuple]:
    test = _Expression(tag[1] if len(tag) > 1 else "", names).parse()
    then = _block(parts, ("elif", "else", "endif"), names)
    following = _tag(parts.pop(0))
    if following[0] == "elif":
        otherwise = _branches(parts, following, names)
    else:
        otherwise = _closed(parts, "endif", names) if following[0] == "else" else []
    if test[0] == "text":
        return then if test[1] else otherwise
    return [("if", test, then, otherwise)]


Part = tuple[str, bool]


def _value(node: tuple) -> Callable[[dict], str]:
    kind = node[0]
    if kind == "text":
        return lambda m: node[1]
    if kind == "field":
        return lambda m: m[node[1]]
    if kind == "filter":
        apply, inner = FILTERS[node[1]], _value(node[2])
        return lambda m: apply(inner(m))
    if kind == "not":
        inner = _value(node[1])
        return lambda m: "" if inner(m) else "1"
    first, second = _value(node[1]), _value(node[2])
    if kind == "and":
        return lambda m: first(m) and second(m)
    if kind == "or":
        return lambda m: first(m) or second(m)
    compare = _APPLY[kind]
    return lambda m: "1" if compare(first(m), second(m)) else ""


def _closure(tree: list[tuple]) -> Callable[[Iterator[dict], dict, bool], Iterator[Part]]:
    steps = []
    for node in tree:
        if node[0] == "for":
            def step(messages, m, gen, body=_closure(node[1])):
                for own in messages:
                    yield from body(messages, own, gen)
        elif node[0] == "generation":
            def step(messages, m, gen, body=_closure(node[1])):
                yield from body(messages, m, True)
        elif node[0] == "if":
            def step(messages, m, gen, test=_value(node[1]), yes=_closure(node[2]), no=_closure(node[3])):
                yield from (yes if test(m) else no)(messages, m, gen)
        else:
            def step(messages, m, gen, value=_value(node)):
                yield value(m), gen
        steps.append(step)

    def run(messages: Iterator[dict], m: dict, gen: bool) -> Iterator[Part]:
        for step in steps:
            yield from step(messages, m, gen)

    return run


def compile_template(source: str) -> Callable[[Iterator[dict]], Iterator[Part]]:
    """A function from an iterator of messages (role, text, index) to the rendered parts."""
    body = _closure(parse(source))
    return lambda messages: body(messages, {}, False)


_ROWS = 1000


def format_conversations(df: DataFrame, template: str = DEFAULT_TEMPLATE, conv: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rendered conversations as parts: (conv_id, part, content, learned, last).

    Parts of a conversation are numbered, stand in one partition and in order; their
    contents joined are its formatted text, ``learned`` is the loss mask.
    """
    parse(template)
    rows = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition(parallelism(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True)

        source, out = stream(), []
        ahead = next(source, None)

        def messages(own: int | None) -> Iterator[dict]:
            nonlocal ahead
            index = 0
            while ahead is not None and ahead[0] == own:
                message = {"role": ahead[1], "text": ahead[2], "index": str(index)}
                ahead, index = next(source, None), index + 1
                yield message

        while ahead is not None:
            conv_id, taken, size = ahead[0], messages(ahead[0]), 0
            number = 0
            for content, learned in render(taken):
                out.append((conv_id, number, content, learned, False))
                number += 1
                size += len(content)
                if len(out) >= _ROWS or size > 1 << 20:
                    yield _parts(out)
                    out, size = [], 0
            for _ in taken:  # a template without a loop over the messages
                pass
            out.append((conv_id, number, "", False, True))
        if out:
            yield _parts(out)

    return rows.mapInArrow(run, "conv_id long, part long, content string, learned boolean, last boolean")


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["conv_id", "part", "content", "learned", "last"])


_TURN = re.compile(re.escape(HEAD) + r" (.*?):\n(.*?)" + re.escape(TAIL) + r"\n", re.DOTALL)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests read from the formatted text of :data:`DEFAULT_TEMPLATE` alone, in one pass.

    Takes the parts as :func:`format_conversations` leaves them (no shuffle between).
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        def fresh() -> dict:
            return {"buffer": "", "turns": 0, "sha": hashlib.sha256(), "loss": hashlib.sha256(), "learned": 0, "chars": 0}

        state, out = fresh(), []
        for batch in batches:
            for conv_id, _, content, learned, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state["chars"] += len(content)
                state["buffer"] += content
                if learned:
                    plain = unescape(content)
                    state["learned"] += len(plain)
                    state["loss"].update(plain.encode())
                if content.endswith(TAIL + "\n") or last:
                    for m in _TURN.finditer(state["buffer"]):
                        state["turns"] += 1
                        state["sha"].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    rest = _TURN.sub("", state["buffer"])
                    state["buffer"] = rest
                if last:
                    if state["buffer"]:
                        raise ValueError(f"conversation {conv_id}: {state['buffer'][:80]!r} is no turn")
                    out.append((conv_id, state["turns"], state["sha"].hexdigest(), state["learned"], state["loss"].hexdigest(), state["chars"]))
                    state = fresh()
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out = []

    return parts.mapInArrow(run, schema)
