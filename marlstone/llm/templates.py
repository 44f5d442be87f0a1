"""A small, sandboxed template language for conversations, compiled to Python closures.

    text            stands as it is; `{%-` and `-%}` (`{{-`, `-}}`) take away the white space before and behind
    {{ expr }}      the value of an expression, as text (null: empty)
    {% for x in messages %} ... {% endfor %}      once a turn; one loop, not inside a condition
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      what a model is to learn: its place in the output is recorded
    {# ... #}       a comment

Expressions: 'text', numbers, true, false, none, x.role and x.text of the turn, loop.first, loop.last, loop.index0, the
constants given to `compile_template`, ~ (joins texts), == != < <= > >=, in, and, or, not, brackets, and filters: upper,
lower, trim, escape. There is nothing else: no calls, no attributes of Python objects, no loops but over the turns, so a
template can't reach anything, and ends. Other names and forms are errors of compilation.

The syntax tree is folded before closures are made of it: expressions of constants become constants, conditions that
are constant lose their other branches, and neighbouring constant texts are joined.

`escape` makes control strings in a text harmless and can be undone: behind the first character of a control string
(and of what it was turned into already) comes one backslash more. Other texts are not changed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

TAG = re.compile(r"(\{\{-?|\{%-?|\{#)(.*?)(-?\}\}|-?%\}|#\})", re.S)
TOKEN = re.compile(r"\s*(?:(?P<text>'[^']*'|\"[^\"]*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[<>~|().]))")
PAIRS = {"{{": "}}", "{%": "%}", "{#": "#}"}
FIELDS = {"role", "text"}
LOOP = {"first", "last", "index0"}


class TemplateError(ValueError):
    pass


@dataclass
class Turn:
    """What a template sees of a turn."""

    role: str
    text: str
    first: bool
    last: bool
    index0: int


@dataclass
class Output:
    """Pieces of the text, its length so far in code points, and the spans to learn."""

    pieces: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)


# Nodes of the syntax tree: ("const", value), ("get", name), ("call", function, nodes), ("text", node),
# ("if", [(node, body)]), ("generation", body), ("for", body); a body is a list of nodes.


def shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def escaper(controls: tuple[str, ...]) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """(escape, its inverse) for these control strings, of two characters at least and without backslashes."""
    if any(len(c) < 2 or "\\" in c for c in controls):
        raise TemplateError("control strings have two characters at least and no backslash")
    tails = {c[0]: [] for c in controls}
    for c in sorted(controls, key=len, reverse=True):
        tails[c[0]].append(re.escape(c[1:]))
    inner = "|".join(rf"{re.escape(a)}(?=\\*(?:{'|'.join(z)}))" for a, z in tails.items())
    outer = "|".join(rf"({re.escape(a)})\\(?=\\*(?:{'|'.join(z)}))" for a, z in tails.items())
    put, take = re.compile(inner), re.compile(outer)
    return lambda s: put.sub(lambda m: m.group() + "\\", s), lambda s: take.sub(lambda m: m.group()[0], s)


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "~": lambda a, b: shown(a) + shown(b),
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
}
#: Operators from the loosest on.
LEVELS = (("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~",))


class Expression:
    """A parser of one expression by descent through LEVELS."""

    def __init__(self, source: str, variable: str | None, constants: dict[str, Any], filters: dict[str, Callable]):
        self.variable, self.constants, self.filters, self.tokens, at = variable, constants, filters, [], 0
        source = source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()

    def whole(self):
        node = self.level(0)
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return node

    def next_is(self, *values: str) -> str | None:
        if self.tokens and self.tokens[0][0] in ("sign", "name") and self.tokens[0][1] in values:
            return self.tokens.pop(0)[1]
        return None

    def level(self, k: int):
        if k == len(LEVELS):
            return self.filtered()
        if k == 2 and self.next_is("not"):
            return ("call", OPERATORS["not"], [self.level(k)])
        node = self.level(k + 1)
        while sign := self.next_is(*LEVELS[k]):
            node = ("call", OPERATORS[sign], [node, self.level(k + 1)])
        return node

    def filtered(self):
        node = self.atom()
        while self.next_is("|"):
            kind, name = self.tokens.pop(0) if self.tokens else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = ("call", self.filters[name], [node])
        return node

    def atom(self):
        if not self.tokens:
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens.pop(0)
        if kind == "text":
            return ("const", value[1:-1])
        if kind == "number":
            return ("const", int(value))
        if value == "(":
            node = self.level(0)
            if not self.next_is(")"):
                raise TemplateError("a bracket is not closed")
            return node
        if kind == "name" and value in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[value])
        if kind == "name" and self.next_is("."):
            _, part = self.tokens.pop(0) if self.tokens else ("", "")
            if self.variable and (value == self.variable and part in FIELDS or value == "loop" and part in LOOP):
                return ("get", part)
            raise TemplateError(f"no {value}.{part}")
        if kind == "name" and value in self.constants:
            return ("const", self.constants[value])
        raise TemplateError(f"unknown {value!r}")


def parse(source: str, constants: dict[str, Any], filters: dict[str, Callable]) -> list:
    """The syntax tree of a template."""
    parts, at, strip = [], 0, False
    for m in TAG.finditer(source):
        text, open_, close = source[at : m.start()], m.group(1), m.group(3)
        if PAIRS[open_.rstrip("-")] != close.lstrip("-"):
            raise TemplateError(f"{open_} is closed by {close}")
        text = text.lstrip() if strip else text
        parts.append(("raw", text.rstrip() if open_.endswith("-") else text))
        strip, at = close.startswith("-"), m.end()
        if not open_.startswith("{#"):
            parts.append((open_[:2], m.group(2).strip()))
    parts.append(("raw", source[at:].lstrip() if strip else source[at:]))
    for kind, text in parts:
        if kind == "raw" and any(sign in text for sign in PAIRS):
            raise TemplateError(f"a tag is not closed: {text[:40]!r}")
    variable: str | None = None
    expression = lambda s: Expression(s, variable, constants, filters).whole()

    def body(ends: tuple[str, ...], depth: int, learning: bool) -> tuple[list, str]:
        nonlocal variable
        nodes: list = []
        while parts:
            kind, value = parts.pop(0)
            if kind == "raw":
                if value:
                    nodes.append(("text", ("const", value)))
                continue
            if kind == "{{":
                nodes.append(("text", expression(value)))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return nodes, value
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
                if not m or depth:
                    raise TemplateError("one loop over messages, outside of conditions, is all there is")
                if any(n[0] == "for" for n in nodes):
                    raise TemplateError("a template has one loop")
                variable = m.group(1)
                inner, _ = body(("endfor",), depth + 1, learning)
                variable = None
                nodes.append(("for", inner))
            elif word == "if":
                branches, tag = [], value
                while not tag.startswith("endif"):
                    head, _, test = tag.partition(" ")
                    wanted = ("const", True) if head == "else" else expression(test)
                    inner, tag = body(("endif",) if head == "else" else ("elif", "else", "endif"), depth + 1, learning)
                    branches.append((wanted, inner))
                nodes.append(("if", branches))
            elif word == "generation":
                if learning:
                    raise TemplateError("generation inside generation")
                inner, _ = body(("endgeneration",), depth + 1, True)
                nodes.append(("generation", inner))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return nodes, ""

    return body((), 0, False)[0]


def fold(node):
    """The same expression, with what is constant computed."""
    if node[0] != "call":
        return node
    args = [fold(a) for a in node[2]]
    if all(a[0] == "const" for a in args):
        try:
            return ("const", node[1](*(a[1] for a in args)))
        except TypeError as e:
            raise TemplateError(str(e)) from e
    return ("call", node[1], args)


def fold_body(nodes: list) -> list:
    """The same body: constant texts joined, constant conditions decided, empty parts left out."""
    out: list = []

    def put(node) -> None:
        if node[0] == "text" and node[1][0] == "const":
            text = shown(node[1][1])
            if out and out[-1][0] == "text" and out[-1][1][0] == "const":
                out[-1] = ("text", ("const", out[-1][1][1] + text))
            elif text:
                out.append(("text", ("const", text)))
        else:
            out.append(node)

    for node in nodes:
        if node[0] == "text":
            put(("text", fold(node[1])))
        elif node[0] == "if":
            branches = []
            for test, inner in node[1]:
                test = fold(test)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold_body(inner)))
                if test[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":
                for inner in branches[0][1]:
                    put(inner)
            elif branches:
                out.append(("if", branches))
        else:
            out.append((node[0], fold_body(node[1])))
    return out


def closure(node) -> Callable[[Turn | None], Any]:
    if node[0] == "const":
        value = node[1]
        return lambda turn: value
    if node[0] == "get":
        name = node[1]
        return lambda turn: getattr(turn, name)
    f, args = node[1], [closure(a) for a in node[2]]
    if len(args) == 1:
        (one,) = args
        return lambda turn: f(one(turn))
    one, two = args
    if f is OPERATORS["and"]:
        return lambda turn: one(turn) and two(turn)
    if f is OPERATORS["or"]:
        return lambda turn: one(turn) or two(turn)
    return lambda turn: f(one(turn), two(turn))


def body_closure(nodes: list) -> Callable[[Turn | None, Output], None]:
    steps = [step(n) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(turn: Turn | None, out: Output) -> None:
        for s in steps:
            s(turn, out)

    return run


def step(node) -> Callable[[Turn | None, Output], None]:
    if node[0] == "text" and node[1][0] == "const":
        text = node[1][1]
        return lambda turn, out: out.add(text)
    if node[0] == "text":
        value = closure(node[1])
        return lambda turn, out: out.add(shown(value(turn)))
    if node[0] == "if":
        branches = [(closure(test), body_closure(inner)) for test, inner in node[1]]

        def choose(turn: Turn | None, out: Output) -> None:
            for test, inner in branches:
                if test(turn):
                    inner(turn, out)
                    return

        return choose
    inner = body_closure(node[1])

    def learn(turn: Turn | None, out: Output) -> None:
        begin = out.size
        inner(turn, out)
        if out.size > begin:
            out.spans.append((begin, out.size))

    return learn


@dataclass
class Template:
    """Closures for what stands before the loop, one turn, and what stands behind the loop; and the folded tree."""

    before: Callable[[None, Output], None]
    turn: Callable[[Turn, Output], None]
    after: Callable[[None, Output], None]
    tree: list


def compile_template(source: str, constants: dict[str, Any] | None = None, controls: tuple[str, ...] = ()) -> Template:
    escape = escaper(controls)[0] if controls else lambda s: s
    filters = {"upper": lambda v: shown(v).upper(), "lower": lambda v: shown(v).lower(), "trim": lambda v: shown(v).strip(), "escape": lambda v: escape(shown(v))}
    tree = fold_body(parse(source, constants or {}, filters))
    loop = next((k for k, n in enumerate(tree) if n[0] == "for"), len(tree))
    inner = tree[loop][1] if loop < len(tree) else []
    return Template(body_closure(tree[:loop]), body_closure(inner), body_closure(tree[loop + 1 :]), tree)
