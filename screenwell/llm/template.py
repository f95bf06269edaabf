"""A small sandboxed template language for chat texts, compiled to closures.

    {{ expression }}   {# remark #}   {% set name = expression %}
    {% if a %} .. {% elif b %} .. {% else %} .. {% endif %}
    {% for turn in turns %} .. {% endfor %}
    {% generation %} .. {% endgeneration %}

A dash inside a tag ({%- -%}) takes away the white space beside it. Expressions have strings, numbers,
lists, true, false, none, names, ``.name`` and ``[key]``, ``| filter(..)``, ``~ + - * // %``,
comparisons, ``in``, ``not``, ``and``, ``or`` and ``a if b else c``. There are no calls: values are
strings, numbers, lists and dicts, a dot looks up a key (missing: none), only numbers multiply, and
filters come from a fixed table. ``turns`` is a stream that one loop at the top level reads, so a
conversation never has to fit into memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

TAG = re.compile(r"(\{\{-?|\{%-?|\{#)(.*?)(-?\}\}|-?%\}|#\})", re.S)
LEX = re.compile(r"\s*(?:(?P<num>\d+\.\d+|\d+)|(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")"
                 r"|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|//|[-+*%~<>()\[\],.|=]))", re.S)
PLAIN = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}
STREAM = "turns"
NUMBER_LIMIT = 1 << 63


class TemplateError(ValueError):
    """A template that does not parse or uses what the sandbox lacks."""


# ---- syntax tree: tuples (kind, ...) --------------------------------------------------------------

def lexed(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        found = LEX.match(source, at)
        if not found:
            raise TemplateError(f"unexpected {source[at:at + 10]!r}")
        out.append((found.lastgroup, found.group(found.lastgroup)))
        at = found.end()
    return out


class Expressions:
    """Recursive descent over the tokens of one expression."""

    LEVELS = [("or",), ("and",)]

    def __init__(self, source: str):
        self.tokens, self.at = lexed(source), 0

    def peek(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, text = self.tokens[self.at]
            if kind != "str" and text in wanted:
                return text
        return None

    def take(self, *wanted: str) -> str | None:
        found = self.peek(*wanted)
        self.at += found is not None
        return found

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name" and self.tokens[self.at][1] not in WORDS:
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("name expected")

    def whole(self):
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self):
        node = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return ("choice", test, node, self.choice())
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("op", "not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        node = self.added()
        while True:
            if op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
                node = ("op", op, node, self.added())
            elif self.peek("not") and self.tokens[self.at + 1:self.at + 2] == [("name", "in")]:
                self.at += 2
                node = ("op", "not", ("op", "in", node, self.added()))
            else:
                return node

    def added(self):
        node = self.multiplied()
        while op := self.take("+", "-", "~"):
            node = ("op", op, node, self.multiplied())
        return node

    def multiplied(self):
        node = self.signed()
        while op := self.take("*", "//", "%"):
            node = ("op", op, node, self.signed())
        return node

    def signed(self):
        return ("op", "minus", self.signed()) if self.take("-") else self.followed()

    def followed(self):
        node = self.single()
        while True:
            if self.take("."):
                node = ("op", "get", node, ("const", self.name()))
            elif self.take("["):
                node = ("op", "get", node, self.choice())
                self.need("]")
            elif self.take("|"):
                name, args = self.name(), []
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        if not self.peek(")"):
                            self.need(",")
                node = ("filter", name, node, *args)
            else:
                return node

    def single(self):
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.take("["):
            items = []
            while not self.take("]"):
                items.append(self.choice())
                if not self.peek("]"):
                    self.need(",")
            return ("list", *items)
        if word := self.take("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[word])
        if self.at == len(self.tokens):
            raise TemplateError("expression expected")
        kind, text = self.tokens[self.at]
        if kind == "str":
            self.at += 1
            return ("const", re.sub(r"\\(.)", lambda m: PLAIN.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "num":
            self.at += 1
            return ("const", float(text) if "." in text else int(text))
        return ("name", self.name())


def parse(source: str) -> list:
    """The statements of a template as a tree."""
    parts, at, trim = [], 0, False
    for tag in TAG.finditer(source):
        text = source[at:tag.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if tag[1].endswith("-") else text))
        opened, closed = tag[1][:2], tag[3][-2:]
        if closed != {"{{": "}}", "{%": "%}", "{#": "#}"}[opened]:
            raise TemplateError(f"{opened} closed by {closed}")
        parts.append((opened, tag[2].strip()))
        at, trim = tag.end(), tag[3].startswith("-")
    rest = source[at:]
    parts.append(("text", rest.lstrip() if trim else rest))
    body, left = statements(parts, 0, ())
    return body


def statements(parts: list, at: int, until: tuple) -> tuple[list, int]:
    out = []
    while at < len(parts):
        kind, text = parts[at]
        at += 1
        if kind == "text":
            out.append(("text", text))
        elif kind == "{{":
            out.append(("print", Expressions(text).whole()))
        elif kind == "{%":
            word, _, rest = text.partition(" ")
            if word in until:
                return out, at - 1
            node, at = statement(word, rest, parts, at)
            out.append(node)
    if until:
        raise TemplateError(f"{until[-1]} missing")
    return out, at


def statement(word: str, rest: str, parts: list, at: int) -> tuple[tuple, int]:
    if word == "if":
        branches, last = [], Expressions(rest).whole()
        while True:
            body, at = statements(parts, at, ("elif", "else", "endif") if last is not None else ("endif",))
            branches.append((("const", True) if last is None else last, body))
            word, _, rest = parts[at][1].partition(" ")
            at += 1
            if word == "endif":
                return ("if", branches), at
            last = Expressions(rest).whole() if word == "elif" else None
    if word == "for":
        head = Expressions(rest)
        name = head.name()
        head.need("in")
        items = head.whole()
        body, at = statements(parts, at, ("endfor",))
        return ("for", name, items, body), at + 1
    if word == "generation":
        body, at = statements(parts, at, ("endgeneration",))
        return ("generation", body), at + 1
    if word == "set":
        head = Expressions(rest)
        name = head.name()
        head.need("=")
        return ("set", name, head.whole()), at
    raise TemplateError(f"unknown statement {word!r}")


# ---- values --------------------------------------------------------------------------------------

def shown(value) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def number(value):
    if isinstance(value, bool) or not isinstance(value, int | float) or abs(value) >= NUMBER_LIMIT:
        raise TemplateError(f"not a number within 64 bits: {str(value)[:40]!r}")
    return value


def looked_up(value, key):
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, list | str) and isinstance(key, int) and -len(value) <= key < len(value):
        return value[key]
    return None


OPERATORS: dict[str, Callable] = {
    "not": lambda a: not a, "minus": lambda a: -number(a), "~": lambda a, b: shown(a) + shown(b),
    "+": lambda a, b: a + b if isinstance(a, str) and isinstance(b, str) else number(number(a) + number(b)),
    "-": lambda a, b: number(number(a) - number(b)), "*": lambda a, b: number(number(a) * number(b)),
    "//": lambda a, b: number(a) // number(b) if b else None, "%": lambda a, b: number(a) % number(b) if b else None,
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: shown(a) in b if isinstance(b, str) else a in (b or []), "get": looked_up,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: shown(v).strip(), "upper": lambda v: shown(v).upper(), "lower": lambda v: shown(v).lower(),
    "length": lambda v: len(v) if isinstance(v, str | list | dict) else 0,
    "default": lambda v, other: other if v is None else v,
    "replace": lambda v, old, new: shown(v).replace(shown(old), shown(new)) if old else shown(v),
}


def folded(node: tuple, known: dict, filters: dict):
    """The expression with everything that needs no turn worked out."""
    kind = node[0]
    if kind == "const":
        return node
    if kind == "name":
        return ("const", known[node[1]]) if node[1] in known else node
    if kind in ("and", "or"):
        one, two = folded(node[1], known, filters), folded(node[2], known, filters)
        if one[0] == "const":
            return two if bool(one[1]) == (kind == "and") else one
        return (kind, one, two)
    if kind == "choice":
        test, yes, no = (folded(n, known, filters) for n in node[1:])
        return (yes if test[1] else no) if test[0] == "const" else ("choice", test, yes, no)
    head = 1 if kind == "list" else 2
    args = [folded(n, known, filters) for n in node[head:]]
    if kind == "filter" and node[1] not in filters:
        raise TemplateError(f"unknown filter {node[1]!r}")
    if all(a[0] == "const" for a in args):
        values = [a[1] for a in args]
        try:
            return ("const", values if kind == "list" else (OPERATORS if kind == "op" else filters)[node[1]](*values))
        except TypeError as error:
            raise TemplateError(str(error)) from error
    return (*node[:head], *args)


def pruned(body: list, known: dict, filters: dict) -> list:
    """Statements with folded expressions, decided branches and joined texts."""
    out: list = []

    def add(text: str) -> None:
        if out and out[-1][0] == "text":
            text = out.pop()[1] + text
        if text:
            out.append(("text", text))

    for node in body:
        kind = node[0]
        if kind == "text":
            add(node[1])
        elif kind == "print":
            value = folded(node[1], known, filters)
            if value[0] == "const":
                add(shown(value[1]))
            else:
                out.append(("print", value))
        elif kind == "set":
            known = {k: v for k, v in known.items() if k != node[1]}
            out.append(("set", node[1], folded(node[2], known, filters)))
        elif kind == "if":
            known = {k: v for k, v in known.items() if k not in assigned([node])}
            branches = []
            for test, inner in node[1]:
                test = folded(test, known, filters)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, pruned(inner, known, filters)))
                if test[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":
                for inner in branches[0][1]:
                    add(inner[1]) if inner[0] == "text" else out.append(inner)
            elif branches:
                out.append(("if", branches))
        elif kind == "for":
            inside = {k: v for k, v in known.items() if k not in assigned([node])}
            out.append(("for", node[1], folded(node[2], known, filters), pruned(node[3], inside, filters)))
            known = inside
        else:
            out.append(("generation", pruned(node[1], known, filters)))
    return out


def assigned(body: list) -> set:
    """Names that statements set."""
    out: set = set()
    for node in body:
        if node[0] == "set":
            out.add(node[1])
        elif node[0] == "for":
            out |= {node[1], "loop"} | assigned(node[3])
        elif node[0] == "if":
            out |= set().union(*(assigned(inner) for _, inner in node[1]))
        elif node[0] == "generation":
            out |= assigned(node[1])
    return out


# ---- closures ------------------------------------------------------------------------------------

@dataclass
class Sink:
    """Rendered text with the spans of its generated parts, in code points."""

    parts: list = field(default_factory=list)
    size: int = 0
    spans: list = field(default_factory=list)
    depth: int = 0
    began: int = 0

    def text(self, value: str) -> None:
        self.parts.append(value)
        self.size += len(value)

    def open(self) -> None:
        if not self.depth:
            self.began = self.size
        self.depth += 1

    def close(self) -> None:
        self.depth -= 1
        if not self.depth and self.size > self.began:
            self.spans.append((self.began, self.size))

    def flush(self) -> tuple[str, list]:
        if self.depth and self.size > self.began:
            self.spans.append((self.began, self.size))
        out = "".join(self.parts), self.spans
        self.parts, self.spans, self.size, self.began = [], [], 0, 0
        return out


def value_of(node: tuple, filters: dict, names: frozenset) -> Callable[[dict], object]:
    """A closure that works an expression out."""
    kind = node[0]
    if kind == "const":
        return lambda env, value=node[1]: value
    if kind == "name":
        if node[1] not in names:
            raise TemplateError(f"unknown name {node[1]!r}")
        return lambda env, name=node[1]: env.get(name)
    inner = [value_of(n, filters, names) for n in node[1 if kind in ("and", "or", "choice", "list") else 2:]]
    if kind == "list":
        return lambda env: [f(env) for f in inner]
    if kind in ("and", "or"):
        one, two = inner
        return (lambda env: one(env) and two(env)) if kind == "and" else (lambda env: one(env) or two(env))
    if kind == "choice":
        test, yes, no = inner
        return lambda env: yes(env) if test(env) else no(env)
    call = (OPERATORS if kind == "op" else filters)[node[1]]
    if len(inner) == 1:
        return lambda env, one=inner[0]: call(one(env))
    if len(inner) == 2:
        return lambda env, one=inner[0], two=inner[1]: call(one(env), two(env))
    return lambda env: call(*(f(env) for f in inner))


def runner(body: list, filters: dict, names: frozenset) -> Callable[[dict, Sink], None]:
    """A closure that renders statements into a sink."""
    steps = []
    for node in body:
        if node[0] == "set":
            names = names | {node[1]}
        steps.append(step(node, filters, names))
        names = names | frozenset(assigned([node]))
    if len(steps) == 1:
        return steps[0]

    def run(env: dict, sink: Sink) -> None:
        for one in steps:
            one(env, sink)
    return run


def step(node: tuple, filters: dict, names: frozenset) -> Callable[[dict, Sink], None]:
    kind = node[0]
    if kind == "text":
        return lambda env, sink, text=node[1]: sink.text(text)
    if kind == "print":
        value = value_of(node[1], filters, names)
        return lambda env, sink: sink.text(shown(value(env)))
    if kind == "set":
        value = value_of(node[2], filters, names)
        return lambda env, sink, name=node[1]: env.__setitem__(name, value(env))
    if kind == "generation":
        inner = runner(node[1], filters, names)

        def marked(env: dict, sink: Sink) -> None:
            sink.open()
            inner(env, sink)
            sink.close()
        return marked
    if kind == "if":
        branches = [(value_of(test, filters, names), runner(inner, filters, names)) for test, inner in node[1]]

        def decide(env: dict, sink: Sink) -> None:
            for test, inner in branches:
                if test(env):
                    return inner(env, sink)
            return None
        return decide
    items = value_of(node[2], filters, names)
    inner = runner(node[3], filters, names | {node[1], "loop"})

    def repeat(env: dict, sink: Sink) -> None:
        found = items(env) or []
        for bound in looped(env, node[1], list(found) if isinstance(found, list | str) else []):
            inner(bound, sink)
    return repeat


def looped(env: dict, name: str, items: Iterable) -> Iterator[dict]:
    """``env`` with the loop's names set for each item, which needs the next one in advance."""
    held, index, waiting = None, 0, False
    def bind(last: bool) -> dict:
        env[name] = held
        env["loop"] = {"index": index, "index0": index - 1, "first": index == 1, "last": last}
        return env
    for item in items:
        if waiting:
            yield bind(False)
        held, index, waiting = item, index + 1, True
    if waiting:
        yield bind(True)


def no_stream(node, inside: bool = False) -> None:
    """Raise where ``turns`` is used other than by a loop at the top level."""
    if isinstance(node, tuple | list):
        if isinstance(node, tuple) and node[:2] == ("name", STREAM):
            raise TemplateError(f"{STREAM!r} is a stream: only one loop at the top level can read it")
        for part in node:
            no_stream(part)


class Template:
    """A compiled template; ``constants`` and further ``filters`` are fixed at compile time."""

    def __init__(self, source: str, constants: dict | None = None, filters: dict | None = None):
        known, used = dict(constants or {}), FILTERS | (filters or {})
        tree = pruned(parse(source), known, used)
        names = frozenset(known) | frozenset(assigned(tree)) - {"loop"}
        self.steps, streams = [], 0
        for node in tree:
            if node[0] == "for" and node[2] == ("name", STREAM):
                no_stream(node[3])
                streams += 1
                self.steps.append((node[1], runner(node[3], used, names | {node[1], "loop"})))
            else:
                no_stream(node)
                self.steps.append((None, step(node, used, names)))
        if streams > 1:
            raise TemplateError(f"{STREAM!r} can be read once")
        self.known = known

    def pieces(self, turns: Iterable[dict], limit: int | None = None) -> Iterator[tuple[str, list]]:
        """(text, generated spans) of one conversation, at least once; a piece ends after the turn
        that brings it to ``limit`` code points."""
        sink, env, given = Sink(), dict(self.known), False
        for name, run in self.steps:
            if name is None:
                run(env, sink)
                continue
            for bound in looped(env, name, turns):
                run(bound, sink)
                if limit is not None and sink.size >= limit:
                    yield sink.flush()
                    given = True
        if sink.size or not given:
            yield sink.flush()

    def render(self, turns: Iterable[dict]) -> tuple[str, list]:
        return next(self.pieces(turns))
