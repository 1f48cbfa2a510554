"""A small sandboxed template language for conversations.

    text            as it stands
    {{ expr }}      the value of an expression
    {% set x = expr %}
    {% for m in messages %} ... {% endfor %}
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      what the model is to produce

Expressions: strings, ``true``, ``false``, names, ``m.field``, ``loop.first``, ``loop.last``, ``a ~ b``, ``==``, ``!=``, ``not``,
``and``, ``or``, parentheses, and ``value | filter``. There are no calls, no indexing, no access to Python objects: a field is
looked up in the message's dict, a filter in a fixed table.

A template is parsed into a tree of tuples, constants are folded (values set from constants are inlined, dead
branches go, neighbouring texts merge), and the rest becomes Python closures. Rendering is a generator of
``(text, generated)`` over an iterator of messages, so a conversation of any length needs the memory of one message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

Chunks = Iterator[tuple[str, bool]]

#: The chunk behind every round of a loop over ``messages``, known by its identity: no text can pass for it.
TURN_END = ("", False)

#: Where a stretch of messages stands in its conversation; no name of the language can be one of these.
_OPENS, _CLOSES = "first stretch", "last stretch"

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[~|().=]))"""
)
_ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template is not in the language."""


class Escaper:
    """Puts a backslash before backslashes and before every one of ``controls``; ``undo`` takes them away again."""

    def __init__(self, controls: Iterable[str]):
        self._pattern = re.compile("|".join(map(re.escape, ["\\", *sorted(controls, key=len, reverse=True)])))

    def __call__(self, text: str) -> str:
        return self._pattern.sub(lambda m: "\\" + m[0], text)

    @staticmethod
    def undo(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class _Parser:
    """Template text to a tree of ``(kind, ...)``."""

    def __init__(self, source: str, filters: dict[str, Callable[[str], str]]):
        self.pieces = [p for p in _TAG.split(source) if p]
        self.filters, self.at = filters, 0

    def parse(self) -> list[tuple]:
        body, end = self._body(())
        return body

    def _body(self, ends: tuple[str, ...]) -> tuple[list[tuple], str]:
        body: list[tuple] = []
        while self.at < len(self.pieces):
            piece = self.pieces[self.at]
            self.at += 1
            if piece.startswith("{{"):
                body.append(("out", self._expression(piece[2:-2])))
            elif piece.startswith("{%"):
                tag = piece[2:-2].strip()
                word, _, rest = tag.partition(" ")
                if word in ends:
                    return body, tag
                body.append(self._block(word, rest))
            else:
                body.append(("out", ("const", piece)))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return body, ""

    def _block(self, word: str, rest: str) -> tuple:
        if word == "set":
            name, _, value = rest.partition("=")
            return ("set", self._name(name), self._expression(value))
        if word == "for":
            name, _, source = rest.partition(" in ")
            body, _ = self._body(("endfor",))
            return ("for", self._name(name), self._name(source), body)
        if word == "generation":
            body, _ = self._body(("endgeneration",))
            return ("generation", body)
        if word == "if":
            branches, test = [], self._expression(rest)
            while True:
                body, end = self._body(("elif", "else", "endif"))
                branches.append((test, body))
                if end == "endif":
                    return ("if", branches)
                test = ("const", True) if end == "else" else self._expression(end[4:])
        raise TemplateError(f"unknown tag {word!r}")

    @staticmethod
    def _name(text: str) -> str:
        if not text.strip().isidentifier():
            raise TemplateError(f"not a name: {text!r}")
        return text.strip()

    def _expression(self, text: str) -> tuple:
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            found = _TOKEN.match(text, at)
            if not found:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.tokens.append(("end", ""))
        self.tokens.reverse()
        out = self._either()
        if self.tokens[-1][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[-1][1]!r}")
        return out

    def _take(self, *values: str) -> str:
        return self.tokens.pop()[1] if self.tokens[-1][1] in values and self.tokens[-1][0] != "string" else ""

    def _either(self) -> tuple:
        out = self._both()
        while self._take("or"):
            out = ("or", out, self._both())
        return out

    def _both(self) -> tuple:
        out = self._not()
        while self._take("and"):
            out = ("and", out, self._not())
        return out

    def _not(self) -> tuple:
        return ("not", self._not()) if self._take("not") else self._compared()

    def _compared(self) -> tuple:
        out = self._joined()
        sign = self._take("==", "!=")
        return (sign, out, self._joined()) if sign else out

    def _joined(self) -> tuple:
        out = self._filtered()
        while self._take("~"):
            out = ("~", out, self._filtered())
        return out

    def _filtered(self) -> tuple:
        out = self._value()
        while self._take("|"):
            name = self.tokens.pop()[1]
            if name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            out = ("filter", name, out)
        return out

    def _value(self) -> tuple:
        kind, text = self.tokens.pop()
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.DOTALL))
        if kind == "name" and text in ("true", "false"):
            return ("const", text == "true")
        if kind == "name":
            if self._take("."):
                return ("field", text, self._name(self.tokens.pop()[1]))
            return ("name", text)
        if text == "(":
            out = self._either()
            if not self._take(")"):
                raise TemplateError("missing )")
            return out
        raise TemplateError(f"unexpected {text!r}")


def _fold_expression(node: tuple, known: dict[str, object], filters) -> tuple:
    kind = node[0]
    if kind == "name" and node[1] in known:
        return ("const", known[node[1]])
    if kind in ("const", "name", "field"):
        return node
    parts = [p if isinstance(p, str) else _fold_expression(p, known, filters) for p in node[1:]]
    values = [p for p in parts if not isinstance(p, str)]
    if all(p[0] == "const" for p in values):
        return ("const", _evaluate((kind, *parts), filters)({}))
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    return (kind, *parts)


def _fold(body: list[tuple], known: dict[str, object], filters, once: frozenset[str] = frozenset()) -> list[tuple]:
    """``body`` without what is known beforehand; ``known`` gains the constants that it sets.

    ``once``: names that this body alone sets, and only once, so that a constant needs no statement.
    """
    out: list[tuple] = []
    for node in body:
        kind = node[0]
        if kind == "out":
            out.append(("out", _fold_expression(node[1], known, filters)))
        elif kind == "set":
            value = _fold_expression(node[2], known, filters)
            known.pop(node[1], None)
            if value[0] == "const":
                known[node[1]] = value[1]
            if value[0] != "const" or node[1] not in once:
                out.append(("set", node[1], value))
        elif kind == "for":
            inside = {n[1] for n in _walk(node[3]) if n[0] in ("set", "for")} | {node[1], "loop"}
            kept = {k: v for k, v in known.items() if k not in inside}
            out.append(("for", node[1], node[2], _fold(node[3], dict(kept), filters)))
            for name in inside:
                known.pop(name, None)
        elif kind == "generation":
            out.append(("generation", _fold(node[1], known, filters)))
        else:
            out += _fold_branches(node[1], known, filters)
    return _joined_texts(out)


def _joined_texts(body: list[tuple]) -> list[tuple]:
    """``body`` with neighbouring constants as one."""
    out: list[tuple] = []
    for node in body:
        constant = node[0] == "out" and node[1][0] == "const"
        if constant and out and out[-1][0] == "out" and out[-1][1][0] == "const":
            out[-1] = ("out", ("const", _text(out[-1][1][1]) + _text(node[1][1])))
        else:
            out.append(node)
    return out


def _fold_branches(branches: list[tuple], known: dict[str, object], filters) -> list[tuple]:
    left = []
    for test, body in branches:
        test = _fold_expression(test, known, filters)
        if test[0] == "const" and not test[1]:
            continue
        left.append((test, _fold(body, dict(known), filters)))
        if test[0] == "const":
            break
    for _, body in branches:
        for node in _walk(body):
            if node[0] == "set":
                known.pop(node[1], None)
    if not left:
        return []
    return left[0][1] if left[0][0][0] == "const" else [("if", left)]


def _walk(body: list[tuple]) -> Iterator[tuple]:
    for node in body:
        yield node
        if node[0] == "for":
            yield from _walk(node[3])
        elif node[0] == "generation":
            yield from _walk(node[1])
        elif node[0] == "if":
            for _, inner in node[1]:
                yield from _walk(inner)


def _text(value: object) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _evaluate(node: tuple, filters) -> Callable[[dict], object]:
    """An expression as a closure over the names in force."""
    kind, *parts = node
    if kind == "const":
        value = parts[0]
        return lambda env: value
    if kind == "name":
        name = parts[0]
        return lambda env: env.get(name)
    if kind == "field":
        name, field = parts
        return lambda env: env[name].get(field) if isinstance(env.get(name), dict) else None
    if kind == "filter":
        apply, of = filters[parts[0]], _evaluate(parts[1], filters)
        return lambda env: apply(_text(of(env)))
    if kind == "not":
        of = _evaluate(parts[0], filters)
        return lambda env: not of(env)
    left, right = (_evaluate(p, filters) for p in parts)
    return {
        "and": lambda env: left(env) and right(env),
        "or": lambda env: left(env) or right(env),
        "==": lambda env: left(env) == right(env),
        "!=": lambda env: left(env) != right(env),
        "~": lambda env: _text(left(env)) + _text(right(env)),
    }[kind]


def _generate(body: list[tuple], generated: bool, filters) -> Callable[[dict], Chunks]:
    """Statements as one closure."""
    steps = [_statement(node, generated, filters) for node in body]

    def run(env: dict) -> Chunks:
        for step in steps:
            yield from step(env)

    return run


def _statement(node: tuple, generated: bool, filters) -> Callable[[dict], Chunks]:
    kind = node[0]
    if kind == "out" and node[1][0] == "const":
        chunk = (_text(node[1][1]), generated)
        return lambda env: (chunk,)
    if kind == "out":
        value = _evaluate(node[1], filters)
        return lambda env: ((_text(value(env)), generated),)
    if kind == "set":
        name, value = node[1], _evaluate(node[2], filters)

        def assign(env: dict) -> Chunks:
            env[name] = value(env)
            return iter(())

        return assign
    if kind == "generation":
        return _generate(node[1], True, filters)
    if kind == "if":
        branches = [(_evaluate(test, filters), _generate(body, generated, filters)) for test, body in node[1]]

        def choose(env: dict) -> Chunks:
            for test, run in branches:
                if test(env):
                    return run(env)
            return iter(())

        return choose
    name, source, run = node[1], node[2], _generate(node[3], generated, filters)

    def loop(env: dict) -> Chunks:
        items = iter(env.get(source) or ())
        item = next(items, items)
        whole = source != "messages"
        first, closes = whole or env.get(_OPENS, True), whole or env.get(_CLOSES, True)
        while item is not items:
            following = next(items, items)
            env[name] = item
            env["loop"] = {"first": first, "last": following is items and closes}
            yield from run(env)
            if source == "messages":
                yield TURN_END
            item, first = following, False

    return loop


class Template:
    """A compiled template. ``controls`` are the strings it marks turns by; ``escape`` guards them in values."""

    def __init__(self, source: str, controls: Iterable[str] = (), key_controls: Iterable[str] = ()):
        escape, key = Escaper(controls), Escaper([*controls, *key_controls])
        filters = {"escape": escape, "key": key, "trim": str.strip, "upper": str.upper, "lower": str.lower}
        body = _Parser(source, filters).parse()
        names = [n[1] for n in _walk(body) if n[0] in ("set", "for")]
        once = frozenset(n[1] for n in body if n[0] == "set" and names.count(n[1]) == 1)
        self.tree = _fold(body, {}, filters, once)
        self._run = _generate(self.tree, False, filters)

        loops = [k for k, n in enumerate(self.tree) if n[0] == "for" and n[2] == "messages"]
        uses = sum(n[0] == "for" and n[2] == "messages" for n in _walk(self.tree))
        #: No turn depends on others but by ``loop``, so a conversation can be rendered in stretches.
        self.by_turn = len(loops) == uses == 1 and not any(n[0] == "set" for n in _walk(self.tree[loops[0]][3]))
        if self.by_turn:
            at = loops[0]
            self._pieces = [_generate(part, False, filters) for part in (self.tree[:at], [self.tree[at]], self.tree[at + 1 :])]

    def render(self, messages: Iterable[dict], **values: object) -> Chunks:
        """``(text, generated)`` pieces, as messages come, with TURN_END behind each message."""
        return self._run({**values, "messages": messages})

    def render_stretch(self, messages: Iterable[dict], opens: bool, closes: bool, **values: object) -> Chunks:
        """What ``render`` gives for some neighbouring messages of a conversation, if ``by_turn``.

        Stretches joined in order are the whole; ``opens`` and ``closes`` tell whether this is the first and the last.
        """
        env = {**values, "messages": messages, _OPENS: opens, _CLOSES: closes}
        before, loop, after = self._pieces
        yield from (chunk for chunk in before(env) if opens)
        yield from loop(env)
        if closes:
            yield from after(env)
