"""A small sandboxed template language: parsed into a tree, folded, compiled to closures.

    {{ expression }}  {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} {% endfor %}  {% set x = e %}  {% generation %} {% endgeneration %}

A dash inside a tag's brackets takes the white space beside it. Expressions: literals, names,
a.b, a['b'], + ~ == != < > <= >= in, not, and, or, ( ), x if c else y, and filters (x | name).
Names only reach what the caller passes; a field is only looked up in a mapping or a sequence, so
no attribute, method or builtin is in reach. A missing name or field is None, rendered as nothing.
`render` gives (text, generated) pieces one by one and takes any iterable to loop over.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping
from typing import Any

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_LEX = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>().\[\]|,]))", re.S)
_WORDS = {"and", "or", "not", "in", "if", "else"}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    pass


def text_of(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def _plus(a, b):
    return a + b if isinstance(a, (int, float)) and isinstance(b, (int, float)) else text_of(a) + text_of(b)


def _order(compare: Callable) -> Callable:
    return lambda a, b: type(a) is type(b) and isinstance(a, (int, float, str)) and compare(a, b)


_BINARY = {"+": _plus, "~": lambda a, b: text_of(a) + text_of(b), "==": operator.eq, "!=": operator.ne, "<": _order(operator.lt), ">": _order(operator.gt), "<=": _order(operator.le), ">=": _order(operator.ge), "in": lambda a, b: a in b if isinstance(b, (str, list, tuple, Mapping)) else False}


def field(x: Any, key: Any) -> Any:
    if isinstance(x, Mapping):
        return x.get(key)
    if isinstance(x, (list, tuple)) and isinstance(key, int) and -len(x) <= key < len(x):
        return x[key]
    return None


class _Expression:
    """Recursive descent over one expression; the tree is made of tuples, first the kind."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _LEX.match(source, at)
            if not m or m.end() == at:
                raise TemplateError(f"can't read {source[at:]!r}")
            at = m.end()
            if m[1]:
                self.tokens.append(("value", int(m[1])))
            elif m[2]:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[0]), m[2][1:-1], flags=re.S)))
            elif m[3]:
                self.tokens.append(("word" if m[3] in _WORDS else "name", m[3]))
            else:
                self.tokens.append(("mark", m[4]))
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *tokens) -> Any:
        if self.peek() in tokens:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, token) -> None:
        if not self.take(token):
            raise TemplateError(f"{token[1]!r} is missing")

    def whole(self):
        e = self.choice()
        if self.peek()[0] != "end":
            raise TemplateError(f"{self.peek()[1]!r} wasn't expected")
        return e

    def choice(self):
        e = self.either()
        if self.take(("word", "if")):
            c = self.either()
            self.need(("word", "else"))
            return ("choice", c, e, self.choice())
        return e

    def either(self):
        e = self.both()
        while self.take(("word", "or")):
            e = ("or", e, self.both())
        return e

    def both(self):
        e = self.negated()
        while self.take(("word", "and")):
            e = ("and", e, self.negated())
        return e

    def negated(self):
        return ("not", self.negated()) if self.take(("word", "not")) else self.compared()

    def compared(self):
        e = self.summed()
        while True:
            if self.peek() == ("word", "not") and self.tokens[self.at + 1 : self.at + 2] == [("word", "in")]:
                self.at += 2
                e = ("not", ("binary", "in", e, self.summed()))
            elif op := self.take(*(("mark", x) for x in ("==", "!=", "<", ">", "<=", ">=")), ("word", "in")):
                e = ("binary", op, e, self.summed())
            else:
                return e

    def summed(self):
        e = self.filtered()
        while op := self.take(("mark", "+"), ("mark", "~")):
            e = ("binary", op, e, self.filtered())
        return e

    def filtered(self):
        e = self.atom()
        while True:
            if self.take(("mark", ".")):
                e = ("field", e, ("value", self.name()))
            elif self.take(("mark", "[")):
                e = ("field", e, self.choice())
                self.need(("mark", "]"))
            elif self.take(("mark", "|")):
                e = ("filter", self.name(), e)
            else:
                return e

    def name(self) -> str:
        kind, x = self.peek()
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return x

    def atom(self):
        kind, x = self.peek()
        self.at += 1
        if kind == "value":
            return ("value", x)
        if kind == "name":
            return ("value", _CONSTANTS[x]) if x in _CONSTANTS else ("name", x)
        if (kind, x) == ("mark", "("):
            e = self.choice()
            self.need(("mark", ")"))
            return e
        raise TemplateError("an expression is missing")


def parse(source: str) -> list:
    """The template's syntax tree: a list of statements."""
    top: list = []
    stack: list[tuple[str, list, Any]] = [("", top, None)]
    at, strip = 0, False

    def text(s: str, after: bool) -> None:
        s = s.lstrip() if strip else s
        s = s.rstrip() if after else s
        if s:
            stack[-1][1].append(("text", s))

    for m in _TAG.finditer(source):
        text(source[at : m.start()], bool(m[1] or m[4]))
        at, strip = m.end(), bool(m[3] or m[6])
        if m[2] is not None:
            stack[-1][1].append(("put", _Expression(m[2]).whole()))
            continue
        if m[5] is None:
            continue
        word, _, rest = m[5].strip().partition(" ")
        if word == "set" and (s := re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(.*)", rest, re.S)):
            stack[-1][1].append(("set", s[1], _Expression(s[2]).whole()))
        elif word == "if":
            node = ["if", [(_Expression(rest).whole(), [])], []]
            stack[-1][1].append(node)
            stack.append(("if", node[1][0][1], node))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            node = stack.pop()[2]
            if word == "elif":
                node[1].append((_Expression(rest).whole(), []))
                stack.append(("if", node[1][-1][1], node))
            else:
                stack.append(("if", node[2], node))
        elif word == "for" and (s := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)):
            node = ["for", s[1], _Expression(s[2]).whole(), []]
            stack[-1][1].append(node)
            stack.append(("for", node[3], node))
        elif word == "generation":
            node = ["generation", []]
            stack[-1][1].append(node)
            stack.append(("generation", node[1], node))
        elif word.startswith("end") and stack[-1][0] == word[3:] and len(stack) > 1:
            stack.pop()
        else:
            raise TemplateError(f"{m[0]!r} wasn't expected")
    text(source[at:], False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} isn't closed")
    return top


def fold_expression(e, filters: Mapping[str, Callable]):
    """The expression with all that doesn't depend on names worked out."""
    kind = e[0]
    if kind in ("value", "name"):
        return e
    if kind == "filter":
        if e[1] not in filters:
            raise TemplateError(f"no filter {e[1]!r}")
        x = fold_expression(e[2], filters)
        return ("value", filters[e[1]](x[1])) if x[0] == "value" else ("filter", e[1], x)
    if kind == "binary":
        a, b = (fold_expression(x, filters) for x in e[2:])
        return ("value", _BINARY[e[1]](a[1], b[1])) if a[0] == b[0] == "value" else ("binary", e[1], a, b)
    parts = [fold_expression(x, filters) for x in e[1:]]
    if kind == "field":
        return ("value", field(parts[0][1], parts[1][1])) if parts[0][0] == parts[1][0] == "value" else ("field", *parts)
    if parts[0][0] == "value":
        truth = bool(parts[0][1])
        if kind == "not":
            return ("value", not truth)
        if kind == "choice":
            return parts[1] if truth else parts[2]
        return parts[1] if truth == (kind == "and") else parts[0]
    return (kind, *parts)


def fold(tree: list, filters: Mapping[str, Callable]) -> list:
    """The tree with constants folded, dead branches cut and texts side by side joined."""
    out: list = []

    def add(node) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node[0] != "text" or node[1]:
            out.append(node)

    for node in tree:
        kind = node[0]
        if kind == "put":
            e = fold_expression(node[1], filters)
            add(("text", text_of(e[1])) if e[0] == "value" else ("put", e))
        elif kind == "set":
            add(("set", node[1], fold_expression(node[2], filters)))
        elif kind == "generation":
            add(("generation", fold(node[1], filters)))
        elif kind == "for":
            add(("for", node[1], fold_expression(node[2], filters), fold(node[3], filters)))
        elif kind == "if":
            branches, last = [], fold(node[2], filters)
            for c, body in node[1]:
                c, body = fold_expression(c, filters), fold(body, filters)
                if c[0] == "value":
                    if c[1]:
                        last = body
                        break
                    continue
                branches.append((c, body))
            if branches:
                add(("if", branches, last))
            else:
                for x in last:
                    add(x)
        else:
            add(node)
    return out


def _closure(e, filters) -> Callable[[dict], Any]:
    kind = e[0]
    if kind == "value":
        return lambda scope, x=e[1]: x
    if kind == "name":
        return lambda scope, n=e[1]: scope.get(n)
    if kind == "filter":
        return lambda scope, f=filters[e[1]], x=_closure(e[2], filters): f(x(scope))
    if kind == "binary":
        return lambda scope, f=_BINARY[e[1]], a=_closure(e[2], filters), b=_closure(e[3], filters): f(a(scope), b(scope))
    p = [_closure(x, filters) for x in e[1:]]
    if kind == "field":
        return lambda scope: field(p[0](scope), p[1](scope))
    if kind == "not":
        return lambda scope: not p[0](scope)
    if kind == "and":
        return lambda scope: p[0](scope) and p[1](scope)
    if kind == "or":
        return lambda scope: p[0](scope) or p[1](scope)
    return lambda scope: p[1](scope) if p[0](scope) else p[2](scope)


def _body(tree: list, filters, generated: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    steps = [_statement(node, filters, generated) for node in tree]

    def run(scope):
        for step in steps:
            yield from step(scope)

    return run


def _statement(node, filters, generated: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    kind = node[0]
    if kind == "text":
        return lambda scope, x=((node[1], generated),): x
    if kind == "put":
        e = _closure(node[1], filters)
        return lambda scope: ((text_of(e(scope)), generated),)
    if kind == "set":
        e = _closure(node[2], filters)

        def assign(scope):
            scope[node[1]] = e(scope)
            return ()

        return assign
    if kind == "generation":
        return _body(node[1], filters, True)
    if kind == "if":
        branches = [(_closure(c, filters), _body(b, filters, generated)) for c, b in node[1]]
        last = _body(node[2], filters, generated)

        def choose(scope):
            for c, b in branches:
                if c(scope):
                    return b(scope)
            return last(scope)

        return choose
    e, body = _closure(node[2], filters), _body(node[3], filters, generated)

    def loop(scope):
        items = iter(e(scope) or ())
        item, inner, n = next(items, loop), dict(scope), 0
        while item is not loop:
            after = next(items, loop)
            inner[node[1]] = item
            inner["loop"] = {"index0": n, "index": n + 1, "first": n == 0, "last": after is loop}
            yield from body(inner)
            item, n = after, n + 1

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Mapping[str, Any]], Iterator[tuple[str, bool]]]:
    """A function from a scope to the pieces of the rendered template."""
    filters = {"trim": lambda x: text_of(x).strip(), "upper": lambda x: text_of(x).upper(), "lower": lambda x: text_of(x).lower()} | dict(filters or {})
    run = _body(fold(parse(source), filters), filters, False)
    return lambda scope: run(dict(scope))
