"""The formula language of derived KPIs, compiled once to Spark columns.

    expr    := cmp [ '?' expr ':' expr ]
    cmp     := sum [ ('>'|'<'|'>='|'<='|'=='|'!=') sum ]
    sum     := product { ('+'|'-') product }
    product := atom { ('*'|'/') atom }
    atom    := number | name | '(' expr ')'

Everything is a double; truth is 1 or 0.  Division by zero is NaN, comparisons
with NaN are false (``!=`` true), and a NaN condition counts as true.  A result
that is not finite is an error, which the caller sees as a non-finite value.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"\s*(?:(?P<num>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_][\w.]*)|(?P<op>>=|<=|==|!=|[-+*/?:()<>]))"
)
_COMPARE = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "==": operator.eq, "!=": operator.ne}
_NAN = float("nan")


class FormulaError(ValueError):
    """The text is no formula."""


@dataclass(frozen=True)
class Node:
    """``kind`` is num, name, if or an operator; ``args`` its value or operands."""

    kind: str
    args: tuple


def _tokens(text: str) -> Iterator[tuple[str, str]]:
    at, end = 0, len(text.rstrip())
    while at < end:
        m = _TOKEN.match(text, at)
        if not m:
            raise FormulaError(f"unexpected {text[at:].strip()[:1]!r}")
        yield m.lastgroup, m[m.lastgroup]
        at = m.end()


def parse(text: str) -> Node:
    """The formula's tree."""
    rest = [*_tokens(text)][::-1]
    if not rest:
        raise FormulaError("empty formula")

    def at(*ops: str) -> bool:
        return bool(rest) and rest[-1][0] == "op" and rest[-1][1] in ops

    def expect(op: str) -> None:
        if not at(op):
            raise FormulaError(f"expected {op!r}")
        rest.pop()

    def chain(part: Callable[[], Node], *ops: str) -> Node:
        left = part()
        while at(*ops):
            left = Node(rest.pop()[1], (left, part()))
        return left

    def atom() -> Node:
        if not rest:
            raise FormulaError("unexpected end")
        kind, value = rest.pop()
        if kind == "num":
            return Node("num", (float(value),))
        if kind == "name":
            return Node("name", (value,))
        if value != "(":
            raise FormulaError(f"unexpected {value!r}")
        inner = expr()
        expect(")")
        return inner

    def product() -> Node:
        return chain(atom, "*", "/")

    def total() -> Node:
        return chain(product, "+", "-")

    def expr() -> Node:
        left = total()
        if at(*_COMPARE):
            left = Node(rest.pop()[1], (left, total()))
        if not at("?"):
            return left
        rest.pop()
        yes = expr()
        expect(":")
        return Node("if", (left, yes, expr()))

    tree = expr()
    if rest:
        raise FormulaError(f"unexpected {rest[-1][1]!r}")
    return tree


def names(node: Node) -> set[str]:
    """The names a formula reads."""
    if node.kind == "name":
        return {node.args[0]}
    return {n for a in node.args if isinstance(a, Node) for n in names(a)}


def to_column(node: Node, resolve: Callable[[str], Column]) -> Column:
    """The tree as a double column; ``resolve`` gives each name's column."""
    if node.kind == "num":
        return F.lit(node.args[0])
    if node.kind == "name":
        return resolve(node.args[0])
    args = [to_column(a, resolve) for a in node.args]
    if node.kind == "if":
        return F.when(args[0] != 0.0, args[1]).otherwise(args[2])
    left, right = args
    if node.kind == "/":
        return F.when(right == 0.0, F.lit(_NAN)).otherwise(left / right)
    if node.kind in _COMPARE:
        unordered = F.isnan(left) | F.isnan(right)
        plain = F.when(_COMPARE[node.kind](left, right), 1.0).otherwise(0.0)
        return F.when(unordered, F.lit(1.0 if node.kind == "!=" else 0.0)).otherwise(plain)
    return {"+": operator.add, "-": operator.sub, "*": operator.mul}[node.kind](left, right)


def evaluate(node: Node, values: Mapping[str, float]) -> float:
    """The tree's value in plain Python, for tests and checks of constants."""
    if node.kind == "num":
        return node.args[0]
    if node.kind == "name":
        return values[node.args[0]]
    args = [evaluate(a, values) for a in node.args]
    if node.kind == "if":
        return args[1] if args[0] != 0 else args[2]
    left, right = args
    if node.kind == "/":
        return _NAN if right == 0 else left / right
    if node.kind in _COMPARE:
        return float(_COMPARE[node.kind](left, right))
    return {"+": operator.add, "-": operator.sub, "*": operator.mul}[node.kind](left, right)


def finite(value: Column) -> Column:
    """Whether a double is neither NaN nor infinite."""
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def is_finite(value: float) -> bool:
    return math.isfinite(value)
