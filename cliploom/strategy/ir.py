"""Keep/drop expressions: a small boolean language compiled to Columns.

The surface is a subset of Python expressions: numbers, True/False, names, and/or/not, unary + and -, + - * / %,
comparisons (chains included) and parentheses. :func:`parse` turns a string into the nodes below, :func:`compile_strategy`
turns nodes into a pair of columns (value, failed): evaluation errors are data, never exceptions, so one bad row cannot
end a job. Values travel as doubles; True is 1 and False is 0, and truth is "not equal to zero", NaN included.

Divergence by design: string, None, complex and bytes literals are refused when compiling, not on each row.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


class StrategyError(ValueError):
    """The expression is not one of the language."""


@dataclass(frozen=True)
class Number:
    value: float


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Unary:
    op: str  # "-", "+", "not"
    inner: "Node"


@dataclass(frozen=True)
class Binary:
    op: str  # "+", "-", "*", "/", "%"
    left: "Node"
    right: "Node"


@dataclass(frozen=True)
class Logic:
    op: str  # "and", "or"
    items: tuple["Node", ...]


@dataclass(frozen=True)
class Chain:
    first: "Node"
    rest: tuple[tuple[str, "Node"], ...]  # (comparison, operand) pairs


Node = Number | Name | Unary | Binary | Logic | Chain

_BINARY = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/", ast.Mod: "%"}
_COMPARE = {ast.Eq: "==", ast.NotEq: "!=", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
_UNARY = {ast.USub: "-", ast.UAdd: "+", ast.Not: "not"}


def parse(text: str) -> Node:
    """Nodes of ``text``; raises :class:`StrategyError` for anything outside the language."""
    text = (text or "").strip()
    if not text:
        raise StrategyError("the expression is empty")
    try:
        tree = ast.parse(text, mode="eval")
    except (SyntaxError, ValueError, RecursionError) as e:
        raise StrategyError(f"not an expression: {e}") from e
    return _node(tree.body)


def _node(x: ast.AST) -> Node:
    match x:
        case ast.Constant(value=bool() | int() | float() as v):
            try:
                return Number(float(v))
            except OverflowError as e:
                raise StrategyError(f"number too large: {v}") from e
        case ast.Name(id=name):
            if name.startswith("__"):
                raise StrategyError(f"name not allowed: {name}")
            return Name(name)
        case ast.BoolOp(op=op, values=values):
            return Logic("and" if isinstance(op, ast.And) else "or", tuple(_node(v) for v in values))
        case ast.UnaryOp(op=op, operand=inner) if type(op) in _UNARY:
            return Unary(_UNARY[type(op)], _node(inner))
        case ast.BinOp(left=left, op=op, right=right) if type(op) in _BINARY:
            return Binary(_BINARY[type(op)], _node(left), _node(right))
        case ast.Compare(left=left, ops=ops, comparators=others) if all(type(o) in _COMPARE for o in ops):
            return Chain(_node(left), tuple((_COMPARE[type(o)], _node(c)) for o, c in zip(ops, others)))
    raise StrategyError(f"not allowed: {type(x).__name__}")


def names(node: Node) -> set[str]:
    """Names that the expression reads."""
    match node:
        case Name(name):
            return {name}
        case Unary(_, inner):
            return names(inner)
        case Binary(_, left, right):
            return names(left) | names(right)
        case Logic(_, items):
            return set().union(*map(names, items))
        case Chain(first, rest):
            return names(first).union(*(names(n) for _, n in rest))
    return set()


#: A compiled part: its value as a double, and whether evaluating it fails.
Pair = tuple[Column, Column]


def truthy(value: Column) -> Column:
    """Not zero; NaN is true."""
    return F.isnan(value) | (value != 0)


def _bool(c: Column) -> Column:
    return c.cast("double")


def _compare(op: str, a: Column, b: Column) -> Column:
    """IEEE comparison: false beside NaN, except for !=."""
    odd = F.isnan(a) | F.isnan(b)
    plain = {"==": a == b, "!=": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]
    return odd | plain if op == "!=" else ~odd & plain


def _modulo(a: Column, b: Column) -> Column:
    """Remainder with the divisor's sign; the divisor is not zero."""
    r = a % b
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def _compile(node: Node, look: Callable[[str], Column | None]) -> Pair:
    """``look`` gives a name's column, null where the row lacks it, or None where no row can have it."""
    match node:
        case Number(value):
            return F.lit(value), F.lit(False)
        case Name(name):
            c = look(name)
            if c is None:
                return F.lit(0.0), F.lit(True)
            return F.coalesce(c, F.lit(0.0)), c.isNull()
        case Unary(op, inner):
            v, bad = _compile(inner, look)
            return (_bool(~truthy(v)) if op == "not" else -v if op == "-" else v), bad
        case Binary(op, left, right):
            (a, bad_a), (b, bad_b) = _compile(left, look), _compile(right, look)
            bad = bad_a | bad_b
            if op in "/%":
                zero = b == 0
                safe = F.when(zero, F.lit(1.0)).otherwise(b)
                return (a / safe if op == "/" else _modulo(a, safe)), bad | zero
            return {"+": a + b, "-": a - b, "*": a * b}[op], bad
        case Logic(op, items):
            value, bad = _compile(items[-1], look)
            for item in reversed(items[:-1]):
                v, e = _compile(item, look)
                stop = ~truthy(v) if op == "and" else truthy(v)
                value, bad = F.when(stop, v).otherwise(value), e | (~stop & bad)
            return value, bad
        case Chain(first, rest):
            parts = [_compile(n, look) for n in (first, *(n for _, n in rest))]
            value, bad = None, None
            for i in reversed(range(len(rest))):
                (a, _), (b, bad_b) = parts[i], parts[i + 1]
                held = _compare(rest[i][0], a, b)
                value, bad = (held, bad_b) if value is None else (held & value, bad_b | (held & bad))
            return _bool(value), parts[0][1] | bad
    raise StrategyError(f"unknown node {node}")


@dataclass(frozen=True)
class Strategy:
    """A parsed expression; :meth:`columns` binds it to a row's names."""

    text: str
    node: Node

    def columns(self, look: Callable[[str], Column | None]) -> Pair:
        """(kept, failed): kept is the truth of the value and null where evaluation fails."""
        value, failed = _compile(self.node, look)
        return F.when(~failed, truthy(value)), failed

    def names(self) -> set[str]:
        return names(self.node)


def compile_strategy(text: str) -> Strategy:
    return Strategy(text.strip() if text else "", parse(text))
