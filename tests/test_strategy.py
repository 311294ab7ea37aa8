import math
import random

import pytest
from pyspark.sql import functions as F

from cliploom.functions import text as text_functions
from cliploom.strategy import context, ir


@pytest.mark.parametrize("bad", ["", "  ", "a >", "f(a)", "a.b", "a[0]", "a ** 2", "a // 2", "a if b else c", "lambda: 1", "a in b", "'x'", "None", "1j", "__x > 1", "a, b", "~a", "a is b", "1e999 + " + "9" * 400])
def test_refused(bad):
    with pytest.raises(ir.StrategyError):
        ir.parse(bad)


class Fails(Exception):
    pass


def peer(node, row):
    """Independent evaluator on Python floats."""
    match node:
        case ir.Number(v):
            return v
        case ir.Name(n):
            if row.get(n) is None:
                raise Fails
            return row[n]
        case ir.Unary(op, inner):
            v = peer(inner, row)
            return float(not truth(v)) if op == "not" else -v if op == "-" else v
        case ir.Binary(op, a, b):
            x, y = peer(a, row), peer(b, row)
            if op in "/%" and y == 0:
                raise Fails
            return {"+": lambda: x + y, "-": lambda: x - y, "*": lambda: x * y, "/": lambda: x / y, "%": lambda: x % y}[op]()
        case ir.Logic(op, items):
            for i in items[:-1]:
                v = peer(i, row)
                if truth(v) == (op == "or"):
                    return v
            return peer(items[-1], row)
        case ir.Chain(first, rest):
            a = peer(first, row)
            for op, n in rest:
                b = peer(n, row)
                if not {"==": a == b, "!=": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]:
                    return 0.0
                a = b
            return 1.0


def truth(v):
    return v != 0 or math.isnan(v)


def expression(rng, depth=3):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(["a", "b", "c", "a_thr", "meta_k", "k", "missing", "0", "1", "2.5", "-3", "True", "False"])
    e = lambda: expression(rng, depth - 1)
    return rng.choice([
        lambda: f"({e()} and {e()})", lambda: f"({e()} or {e()} or {e()})", lambda: f"(not {e()})", lambda: f"(-{e()})",
        lambda: f"({e()} {rng.choice('+-*/%')} {e()})", lambda: f"({e()} {rng.choice(['<', '<=', '>', '>=', '==', '!='])} {e()})",
        lambda: f"({e()} < {e()} <= {e()})",
    ])()


def test_columns_agree_with_an_independent_evaluator(spark):
    rng = random.Random(11)
    values = [0.0, 1.0, -2.0, 0.5, 7.0, math.nan, math.inf, -math.inf, 3.25]
    rows = []
    for i in range(60):
        scores = {n: rng.choice(values) for n in ("a", "b", "c")}
        meta = {k: v for k, v in (("k", rng.choice(["1", "0", "true", "x", "", "-2.5"])), (" k ", rng.choice(["3", "0"])), ("other", "1")) if rng.random() < 0.7}
        rows.append((i, scores, meta))
    # A Python dict's order is lost on the way to a map, so keys and values go as arrays.
    flat = [(i, s, list(m), list(m.values())) for i, s, m in rows]
    df = spark.createDataFrame(flat, "id int, scores map<string,double>, ks array<string>, vs array<string>")
    df = df.select("id", "scores", F.map_from_arrays("ks", "vs").alias("meta")).cache()
    texts = [expression(rng) for _ in range(48)]
    look = context.lookup(df.scores, {"a": 1.0, "b": 0.0, "c": 2.0}, None, df.meta)
    columns = []
    for i, t in enumerate(texts):
        kept, failed = ir.compile_strategy(t).columns(look)
        columns += [kept.alias(f"k{i}"), failed.alias(f"f{i}")]
    number = {"1": 1.0, "0": 0.0, "true": 1.0, "-2.5": -2.5, "3": 3.0}
    got = {}
    for start in range(0, len(columns), 24):
        for r in df.select("id", *columns[start : start + 24]).collect():
            got.setdefault(r["id"], {}).update(r.asDict())
    for i, scores, meta in rows:
        usable = [(k.strip(), number[v]) for k, v in meta.items() if v in number]
        names = dict(scores) | {"a_thr": 1.0, "b_thr": 0.0, "c_thr": 2.0}
        for k, v in usable:
            names.setdefault(k, v)
        for k, v in usable:
            names["meta_" + k] = v
        for j, t in enumerate(texts):
            try:
                want = (truth(peer(ir.parse(t), names)), False)
            except Fails:
                want = (None, True)
            assert (got[i][f"k{j}"], got[i][f"f{j}"]) == want, (t, names)
    df.unpersist()


def test_coercion_follows_python(spark):
    samples = ["1", " 2.5 ", "1e3", "1_000", "5d", "1f", "nan", "+nan", "inf", "-Infinity", "true", "FALSE", "", "  ", "x", ".5", "5.", "1__0", "_1", "0x10", "1 2"]

    def want(s):
        t = s.strip().lower()
        if t in ("true", "false"):
            return float(t == "true")
        try:
            return float(t) if t else None
        except ValueError:
            return None

    df = spark.createDataFrame([(s,) for s in samples], "s string")
    for s, got in df.select("s", text_functions.to_context_number(df.s)).collect():
        w = want(s)
        assert got == w or (got is not None and w is not None and math.isnan(got) and math.isnan(w)), s


def test_keys(spark):
    df = spark.createDataFrame([(k,) for k in (" a b ", "1x", "né-è", "", "--", "_")], "k string")
    assert [r[0] for r in df.select(text_functions.normalise_key(df.k)).collect()] == ["a_b", "v_1x", "né_è", None, "_", "_"]
