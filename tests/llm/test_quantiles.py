import math
import random

import numpy as np
from pyspark.sql import functions as F

from cliploom.llm import quantiles as Q
from cliploom.llm import queries
from cliploom.plans import selection


def rank_bounds(values, x):
    v = np.sort(values)
    return np.searchsorted(v, x, "left") + 1, np.searchsorted(v, x, "right")


def check(values, s, qs=(0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)):
    """Each summary value's true rank range meets its interval; answers lie within their stated error."""
    assert s[0] == len(values)
    for v, lo, hi in zip(*s[1:]):
        first, last = rank_bounds(values, v)
        assert first <= hi and last >= lo
    for q in qs:
        x, e = Q.answer(s, q)
        r = max(1, math.ceil(q * len(values)))
        first, last = rank_bounds(values, x)
        assert max(first - r, r - last, 0) <= e


def test_merge_keeps_true_bounds():
    rng = np.random.default_rng(1)
    for trial in range(30):
        parts = [rng.choice([0.0, 1.0, 2.0, math.inf, -math.inf], rng.integers(1, 300)) if trial % 3 == 0 else rng.normal(0, 1, rng.integers(1, 3000)) for _ in range(6)]
        s = None
        for p in parts:
            one = Q.thin(Q.exact(p), 1 / 80)
            s = one if s is None else Q.thin(Q.merge(s, one), 1 / 80)
        check(np.concatenate(parts), s)


def test_error_stays_within_the_documented_share():
    rng = np.random.default_rng(2)
    for draw in (lambda: rng.exponential(1, 20_000), lambda: np.round(rng.normal(0, 1, 20_000), 1)):
        parts = [draw() for _ in range(Q.FAN_IN)]
        todo = [Q.thin(Q.exact(p), Q.ERROR / 4) for p in parts]
        assert all(Q.max_error(t) <= Q.ERROR / 4 * t[0] + 1 for t in todo)
        while len(todo) > 1:
            todo = [Q.merge(*todo[i : i + 2]) for i in range(0, len(todo), 2)]
        s = Q.thin(todo[0])
        n = s[0]
        check(np.concatenate(parts), s)
        assert len(s[1]) < 1.5 / (2 * Q.ERROR) and len(s[1]) < len(todo[0][1]) / 4  # compression does something
        assert Q.max_error(s) <= Q.ERROR * n + 1
        assert all(Q.answer(s, q)[1] <= Q.ERROR * n + 1 for q in np.linspace(0, 1, 101))


def test_compression_keeps_what_the_permitted_error_needs():
    s = Q.exact(np.arange(1000.0))
    for permitted in (0.0, 0.001, 0.01, 0.1):
        t = Q.thin(s, permitted)
        assert Q.max_error(t) <= permitted * 1000 + 1 and (len(t[1]) == 1000) == (permitted * 2000 < 2)
    assert [Q.rounds_for(n) for n in (0, 1, 8, 9, 64, 65)] == [1, 1, 1, 2, 2, 3]


def test_empty_sides_and_single_values():
    none, one = Q.exact(np.empty(0)), Q.exact(np.array([3.0]))
    assert Q.merge(none, one) is one and Q.merge(one, none) is one
    assert Q.answer(one, 0.5) == (3.0, 0)


def data(n, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((rng.choice(["hot"] * 6 + ["a", "b", "c", None]), i, i % 3, rng.gauss(0, 1), rng.choice([None, math.nan, 1.0, 2.0, math.inf]), "x"))
    return rows


SCHEMA = "src string, id bigint, day int, a double, b double, name string"


def test_groups_hot_keys_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(Q, "BUFFER", 500)
    monkeypatch.setattr(Q, "FAN_IN", 2)  # several rounds of merging
    rows = data(4000)
    df = spark.createDataFrame(rows + rows[:500], SCHEMA).drop("name").repartition(7)
    got = Q.percentiles(Q.grouped_summaries(df, "src", ["a", "b"], ["id", "day"], salts=5), [0.1, 0.5, 0.99]).collect()
    want = {}
    for src, _, _, a, b, _ in rows:
        for name, v in (("a", a), ("b", b)):
            if src is not None and v is not None and not math.isnan(v):
                want.setdefault((src, name), []).append(v)
    assert {(r.src, r["name"]) for r in got} == set(want)
    for r in got:
        values = want[r.src, r["name"]]
        assert r.n == len(values)
        first, last = rank_bounds(values, r.value)
        k = max(1, math.ceil(r.q * r.n))
        assert max(first - k, k - last, 0) <= r.rank_error <= Q.ERROR * r.n + 1
    assert Q.grouped_summaries(df.limit(0), "src", ["a"], ["id"]).count() == 0


def test_days_combine(spark):
    rows = [r for r in data(3000, 6) if r[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA).drop("name")
    days = Q.merge_summaries(Q.summarise(df, ["src", "day"], ["a"]), ["src", "day", "name"])
    total = Q.merge_summaries(days.withColumnRenamed("day", "part"), ["src", "name"])
    for r in Q.percentiles(total, [0.5]).collect():
        values = [x[3] for x in rows if x[0] == r.src]
        first, last = rank_bounds(values, r.value)
        k = math.ceil(0.5 * len(values))
        assert r.n == len(values) and max(first - k, k - last, 0) <= r.rank_error <= Q.ERROR * r.n + 1


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([("k", 1, 2.0), ("k", 2, 4.0)], "src string, id bigint, a double")
    for c in ("salt", "part", "name", "s", "n", "partial"):
        df = df.selectExpr("*", f"'z' as {c}")
    got = Q.percentiles(Q.grouped_summaries(df, "src", ["a"], ["id"]), [0.5]).collect()
    assert [(r.n, r.value, r.rank_error) for r in got] == [(2, 2.0, 0)]


def test_queries_cover_every_model_of_the_score_maps(spark, tmp_path):
    maps = [{"dover": i / 10, "sanity": 1.0, "new_model": math.nan if i == 3 else float(i)} for i in range(10)]
    rows = [("s", f"c{i}", f"2024-01-0{1 + i % 2} 00:00:00", m) for i, m in enumerate(maps)] + [("s", "none", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "shard string, clip_id string, scored_at string, scores map<string,double>")
    df.withColumn("scored_at", F.to_timestamp("scored_at")).write.parquet(f"{tmp_path}/clip_results.parquet")
    want = {"dover": 10, "sanity": 10, "new_model": 9}
    for name in ("p5_percentiles", "p5_days_combined", "p5_within_bounds"):
        got = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert {(r["name"], r.n) for r in got} == set(want.items()), name
    assert all(r.within for r in got)
    assert {r["name"] for r in selection.calibration_quantiles(spark, str(tmp_path)).collect()} == set(want)
    assert [r.asDict() for r in selection.calibration_wide(spark, str(tmp_path)).collect()] == [{"shard": "s", "n_dover": 10, "n_new_model": 10, "n_sanity": 10}]
