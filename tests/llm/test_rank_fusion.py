import math
import random
import statistics

import pytest

from cliploom.llm import rank_fusion

SCHEMA = "id bigint, s_a double, s_b double, s_c double, s_d double, rank_a double"
NAMES = ["a", "b", "c", "d"]


def brute(rows):
    per = []
    for k in range(1, 5):
        col = [-math.inf if r[k] is None or math.isnan(r[k]) else r[k] for r in rows]
        missing = [r[k] is None or math.isnan(r[k]) for r in rows]
        present = [v for v, m in zip(col, missing) if not m]
        got = []
        for v, m in zip(col, missing):
            if m:
                got.append(len(present) + (len(rows) - len(present) + 1) / 2)
            else:
                got.append(sum(x > v for x in present) + (sum(x == v for x in present) + 1) / 2)
        per.append(got)
    return {r[0]: (statistics.median([p[i] for p in per]), sum(p[i] for p in per) / 4) for i, r in enumerate(rows)}


def sample(n, seed):
    rng = random.Random(seed)
    value = [
        lambda: rng.gauss(0, 1),
        lambda: rng.choice([0.5, 0.5, 0.5, rng.random()]),  # mostly stuck
        lambda: float(round(rng.random() * 5)),
        lambda: rng.choice([rng.random() * 1e6, math.inf, -math.inf, None, math.nan, rng.random(), rng.random()]),
    ]
    return [(i, *[f() for f in value], 0.0) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(rank_fusion, "ROWS_PER_INTERVAL", 20)
    rows = sample(700, 5)
    got = rank_fusion.fuse(spark.createDataFrame(rows, SCHEMA), "id", dict.fromkeys(NAMES, 1.0)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.median_rank, r.mean_rank) == pytest.approx(want[r.id])
        assert r.complete == all(v is not None and not math.isnan(v) for v in rows[r.id][1:5])


def test_scale_does_not_matter(spark):
    rows = sample(200, 7)
    one = rank_fusion.fuse(spark.createDataFrame(rows, SCHEMA), "id", dict.fromkeys(NAMES, 1.0))
    wide = [(r[0], r[1] * 1e9, *r[2:]) for r in rows]
    two = rank_fusion.fuse(spark.createDataFrame(wide, SCHEMA), "id", dict.fromkeys(NAMES, 1.0))
    key = lambda d: sorted((r.id, r.median_rank, r.mean_rank) for r in d.collect())
    assert key(one) == key(two)


def test_weights_empty_and_groups(spark):
    rows = [(1, 9.0, 1.0, 1.0, 1.0, 0.0), (2, 1.0, 2.0, 2.0, 2.0, 0.0), (3, 99.0, 99.0, 99.0, None, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    even = rank_fusion.fuse(df, "id", dict.fromkeys(NAMES, 1.0))
    heavy = rank_fusion.fuse(df, "id", {"a": 9.0, "b": 1.0, "c": 1.0, "d": 1.0})
    panels = spark.createDataFrame([(7, 1), (7, 2), (7, 2), (7, 3), (8, 3), (9, None), (9, 1)], "panel bigint, id bigint")
    best = lambda r: sorted(tuple(x) for x in rank_fusion.best_of(r, "id", panels, "panel").collect())
    assert best(even) == [(7, 2), (9, 1)]
    assert best(heavy) == [(7, 1), (9, 1)]
    assert rank_fusion.fuse(df.limit(0), "id", {"a": 1.0, "b": 1.0}).count() == 0
    with pytest.raises(ValueError):
        rank_fusion.fuse(df, "id", {"a": 0.0})


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 3.0)], "id bigint, s_a double, s_b double")
    for c in ("complete", "code", "score", "median_rank", "rank_a", "v0", "c0", "n"):
        df = df.selectExpr("*", f"'z' as {c}")
    got = rank_fusion.fuse(df, "id", {"a": 1.0, "b": 1.0}).collect()
    assert sorted((r.id, r.median_rank, r.complete) for r in got) == [(1, 2.0, True), (2, 1.0, True)]
