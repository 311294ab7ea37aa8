import math
import random

import numpy as np

from cliploom.llm import cutoffs

SCORES = "source string, name string, id bigint, value double"


def brute(rows, targets):
    groups = {}
    for s, name, i, v in rows:
        if s is not None and v is not None and not math.isnan(v):
            groups.setdefault((s, name), []).append((v, i))
    out = {}
    for (s, name), got in groups.items():
        if name in targets:
            r = math.ceil(targets[name] * len(got))
            cut = sorted((v for v, _ in got), reverse=True)[r - 1]
            out[s, name] = (len(got), r, cut, sum(v >= cut for v, _ in got), sorted(i for v, i in got if v == cut))
    return out


def run(spark, rows, targets, tree=None):
    df = spark.createDataFrame(rows, SCORES)
    t = spark.createDataFrame(list(targets.items()), "name string, keep_fraction double")
    cut, at = cutoffs.cutoffs(df, t, tree)
    ids = {}
    for r in at.collect():
        ids.setdefault((r.source, r.name), []).append(r.id)
    return {(r.source, r.name): (r.n, r.target, r.cutoff, r.kept, sorted(ids[r.source, r.name])) for r in cut.collect()}


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice(["hot", "hot", "hot", "a", "b", None])
        v = rng.choice([rng.gauss(0, 1), rng.random() * 300, round(rng.random(), 1), 0.5, -0.0, 0.0, math.inf, -math.inf, math.nan, None, 1e300, 5e-324])
        rows.append((s, rng.choice(["x", "y"]), i, v))
    return rows


def test_codes_keep_order():
    v = np.array([-np.inf, -1e300, -1.5, -1e-300, -0.0, 0.0, 5e-324, 0.1, 1.0, 3.0, 1e300, np.inf])
    c = cutoffs.integer_codes(v)
    assert (np.diff(c) >= 0).all() and c[4] == c[5] and c.min() >= 0 and c.max() < 1 << cutoffs.CODE_BITS


def test_against_brute_force(spark):
    rows, targets = sample(1, 3000), {"x": 0.3, "y": 0.625}
    rows += rows[:50]  # repeated rows count again
    assert run(spark, rows, targets) == brute(rows, targets)


def test_keep_all_single_and_empty(spark):
    rows = [("a", "x", 1, 2.0), ("a", "x", 2, 1.0), ("b", "x", 3, 7.0)]
    assert run(spark, rows, {"x": 1.0, "z": 0.5}) == brute(rows, {"x": 1.0})
    assert run(spark, [], {"x": 0.5}) == {}


def test_batches_add_up_to_the_whole_tree(spark):
    rows, targets = sample(2, 1500), {"x": 0.5, "y": 0.1}
    one, two = (cutoffs.build_tree(spark.createDataFrame(r, SCORES)) for r in (rows[:700], rows[700:]))
    assert run(spark, rows, targets, cutoffs.add_batch(one, two)) == brute(rows, targets)


def test_a_stored_tree_follows_records_scored_again(spark, tmp_path):
    rows, targets = sample(5, 1200), {"x": 0.5, "y": 0.1}
    store = cutoffs.TreeStore(spark, str(tmp_path / "t"))
    assert store.tree() is None
    frame = lambda r: spark.createDataFrame(r, SCORES)
    assert store.apply(frame(rows[:800])) == 1
    again = [(s, name, i, None if v is None else v + 1.0) for s, name, i, v in rows[:300]]
    assert store.apply(frame(rows[800:] + again), frame(rows[:300])) == 2
    now = again + rows[300:]
    assert run(spark, now, targets, cutoffs.TreeStore(spark, str(tmp_path / "t")).tree()) == brute(now, targets)
    # Everything taken out again leaves an empty tree; what isn't there can't be taken out, and then nothing changes.
    assert store.apply(frame([]), frame(now)) == 3 and store.tree().count() == 0
    try:
        store.apply(frame([]), frame([("a", "x", 1, 2.0), ("a", "x", 2, 2.0)]))
        raise AssertionError("negative counts")
    except Exception as e:
        assert "taken out" in str(e)
    assert store.versions.head()["version"] == 3


def test_other_columns_do_not_clash(spark):
    rows = [("a", "x", 1, 2.0), ("a", "x", 2, 1.0)]
    df = spark.createDataFrame(rows, SCORES)
    for c in ("code", "n", "rank", "target", "above", "nodes", "page", "keep_fraction"):
        df = df.selectExpr("*", f"'z' as {c}")
    cut, at = cutoffs.cutoffs(df, spark.createDataFrame([("x", 0.5, 9)], "name string, keep_fraction double, n int"))
    assert [(r.cutoff, r.kept) for r in cut.collect()] == [(2.0, 1)] and [r.id for r in at.collect()] == [1]


def test_large_cutoff_tables_take_the_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(cutoffs, "BROADCAST_ROWS", 0)
    rows, targets = sample(3, 800), {"x": 0.3, "y": 0.625}
    assert run(spark, rows, targets) == brute(rows, targets)
