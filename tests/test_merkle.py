import pytest

from cliploom.operators import merkle

SCHEMA = "k string, a double, b boolean, extra string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def keys(df):
    return sorted((r["k"] for r in df.collect()), key=str)


def test_changed_added_and_null_as_value(spark):
    old = rows(spark, [("x", 1.0, True, "o"), ("y", None, True, "o"), ("z", 3.0, None, "o"), (None, 1.0, True, "o"), ("nan", float("nan"), True, "o"), ("zero", 0.0, True, "o")])
    new = rows(spark, [("x", 1.0, True, "n"), ("y", 2.0, True, "n"), ("z", 3.0, False, "n"), (None, 1.0, None, "n"), ("nan", float("nan"), True, "n"), ("zero", -0.0, True, "n"), ("added", 0.0, False, "n")])
    found = merkle.changed_records(new, old, ["k"], ["a", "b"])
    assert keys(found) == sorted(["y", "z", None, "added"], key=str)
    assert found.columns == ["k", "a", "b", "extra"]


def test_empty_tables(spark):
    some, none = rows(spark, [("x", 1.0, True, None)]), rows(spark, [])
    assert keys(merkle.changed_records(some, none, ["k"], ["a", "b"])) == ["x"]
    assert keys(merkle.changed_records(none, some, ["k"], ["a", "b"])) == []
    assert keys(merkle.changed_records(none, none, ["k"], ["a", "b"])) == []


def test_descent_reaches_only_changed_leaves(spark):
    base = [(f"k{i}", float(i), True, None) for i in range(500)]
    old, new = rows(spark, base), rows(spark, [*base[:-1], ("k499", -1.0, True, None)])
    trees = [merkle.tree(x, ["k"], ["a", "b"], 3) for x in (new, old)]
    assert merkle.changed_leaves(*trees, 3).count() == 1
    assert merkle.changed_leaves(trees[0], trees[0], 3).count() == 0


def test_latest_takes_greatest_order_and_ignores_copies(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("x", 2, "b"), ("y", 1, None)], "k string, seq int, v string")
    assert sorted(tuple(r) for r in merkle.latest(df, ["k"], ["seq"]).select("k", "v").collect()) == [("x", "b"), ("y", None)]


def test_store_survives_failure_without_skipping_or_repeating(spark, tmp_path):
    store = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"], compact_after=2)
    first = rows(spark, [("x", 1.0, True, None), ("y", 2.0, True, None)])
    assert keys(store.run(first, lambda d: d)) == ["x", "y"]
    second = rows(spark, [("x", 1.0, True, None), ("y", 5.0, True, None), ("z", 0.0, None, None)])

    def broken(d):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.run(second, broken)
    assert keys(store.run(second, lambda d: d)) == ["y", "z"]
    version = store.manifest()["version"]
    assert keys(store.run(second, lambda d: d)) == [] and store.manifest()["version"] == version
    third = rows(spark, [("x", 1.0, True, None), ("z", 0.0, None, None)])  # y is gone
    assert keys(store.run(third, lambda d: d)) == []
    assert keys(store.run(second, lambda d: d)) == ["y"]  # and comes back as it was
    assert keys(store.saved()) == ["x", "y", "z"]


def test_only_differing_ranges_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", 500)  # several ranges at the size of a test
    base = [(f"k{i}", float(i), True, None) for i in range(5000)]
    store = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"])
    store.bootstrap(rows(spark, base))
    changed = set(range(0, 5000, 2500))
    new = rows(spark, [(k, -1.0 if i in changed else a, b, c) for i, (k, a, b, c) in enumerate(base)])
    found = store.changes(new)
    assert keys(found) == ["k0", "k2500"]
    m = store.manifest()
    assert m["range_level"] == 1 and m["depth"] == merkle.depth_for(5000)
    files = lambda df: df.select(merkle.F.input_file_name()).distinct().count()
    assert files(store._rows(m, [5])) * 10 < files(store._rows(m))
    plan = store._rows(m, [5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__range" in plan


def test_one_percent_of_changes_reads_few_records(spark, tmp_path):
    base = [(f"k{i}", float(i), True, None) for i in range(20000)]
    store = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"])
    store.bootstrap(rows(spark, base))
    new = rows(spark, [(k, -1.0 if i % 100 == 0 else a, b, c) for i, (k, a, b, c) in enumerate(base)])
    assert store.changes(new).count() == 200
    old = spark.read.schema(merkle.TREE).parquet(f"{store.path}/{store.manifest()['tree']}")
    leaves = merkle.changed_leaves(store._tree, old, store.manifest()["depth"])
    assert leaves.count() <= 200
    assert store._rows(store.manifest(), None, leaves, store.manifest()["depth"]).count() < 20000 * 0.1


@pytest.mark.parametrize("step", ["process", "_write", "_write_tree", "commit"])
def test_a_run_killed_at_any_step_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    store = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"])
    store.run(rows(spark, [("x", 1.0, True, None), ("y", 2.0, True, None)]), lambda d: d)
    second = rows(spark, [("x", 1.0, True, None), ("y", 5.0, True, None), ("z", 0.0, None, None)])

    def killed(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step != "process":
            m.setattr(store.versions if step == "commit" else store, step, killed)
        with pytest.raises(KeyboardInterrupt):
            store.run(second, killed if step == "process" else lambda d: d)
    assert store.manifest()["version"] == 1
    assert keys(store.run(second, lambda d: d)) == ["y", "z"]
    assert keys(store.run(second, lambda d: d)) == []


def test_two_runs_at_once_commit_once(spark, tmp_path):
    a = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"])
    b = merkle.MerkleStore(spark, str(tmp_path / "s"), ["k"], ["a", "b"])
    some = rows(spark, [("x", 1.0, True, None)])

    def other_first(d):
        b.run(some, lambda x: x.withColumn("by", merkle.F.lit("b")))
        return d.withColumn("by", merkle.F.lit("a"))

    with pytest.raises(RuntimeError, match="another run"):
        a.run(some, other_first)
    m = a.manifest()
    assert m["version"] == 1 and [r["by"] for r in spark.read.parquet(f"{a.path}/{m['output']}").collect()] == ["b"]


def test_depth_follows_the_number_of_records():
    assert [merkle.depth_for(n) for n in (0, 16, 17, 300, 20_000, 10**9)] == [1, 1, 1, 2, 3, 7]
    assert [merkle.range_level_for(n) for n in (0, 10**6, 10**7, 10**8, 10**12)] == [0, 0, 1, 2, 3]
