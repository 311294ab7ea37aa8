import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cliploom.llm import packing


def used_up(made, capacity):
    total = Counter()
    for combo, times in made:
        assert times > 0 and sum(k * m for k, m in combo) <= capacity
        for k, m in combo:
            total[k] += m * times
    return dict(total)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_the_histogram_and_wastes_little(seed):
    rng = random.Random(seed)
    capacity = rng.choice([64, 512, 2048])
    histogram = Counter(min(capacity, max(1, int(rng.lognormvariate(4.2, 1.0)))) for _ in range(5000))
    made = packing.plan(dict(histogram), capacity)
    assert used_up(made, capacity) == dict(histogram)
    least = -(-sum(k * n for k, n in histogram.items()) // capacity)
    assert sum(t for _, t in made) <= 1.02 * least + 1


def test_few_and_awkward_lengths():
    for histogram, capacity in (({}, 8), ({8: 3}, 8), ({5: 7}, 8), ({1: 17}, 8), ({3: 4, 5: 4}, 8), ({6: 10, 2: 3}, 8)):
        made = packing.plan(histogram, capacity)
        assert used_up(made, capacity) == histogram
    assert sum(t for _, t in packing.plan({3: 4, 5: 4}, 8)) == 4
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_least_squares_repeats():
    x = packing.solve_counts([{3: 1, 5: 1}, {4: 2}], {3: 30, 4: 20, 5: 30}, 8)
    assert np.allclose(x, [30, 10], atol=0.1)


def test_items_are_placed_once_and_fit(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 100)
    rng = random.Random(9)
    rows = [(i, rng.choice([7, 7, 7, rng.randrange(1, 60), 0, None, 64, 65, 200, 128])) for i in range(1200)]
    items = spark.createDataFrame(rows, "id bigint, size int")
    got = packing.pack(items, 64).collect()
    per_id, load = defaultdict(list), Counter()
    for r in got:
        per_id[r.id].append((r.piece, r.length))
        assert (r.container is None) == (r.length == 0)
        if r.container is not None:
            load[r.container] += r.length
    assert max(load.values()) <= 64 and sorted(load) == list(range(len(load)))
    for i, size in rows:
        lengths = [n for _, n in sorted(per_id[i])]
        assert sum(lengths) == (size or 0)
        assert len(lengths) == 1 if (size or 0) <= 64 else lengths[:-1] == [64] * (len(lengths) - 1)
    total = sum(s or 0 for _, s in rows)
    assert len(load) <= 1.03 * total / 64 + 1


def test_empty_table_and_repeated_rows(spark):
    items = spark.createDataFrame([(1, 5), (1, 5), (2, None)], "id bigint, size int")
    assert packing.pack(items.limit(0), 8).count() == 0
    got = sorted((r.id, r.container) for r in packing.pack(items, 8).collect() if r.container is not None)
    assert got == [(1, 0), (1, 1)]
    assert packing.pack(items.where("size is null"), 8).count() == 1


def test_other_columns_do_not_clash(spark):
    items = spark.createDataFrame([(1, 5, "z", "z", "z", "z")], "id bigint, size int, length string, bucket string, n string, container string")
    assert [(r.id, r.length, r.container) for r in packing.pack(items, 8).collect()] == [(1, 5, 0)]
