import json

import pytest

from cliploom import cli, config, edge
from cliploom.plans.offline import Job, load_records, run
from cliploom.sources import manifests


@pytest.fixture
def setup(tmp_path):
    class ByName:  # a local class travels to the workers by value
        def score(self, records):
            return [float(p.rsplit("_", 1)[1].split(".")[0]) / 10 for p in records["video_path"]]

    edge.register_scorer("by_name", lambda options: ByName())
    (tmp_path / "v" / "deep").mkdir(parents=True)
    for i in range(8):
        (tmp_path / "v" / f"c_{i}.mp4").write_bytes(b"x" * (i + 1))
    (tmp_path / "v" / "deep" / "c_9.mov").write_bytes(b"y")
    lines = [{"video_path": f"v/c_{i}.mp4", "text": "t" if i % 2 else None, "rank": i} for i in (3, 1, 3, 7)] + [{"video_path": "v/c_5.mp4"}, {"video_path": "gone/c_8.mp4", "text": "t", "rank": 9}]
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    return tmp_path, config.from_dict({"workdir": str(tmp_path / "w"), "models": [{"name": "q", "kind": "by_name", "threshold": 0.3}]})


def read(spark, out):
    return {(r.source_path.rsplit("/", 1)[1], r.text): r for r in manifests.read_metadata(spark, f"{out}/metadata.jsonl").collect()}


def test_records_are_ordered_distinct_and_limited(spark, setup):
    root, _ = setup
    rows = load_records(spark, Job(str(root / "m.jsonl"), [str(root / "v")], recursive=False)).collect()
    got = [(r.source_path.rsplit("/", 1)[1], r.text) for r in sorted(rows, key=lambda r: r["index"])]
    assert got[:5] == [("c_3.mp4", "t"), ("c_1.mp4", "t"), ("c_7.mp4", "t"), ("c_5.mp4", None), ("c_8.mp4", "t")]
    assert got[5:] == [(f"c_{i}.mp4", None) for i in (0, 1, 2, 3, 4, 6, 7)]
    assert [r["index"] for r in sorted(rows, key=lambda r: r["index"])] == list(range(12))
    some = load_records(spark, Job(str(root / "m.jsonl"), limit=2)).collect()
    assert sorted((r["index"], r.source_path[-7:]) for r in some) == [(0, "c_3.mp4"), (1, "c_1.mp4")]
    with pytest.raises(ValueError):
        load_records(spark, Job())


def test_run_resume_and_strategy(spark, setup):
    root, conf = setup
    out = str(root / "out")
    job = Job(str(root / "m.jsonl"), output=out, strategy="q >= q_thr and (rank > 5 or q < 0.6)")
    log = run(spark, conf, job)
    rows = read(spark, out)
    reasons = {k[0]: r.reason for k, r in rows.items()}
    assert reasons == {"c_3.mp4": None, "c_1.mp4": "strategy_filtered", "c_7.mp4": None, "c_5.mp4": "strategy_error", "c_8.mp4": "source_missing"}
    assert log["processed"] == 5 and log["kept"] == 2 and log["reason_counts"] == {"strategy_filtered": 1, "strategy_error": 1, "source_missing": 1}
    assert sorted(p.name for p in (root / "out" / "videos").iterdir()) == ["00000000_c_3.mp4", "00000002_c_7.mp4"]
    assert run(spark, conf, job)["processed"] == 0  # a second run finds nothing to do
    more = Job(str(root / "m.jsonl"), [str(root / "v")], output=out)
    assert run(spark, conf, more)["processed"] == 8  # the manifest already had c_5 without text
    assert len(read(spark, out)) == 13
    assert json.loads((root / "out" / "runlog.json").read_text())["status"] == "success"


@pytest.mark.parametrize("with_folder", [False, True])
def test_vanished_sources_of_many_records(spark, setup, with_folder):
    root, _ = setup
    (root / "other").mkdir()
    (root / "other" / "here.mp4").write_bytes(b"x")
    (root / "other" / "empty.mp4").touch()
    names = ["other/here.mp4", "other/empty.mp4", *[f"gone/g_{i}.mp4" for i in range(10_020)]]
    (root / "many.jsonl").write_text("\n".join(json.dumps({"video_path": n}) for n in names))
    folders = [str(root / "v")] if with_folder else []
    log = run(spark, config.from_dict({"workdir": str(root / "w")}), Job(str(root / "many.jsonl"), folders, output=str(root / "out")))
    assert log["reason_counts"] == {"source_missing": 10_020}
    kept = {k[0] for k, r in read(spark, root / "out").items() if r.keep}
    assert kept == {"here.mp4", "empty.mp4"} | ({f"c_{i}.mp4" for i in range(8)} | {"c_9.mov"} if with_folder else set())
    assert len(list((root / "out" / "videos").iterdir())) == len(kept)


def test_no_models_keep_all_and_failures_are_logged(spark, setup):
    root, _ = setup
    conf = config.from_dict({"workdir": str(root / "w")})
    assert run(spark, conf, Job(folders=[str(root / "v")], output=str(root / "o2")))["kept"] == 9
    (root / "empty").mkdir()
    with pytest.raises(SystemExit):
        run(spark, conf, Job(folders=[str(root / "empty")], output=str(root / "o3")))
    assert json.loads((root / "o3" / "runlog.json").read_text())["status"] == "failed"


def test_doctor_reports():
    assert ("pyspark", True, "python package") in cli.doctor()
