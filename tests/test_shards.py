import numpy as np
import pytest

from cliploom import config, edge
from cliploom.edge import recognition, scorers
from cliploom.operators import calibrate, scenes
from cliploom.plans import shards

VIDEOS = "shard string, path string, fps double, total_frames int, width int, height int, size_bytes bigint"
FRAMES = "path string, frame_idx int, mean_luma double, text_ratio double"


@pytest.fixture
def tables(spark):
    class Length:
        def score(self, records):
            if any("poison" in p for p in records["video_path"]):
                import os

                os._exit(1)  # not an exception that could be caught: the whole task is lost
            return [len(p) / 10 for p in records["video_path"]]

    edge.register_scorer("length", lambda options: Length())
    paths = [("a", "a/longer_name.mp4"), ("a", "a/x.mp4"), ("a", "a/flash.mp4"), ("b", "b/text_on_it.mp4"), ("b", "b/broken_one.mp4"), ("c", "c/poison_longer.mp4"), (None, "none.mp4")]
    videos = spark.createDataFrame([(s, p, None if "broken" in p else 10.0, 40, 8, 8, 5) for s, p in paths], VIDEOS)
    frames = [(p, i, 250.0 * (i % 2) if "flash" in p else 100.0, 0.5 if "text" in p else 0.0) for _, p in paths for i in range(40)]
    conf = {"models": [{"name": "q", "kind": "length", "threshold": 1.0}], "flash_filter": {"enabled": True}, "ocr": {"enabled": True}, "splitter": {"window_len": 10, "window_stride": 10}, "skip_upload": True}
    return videos, spark.createDataFrame(frames, FRAMES), conf


def test_shards_run_through_all_stages_and_a_failing_one_stands_alone(spark, tables, tmp_path):
    videos, frames, conf = tables
    out = str(tmp_path / "o")
    log = shards.run(spark, config.from_dict(conf), videos, frames, out)
    assert log["processed"] == 2 and list(log["failed"]) == ["c"] and (log["kept"], log["dropped"]) == (1, 4)
    store = shards.Store(spark, out)
    assert {r.source_path: r.reason for r in store.rows().collect()} == {"a/longer_name.mp4": None, "a/x.mp4": "score_below_threshold", "a/flash.mp4": "flash", "b/text_on_it.mp4": "ocr_text", "b/broken_one.mp4": "split_failed"}
    assert {r.source_path: r.num_windows for r in store.rows().collect()}["a/longer_name.mp4"] == 4
    assert {r.shard: (r.scored, r.stage) for r in store.states().collect()} == {"a": (True, "processed"), "b": (True, "processed")}
    assert {r.shard: (r.files, r.clips_after_scene, r.clips_after_flash, r.clips_after_ocr, r.clips_kept) for r in store.summaries().collect()} == {"a": (3, 3, 2, 2, 1), "b": (2, 1, 1, 0, 0)}
    # Again: only the failed shard is tried, and it has been mended.
    edge.register_scorer("length", lambda options: type("Ok", (), {"score": lambda self, r: [2.0] * len(r)})())
    log = shards.run(spark, config.from_dict(conf), videos, frames, out)
    assert log == {"processed": 1, "failed": {}, "kept": 2, "dropped": 4} and store.rows().count() == 6
    assert shards.run(spark, config.from_dict(conf), videos, frames, out)["processed"] == 0


def test_a_run_that_dies_before_its_commit_is_repeated(spark, tables, tmp_path, monkeypatch):
    videos, frames, conf = tables
    videos = videos.where("shard = 'a'")
    out = str(tmp_path / "o")

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(shards.Versions, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            shards.run(spark, config.from_dict(conf), videos, frames, out)
    assert shards.Store(spark, out).rows() is None
    assert shards.run(spark, config.from_dict(conf), videos, frames, out)["processed"] == 1
    assert shards.Store(spark, out).rows().count() == 3


def test_captions_of_kept_clips(spark, tables, tmp_path):
    videos, frames, conf = tables
    conf = {**conf, "models": [], "flash_filter": {}, "ocr": {}, "caption": {"visual": {"provider": "see", "prompt": "look", "retry": 0}, "rewrite": {"provider": "say", "template": "{visual_caption}!", "retry": 0}}}

    class See:
        def caption(self, path, prompt, frames):
            if "flash" in path:
                raise ValueError("dark")
            return f"seen {path}"

    edge.register_caption_provider("see", lambda options: See())
    edge.register_caption_provider("say", lambda options: type("Say", (), {"caption": lambda self, path, prompt, frames: prompt.upper()})())
    out = str(tmp_path / "o")
    shards.run(spark, config.from_dict(conf), videos.where("shard = 'a'"), frames, out)
    got = {r.path: (r.caption, r.caption_error) for r in shards.caption_kept(spark, config.from_dict(conf), out).collect()}
    assert got["a/x.mp4"] == ("SEEN A/X.MP4!", None) and got["a/flash.mp4"] == (None, "visual_failed:dark") and len(got) == 3
    assert [r.path for r in shards.caption_kept(spark, config.from_dict(conf), out).collect()] == ["a/flash.mp4"]


def test_frames_for_captions_and_failures_without_pictures(spark):
    class Reader:
        def total(self, path):
            return 9

        def jpeg(self, path, frames, max_side):
            if path == "bad":
                raise OSError("no video")
            return [f"{i}@{max_side}".encode() for i in frames]

    edge.register_frame_reader("r", lambda options: Reader())
    clips = spark.createDataFrame([("ok", 1), ("bad", 2)], "path string, other int")
    got = {r.path: ([bytes(b) for b in r.frames], r.other) for r in edge.read_frames(clips, "r", {}, 3, 64).collect()}
    assert got == {"ok": ([b"0@64", b"4@64", b"8@64"], 1), "bad": ([], 2)}
    assert edge.caption_frames(10, 1) == [5] and edge.caption_frames(0, 3) == [] and edge.caption_frames(2, 5) == [0, 1]


def test_scorers_that_cannot_start_and_model_kinds(spark):
    df = spark.createDataFrame([("v1", None), ("v2", None)], "video_path string, text string").withColumn("meta", calibrate.F.create_map().cast("map<string,string>"))
    got = edge.score(df, [("m", "unimatch_flow", {}), ("d", "dummy", {})], "failed").collect()
    assert all(r.failed and r.scores == {"m": None, "d": 1.0} for r in got)

    class Net:
        def branches(self, path, options):
            return (0.1107, -0.08285) if path == "v1" else (0.3, None)

        def total(self, path):
            return 10 if path == "v1" else 0

        def embeddings(self, path, frames):
            return np.array([[3.0, 4.0]] * len(frames))

        def head(self):
            return np.array([1.0, 2.0]), 0.5

        def flows(self, path, first):
            return [np.stack([np.full((2, 2), 3.0), np.full((2, 2), 4.0)]) for _ in first]

    for kind in ("dover", "laion_aes", "unimatch_flow"):
        scorers.register_provider(kind, lambda options: Net())
    got = {r.video_path: (r.scores, r.failed) for r in edge.score(df, [("q", "dover", {}), ("a", "laion_aes", {}), ("f", "unimatch_flow", {})], "failed").collect()}
    assert got["v1"] == ({"q": 0.5, "a": pytest.approx(2.7), "f": 5.0}, False) and got["v2"] == ({"q": 0.3, "a": 0.0, "f": 0.0}, False)


def test_splitters_registered_and_fallbacks(spark):
    videos = spark.createDataFrame([("v", 10.0, 40)], "path string, fps double, total_frames int")
    rows = spark.createDataFrame([("v", i, 100.0 if i != 20 else 220.0) for i in range(40)], "path string, frame_idx int, content double")
    spans = lambda kind: sorted((r.start, r.end) for r in scenes.scene_spans(rows, videos, kind, 1.5, 5).collect())
    assert spans("transnet_dali") == spans("pyscenedetect") == [(0.0, 2.0), (2.0, 4.0)]
    edge.register_splitter("halves", lambda rows, videos, **options: videos.selectExpr("path", "0 AS span_idx", "0.0D AS start", "1.0D AS end"))
    assert spans("halves") == [(0.0, 1.0)]


def test_transfers_and_cleaning(spark, tmp_path):
    class Up:
        def upload(self, source, target):
            if "bad" in source:
                raise OSError("refused")

    edge.register_uploader("u", lambda options: Up())
    files = spark.createDataFrame([("ok", "t"), ("bad", "t")], "source string, target string")
    assert {r.source: (r.done, r.error) for r in edge.transfer(files, "upload", "u", {"wait": 0}).collect()} == {"ok": (True, None), "bad": (False, "refused")}
    edge.register_downloader("d", lambda options: type("Down", (), {"download": lambda self, shard, path: shard == "ok"})())
    assert {r.source: r.done for r in edge.transfer(files, "download", "d", {"wait": 0}).collect()} == {"ok": True, "bad": False}
    with pytest.raises(ValueError):
        edge.transfer(files, "upload", "nobody", {})
    (tmp_path / "w" / "x").mkdir(parents=True)
    (tmp_path / "keep").touch()
    paths = [str(tmp_path / "w" / "x"), str(tmp_path / "w" / ".." / "keep"), str(tmp_path / "w"), None]
    edge.clean(spark.createDataFrame([(p,) for p in paths], "path string"), str(tmp_path / "w"))
    assert not (tmp_path / "w" / "x").exists() and (tmp_path / "w").exists() and (tmp_path / "keep").exists()


def test_recognition_results_and_labels(spark):
    box = [[0, 0], [2, 0], [2, 1]]
    square = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 1.0}]
    assert recognition.polygons([[box, "text", 0.9]]) == recognition.polygons([[[box, ("text", 0.9)]]]) == [square]
    assert recognition.polygons(None) == recognition.polygons([]) == recognition.polygons([None]) == []
    assert recognition.recognise("frame", lambda f: ([[box, f, 1.0]], 0.1)) == [[box, "frame", 1.0]] and recognition.recognise("f", lambda f: (None, 0)) == []
    rows = spark.createDataFrame([("a", {"q": 1.0}), ("b", {"q": 0.0}), ("c", {"q": 1.0})], "source_path string, scores map<string,double>")
    labels = spark.createDataFrame([("a", "true"), ("a", "true"), ("b", "false"), ("x", "true")], "source_path string, y string")
    got = calibrate.threshold_grid(calibrate.with_labels(rows, labels, "source_path", "y"), {"q": [0.5, 0.5, 2.0]}, "y").collect()
    assert sorted((r.q, r.tp, r.fp, r.fn) for r in got) == [(0.5, 1, 0, 0), (0.5, 1, 0, 0), (2.0, 0, 0, 1)]
