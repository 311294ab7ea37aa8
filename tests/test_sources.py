from cliploom import edge
import json

import pytest
from pyspark.sql import functions as F

from cliploom.operators import records
from cliploom.sinks import metadata as sink
from cliploom.sources import files, manifests


def touch(p, data=b"x"):
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(data)


def test_listing_videos_and_archives(spark, tmp_path):
    for name in ("a/x.MP4", "a/y.txt", "a/scenes/z.mp4", "b.mov", "s1.tar.gz", "s0.zip"):
        touch(tmp_path / name, b"12345")
    root = str(tmp_path)
    got = sorted(r.video_path for r in files.videos(spark, [root], True, ["scenes"]).collect())
    assert got == [f"{root}/a/x.MP4", f"{root}/b.mov"]
    assert [r.video_path for r in files.videos(spark, [root], recursive=False).collect()] == [f"{root}/b.mov"]
    assert [r.shard for r in files.archives(spark, root).collect()] == ["s0.zip", "s1.tar.gz"]
    with pytest.warns(UserWarning):
        assert files.videos(spark, [root + "/none"]).count() == 0
    up = files.upload_manifest(files.listing(spark, [root]), root, ["**/*.MP4", "a/*", "*.zip"])
    assert sorted(tuple(r) for r in up.collect()) == [("a/x.MP4", 5), ("a/x.MP4", 5), ("a/y.txt", 5), ("s0.zip", 5)]


def test_shard_lists(spark, tmp_path):
    (tmp_path / "l.txt").write_text(" a.zip \n\n# no\n  # no\nb.zip")
    assert [r.shard for r in files.shard_list(spark, str(tmp_path / "l.txt"), ["z"]).collect()] == ["a.zip", "b.zip"]
    assert [r.shard for r in files.shard_list(spark, None, ["z", " "]).collect()] == ["z"]
    with pytest.raises(FileNotFoundError):
        files.shard_list(spark, str(tmp_path / "no.txt"))
    assert files.shard_list(spark, str(tmp_path / "no.txt"), missing_ok=True).count() == 0


def test_states_skip_unreadable_files(spark, tmp_path):
    (tmp_path / "s1.tgz.json").write_text(json.dumps({"stage": "uploaded", "uploaded": True}))
    (tmp_path / "s2.json").write_text("{broken")
    got = files.states(spark, str(tmp_path), "stage string, uploaded boolean")
    assert [(r.shard, r.stage, r.uploaded) for r in got.collect()] == [("s1.tgz", "uploaded", True)]


def test_manifests(spark, tmp_path):
    j = tmp_path / "m.jsonl"
    j.write_text('{"video_path": "v/a.mp4", "text": "hi", "n": 3, "deep": {"k": 1}}\n\n{"video_path": "/abs/b.mp4"}\n')
    got = manifests.read_manifest(spark, str(j)).collect()
    assert [(r.video_path, r.text, r.meta) for r in got] == [(f"{tmp_path}/v/a.mp4", "hi", {"n": "3", "deep": '{"k":1}'}), ("/abs/b.mp4", None, {})]
    j.write_text('{"text": "no path"}\n')
    with pytest.raises(Exception, match="has no video_path"):
        manifests.read_manifest(spark, str(j)).collect()
    c = tmp_path / "m.csv"
    c.write_text('video_path,text,q\na.mp4,"said ""x"", twice",0.5\nb.mp4,,\n')
    got = manifests.read_manifest(spark, str(c)).collect()
    assert [(r.text, r.meta) for r in got] == [('said "x", twice', {"q": "0.5"}), (None, {})]
    with pytest.raises(ValueError):
        manifests.read_manifest(spark, "m.txt")


def test_metadata_round_trip_and_resume(spark, tmp_path):
    rows = spark.createDataFrame([(0, "/v/a.mp4", True, None, {"d": 1.0}, "t", {}), (1, "/v/b.mp4", True, None, {"d": None}, None, {})], "index bigint, source_path string, keep boolean, reason string, scores map<string,double>, text string, meta map<string,string>")
    have = spark.createDataFrame([("/v/a.mp4", 7)], "path string, length bigint")
    out = sink.offline_rows(rows, have, ["k", "k", "l"])
    path = str(tmp_path / "o" / "metadata.jsonl")
    sink.write_metadata(out, path)
    part = next((tmp_path / "o" / "metadata.jsonl").glob("part-*.json"))
    part.write_text(part.read_text() + '{"source_path": "/v/c.mp4", "broken\n{"keep": true}\n')
    (tmp_path / "o" / "metadata.jsonl" / f".{part.name}.crc").unlink(missing_ok=True)
    got = {r.source_path: r for r in manifests.read_metadata(spark, str(tmp_path / "o")).collect()}
    assert set(got) == {"/v/a.mp4", "/v/b.mp4"}
    assert got["/v/a.mp4"].output_path == "00000000_a.mp4" and got["/v/b.mp4"].reason == "source_missing" and not got["/v/b.mp4"].keep
    left = records.pending(rows, manifests.read_metadata(spark, str(tmp_path / "o")), ["source_path", "text"])
    assert left.count() == 0
    more = rows.unionByName(rows.limit(1).withColumn("text", F.lit(None).cast("string")))
    assert [r.text for r in records.pending(more, manifests.read_metadata(spark, str(tmp_path / "o")), ["source_path", "text"]).collect()] == [None]


def test_shard_rows_and_extras(spark):
    res = spark.createDataFrame([("a", {"d": 1.0}, True, None, "o/a"), ("b", {}, True, None, "o/b"), ("c", {}, False, "flash", "o/c")], "source_path string, scores map<string,double>, keep boolean, reason string, output_path string")
    have = spark.createDataFrame([("a", 5), ("c", 6)], "path string, length bigint")
    extra = spark.createDataFrame([("a", 99, True), ("c", None, None)], "source_path string, size_bytes bigint, flash_hit boolean")
    got = {r.source_path: (r.size_bytes, r.output_path, r.flash_hit) for r in sink.shard_rows(res, have, extra).collect()}
    assert got == {"a": (99, "o/a", True), "b": (0, None, None), "c": (6, None, None)}


def test_table_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", {"d": 1.0}, True), ("b", {}, False), ("c", None, False)], "source_path string, scores map<string,double>, keep boolean")
    sink.write_calibration(rows, str(tmp_path / "cal"))
    got = spark.read.parquet(str(tmp_path / "cal"))
    assert sorted(r.source_path for r in got.collect()) == ["a", "b"] and got.schema["scores"].dataType.typeName() == "map"
    sink.write_grid(spark.createDataFrame([(0.5, 3)], "dover double, tp int"), str(tmp_path / "grid"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "grid"), header=True).collect()] == [("0.5", "3")]
    sink.write_states(rows.select("source_path"), str(tmp_path / "st"))
    sink.write_states(rows.select("source_path").limit(1), str(tmp_path / "st"))
    assert spark.read.parquet(str(tmp_path / "st")).count() == 1
    sink.write_summaries(spark.createDataFrame([("s", None)], "shard string, clips int"), str(tmp_path / "su"))
    assert "".join(p.read_text() for p in (tmp_path / "su").glob("part-*")).strip() == '{"shard":"s","clips":null}'
    sink.write_run_log(str(tmp_path / "log.json"), "success", {"flash": 2}, strategy=None)
    assert json.loads((tmp_path / "log.json").read_text()) == {"status": "success", "reason_counts": {"flash": 2}, "strategy": None}


def test_manifest_paths_are_collapsed_and_errors_name_the_line(spark, tmp_path):
    names = ["./v/a.mp4", "v/../v/b.mp4", "/x//y/./c.mp4", "../../../../../../../../top.mp4", "s3://bucket/p/../q.mp4", "file:///x/../y.mp4", "v/..hidden/.d.mp4"]
    (tmp_path / "m.jsonl").write_text("\n\n".join(json.dumps({"video_path": n}) for n in names))
    rows = sorted(manifests.read_manifest(spark, str(tmp_path / "m.jsonl")).collect(), key=lambda r: r.line)
    assert [r.line for r in rows] == [1, 3, 5, 7, 9, 11, 13]
    assert [r.video_path for r in rows] == [f"{tmp_path}/v/a.mp4", f"{tmp_path}/v/b.mp4", "/x/y/c.mp4", "/top.mp4", "s3://bucket/q.mp4", "file:///y.mp4", f"{tmp_path}/v/..hidden/.d.mp4"]
    (tmp_path / "bad.jsonl").write_text('{"video_path": "a"}\n\n{"text": "x"}\n')
    with pytest.raises(Exception, match="manifest line 3 has no video_path"):
        manifests.read_manifest(spark, str(tmp_path / "bad.jsonl")).collect()


def test_files_exist_by_path_and_uri(spark, tmp_path):
    (tmp_path / "a").touch()
    paths = [str(tmp_path / "a"), f"file://{tmp_path}/a", f"file://{tmp_path}/b", str(tmp_path / "b"), None, "nosuch://x/y"]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", edge.exists("p").alias("there")).collect()
    assert [r.there for r in sorted(got)] == [True, True, False, False, False, False]


def test_scratch_tables_go_and_others_stay(spark):
    from cliploom.session import scratch, write_table

    kept = write_table(spark.range(3), "kept")
    with scratch(spark):
        gone = write_table(spark.range(4), "gone")
        assert gone.count() == 4
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FileNotFound|NOT_EXIST"):
        spark.read.parquet(gone.inputFiles()[0]).count()
