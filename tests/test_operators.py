import math
import os
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from cliploom import config, edge
from cliploom.functions import kernels
from cliploom.operators import calibrate, captions, frames, ordered, partition, progress, records, scenes, select, skew, windows
from cliploom.plans import pipeline, selection
from cliploom.sinks import metadata as sink
from cliploom.streaming import ingest


def one(df):
    return [tuple(r) for r in df.collect()]


def test_previous_across_blocks(spark):
    rows = [(k, i, float(v)) for k in (None, "a", "b") for v, i in enumerate(sorted(random.Random(str(k)).sample(range(200), 40)))]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(5)
    got = {(r.k, r.i): r.prev_v for r in ordered.with_previous(df, ["k"], "i", ["v"], block=7).collect()}
    assert got == {(k, i): (v - 1 if v else None) for k, i, v in rows}


def test_flash_edges(spark):
    lumas = {"none": [], "one": [5.0], "exact": [0.0, 10.0, 10.0, 10.0], "under": [0.0, 9.9, 0.0], "stride": [0.0, 99.0, 0.0, 99.0, 20.0]}
    rows = [(p, i, x) for p, v in lumas.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "path string, frame_idx int, mean_luma double")
    got = {r.path: (r.n_samples, r.n_events, r.flash_hit) for r in frames.flash(df, 1, 10.0, 0.25).collect()}
    assert got == {"one": (1, 0, False), "exact": (4, 1, True), "under": (3, 0, False), "stride": (5, 4, True)}
    got = {r.path: (r.n_samples, r.n_events) for r in frames.flash(df, 2, 10.0, 0.5).collect()}
    assert got["stride"] == (3, 1)
    clips = spark.createDataFrame([(p,) for p in lumas], "path string")
    hits = {r.path: r.flash_hit for r in frames.flag(clips, frames.flash(df, 0, 10.0, 0.25), "flash_hit").collect()}
    assert hits["none"] is False and hits["exact"] is True


def test_boundary_spans(spark):
    rows = [("v", i, s) for i, s in enumerate([1.0, 0.0, 1.0, 1.0, 0.0, 0.0])] + [("w", 0, 0.0), ("x", 0, 1.0)]
    df = spark.createDataFrame(rows, "path string, frame_idx int, boundary_score double")
    videos = spark.createDataFrame([("v", 2.0, 6), ("w", 1.0, 1), ("x", None, 1), ("none", 25.0, 0)], "path string, fps double, total_frames int")
    got = sorted(one(frames.boundary_spans(df, videos, 0.5)))
    assert got == [("none", 0, 0.0, 0.0), ("v", 0, 0.0, 1.0), ("v", 1, 1.0, 1.5), ("v", 2, 1.5, 2.5), ("w", 0, 0.0, 0.0), ("x", 0, 0.0, 0.0)]


def test_adaptive_cuts_keep_their_distance(spark):
    ratios = spark.createDataFrame([("v", i, 9.0 if i in (3, 10, 12, 30) else 1.0) for i in range(40)], "path string, frame_idx int, ratio double")
    assert sorted(r.frame_idx for r in frames.adaptive_cuts(ratios, 3.0, 5).collect()) == [10, 30]


def brute_windows(first, last, length, stride):
    out, s = [], first
    while s + length - 1 <= last:
        out.append([s, s + length - 1])
        s += stride
    return out


def test_windows(spark):
    rows = [(a, b) for a in (0, 3) for b in range(0, 14)]
    df = spark.createDataFrame(rows, "a int, b int")
    for length, stride in ((4, 2), (1, 1), (5, 7), (0, 0)):
        for a, b, w in df.select("a", "b", windows.sliding(F.col("a"), F.col("b"), length, stride)).collect():
            assert w == brute_windows(a, b, max(length, 1), max(stride, 1))
    videos = spark.createDataFrame([("p", None, 10), ("q", 0.0, 10), ("r", 10.0, 30), ("s", 10.0, 3)], "path string, fps double, total_frames int")
    got = {r.path: r for r in windows.video_metadata(videos, 5, 5).collect()}
    assert got["p"].scenes is None and got["q"].num_windows is None
    assert got["r"].num_windows == 6 and got["r"].windows[-1] == [25, 29] and got["r"].duration_sec == 3.0
    assert got["s"].num_windows == 0 and len(got["s"].scenes) == 1


def test_frame_numbers_against_python(spark):
    rows = [(t, n) for t in range(0, 41, 1) for n in range(0, 25, 3)]
    df = spark.createDataFrame(rows, "t int, n int")
    for t, n, u, p, c in df.select("t", "n", kernels.uniform_indices(df.t, df.n), kernels.frame_pairs(df.t, df.n), kernels.caption_indices(df.t, df.n)).collect():
        assert u == ([] if t <= 0 or n <= 0 else list(range(t)) if n >= t else [int(i * (t / n)) for i in range(n)])
        k = max(n, 1)
        stride = max(t // (k + 1), 1)
        assert p == ([] if t < 2 else [i * stride for i in range(k) if i * stride + 1 < t])
        want = [] if t <= 0 or n <= 0 else [t // 2] if n == 1 else sorted({min(int(round(i * max(t - 1, 1) / (n - 1))), t - 1) for i in range(n)})
        assert c == want


def test_polygons_and_sizes(spark):
    P = "array<struct<x:double,y:double>>"
    rows = [([], 0.0), ([(0.0, 0.0), (1.0, 1.0)], 0.0), ([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)], 4.0), ([(0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0), (0.0, 2.0)], 4.0)]
    df = spark.createDataFrame(rows, f"p {P}, want double")
    assert all(a == b for a, b in df.select(kernels.polygon_area(df.p), "want").collect())
    none = spark.createDataFrame([(None, 4, 4), ([rows[2][0], None], 4, 4), ([rows[2][0]], 0, 4)], f"ps array<{P}>, w int, h int")
    assert [r[0] for r in none.select(kernels.text_area_ratio(none.ps, none.w, none.h)).collect()] == [0.0, 0.25, 0.0]


def test_reasons_and_their_order(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, {"a": 1.0, "b": 1.0}), (2, {"a": nan, "b": 9.0}), (3, {"a": 1.0}), (4, {}), (5, None), (6, {"a": inf, "b": 1.0}), (7, {"a": 0.99, "b": 1.0}), (8, {"a": 1.0, "b": None})]
    df = spark.createDataFrame(rows, "id int, scores map<string,double>")
    got = {r.id: (r.keep, r.reason) for r in select.decide(df, select.score_reason(F.col("scores"), {"a": 1.0, "b": 1.0})).collect()}
    bad = (False, "scoring_error")
    assert got == {1: (True, None), 2: bad, 3: bad, 4: bad, 5: bad, 6: (True, None), 7: (False, "score_below_threshold"), 8: bad}
    assert select.decide(df, select.score_reason(F.col("scores"), {})).where("not keep").count() == 0
    got = {r.id: r.reason for r in select.decide(df, select.score_reason(F.col("scores"), {"a": 1.0, "b": 1.0}, "1 / (a - 1) >= 0")).collect()}
    assert got[1] == "strategy_error" and got[6] is None and got[7] == "strategy_filtered"
    flags = spark.createDataFrame([(True, True, True), (None, True, True), (None, None, True), (None, None, None)], "s boolean, f boolean, o boolean")
    plain = select.drop_reason(F.lit("x"), split_failed=F.col("s"), flash_hit=F.col("f"), ocr_hit=F.col("o"))
    kept = select.drop_reason(F.lit(None).cast("string"), split_failed=F.col("s"), flash_hit=F.col("f"), ocr_hit=F.col("o"), record_only=True, source_exists=F.lit(False))
    assert one(flags.select(plain, kept)) == [("split_failed", "split_failed"), ("flash", "source_missing"), ("ocr_text", "source_missing"), ("x", "source_missing")]


def test_records(spark):
    rows = [(3, "a", None), (1, "a", "t"), (2, "a", None), (4, "a", "t"), (5, None, None), (6, None, None)]
    df = spark.createDataFrame(rows, "n int, path string, text string")
    first = records.first_records(df, ["path", "text"], "n")
    assert first.columns == df.columns and sorted(one(first)) == [(1, "a", "t"), (2, "a", None), (5, None, None)]
    assert [r.n for r in records.limited(first, "n", 2).collect()] == [1, 2]
    assert records.limited(first, "n", -1).count() == 0
    assert sorted(one(records.pending(df, df.where("n = 2"), ["path", "text"]).select("n"))) == [(1,), (4,), (5,), (6,)]


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    rows = [(0 if i % 3 else i, i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "k int, v int").unionByName(spark.createDataFrame([(None, -1)], "k int, v int"))
    facts = df.where("k is not null").select("k").distinct().withColumn("f", F.col("k") * 2)
    got = skew.join_unique(df, facts, "k")
    assert got.count() == df.count() and got.where("f is distinct from k * 2").count() == 0


def test_chunks(spark):
    for n, k in ((0, 3), (9, 4), (77, 10), (80, 8), (3, 5)):
        df = spark.createDataFrame([(f"s{i:03d}",) for i in range(n)], "shard string").repartition(3)
        size = -(-n // k) or 1
        even = [r.chunk for r in partition.even_chunks(df, "shard", k).orderBy("shard").collect()]
        assert even == [i // size for i in range(n)]
        got = [r.chunk for r in partition.balanced_chunks(df, "shard", k).orderBy("shard").collect()]
        want = [c for c in range(k) for _ in range(n // k + (c < n % k))]
        assert got == want


def test_long_lists_are_numbered_in_parallel(spark):
    df = spark.range(0, 250_000, 1, 4).select(F.format_string("%08d", F.pmod(F.col("id") * 7919, F.lit(250_000))).alias("shard"))
    got = partition.numbered(df, "shard", parts=8)
    assert got.where("place <> cast(shard as bigint)").count() == 0 and got.count() == 250_000


def test_grid_and_quantiles(spark):
    rows = [({"d": 0.5, "a": 5.0}, True), ({"d": 0.5}, True), ({"d": math.nan, "a": 9.0}, False), (None, False), ({"d": 0.9, "a": 5.0}, None), ({"d": 0.9, "a": 5.0}, False)]
    df = spark.createDataFrame(rows, "scores map<string,double>, y boolean")
    got = {(r.d, r.a): (r.tp, r.fp, r.fn) for r in calibrate.threshold_grid(df, {"d": [0.4, 0.8], "a": [-1.0, 5.0]}, "y").collect()}
    assert got == {(0.4, -1.0): (2, 1, 0), (0.4, 5.0): (1, 1, 1), (0.8, -1.0): (0, 1, 2), (0.8, 5.0): (0, 1, 2)}
    q = {(r["name"], r.q): r.value for r in calibrate.quantiles(df, [0.5], ["d", "none"]).collect()}
    assert q == {("d", 0.5): 0.7}
    assert calibrate.quantiles(df.limit(0), [0.5]).count() == 0


def test_quantiles_are_exact_at_every_size(spark):
    n, qs = 5_000_050, [0.0, 0.1, 0.37, 0.5, 0.95, 1.0]
    big = spark.range(0, n, 1, 8).select(F.create_map(F.lit("big"), F.pmod(F.col("id") * 7919, F.lit(n)) * 1.5 - 1000.0).alias("scores"))
    small = [-math.inf, -3.0, -2.5, -0.0, 0.0, 1e-300, 1.0, 1.0, 1.001, 7.0]
    few = spark.createDataFrame([({"small": v},) for v in [*small, math.nan, None]], "scores map<string,double>")
    got = {(r["name"], r.q): r.value for r in calibrate.quantiles(big.unionByName(few), qs).collect()}

    def want(values, q):
        at = q * (len(values) - 1)
        low, high = values[math.floor(at)], values[math.ceil(at)]
        return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high

    line = [i * 1.5 - 1000.0 for i in range(n)]
    assert got == {(k, q): pytest.approx(want(v, q), rel=1e-12) for k, v in (("big", line), ("small", sorted(small))) for q in qs}


def test_caption_parsing(spark):
    bodies = {
        "plain text ": "plain text", '"quoted"': "quoted", '{"caption": "c", "text": "t"}': "c", '{"text": "t", "message": "m"}': "t", '{"own": "o", "caption": "c"}': "o",
        '{"z": {"k": 1}, "n": 5, "s": "x"}': "5", "{}": None, "   ": None, '{"caption": null, "text": "t"}': "t", "[1, 2]": None,
    }
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert {r.b: r.c for r in df.select("b", captions.parse_generic(df.b, "own").alias("c")).collect()} == bodies
    chats = {
        '{"choices": [{"message": {"content": " hi "}}]}': "hi", '{"choices": []}': None, "nonsense": None, '{"choices": [{"message": {"content": ""}}]}': None,
        '{"choices": [{"message": {"content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}]}}]}': "a\nb",
    }
    df = spark.createDataFrame([(b,) for b in chats], "b string")
    assert {r.b: r.c for r in df.select("b", captions.parse_chat(df.b).alias("c")).collect()} == chats
    body = df.limit(1).select(captions.request_body(F.lit("m"), F.lit("${SYS}"), F.lit("u"), F.array(F.lit(b"x")))).first()[0]
    assert '"role":"system"' not in body and "data:image/jpeg;base64,eA==" in body


def test_scorers_and_failures(spark):
    class Length:
        def score(self, records):
            if any(p == "bad" for p in records["video_path"]):
                raise ValueError("bad")
            return [float(len(p)) for p in records["video_path"]]

    edge.register_scorer("length", lambda options: Length())
    df = spark.createDataFrame([("a",), ("bad",), ("ccc",)], "video_path string")
    got = {r.video_path: r.scores for r in edge.score(df, [("len", "length", {}), ("d", "dummy", {})]).collect()}
    assert got == {"a": {"len": 1.0, "d": 1.0}, "bad": {"len": None, "d": 1.0}, "ccc": {"len": 3.0, "d": 1.0}}
    with pytest.raises(ValueError, match="supported: .*dummy"):
        edge.score(df, [("x", "unknown", {})])
    with pytest.raises(NotImplementedError):
        edge.score(df, [("x", "clip_text_consistency", {})])
    assert edge.score(df, []).first().scores == {}


def test_caption_provider_retries(spark, tmp_path):
    class Flaky:
        def caption(self, path, prompt, frames):
            mark = tmp_path / path
            if path == "never" or not mark.exists():
                mark.touch()
                raise RuntimeError("down")
            return f"{prompt}:{path}"

    edge.register_caption_provider("flaky", lambda options: Flaky())
    df = spark.createDataFrame([("x", "p"), ("never", "p")], "path string, prompt string")
    got = sorted(one(edge.caption(df, "flaky", {"wait": 0}, 1)))
    assert got == [("never", None, "down"), ("x", "p:x", None)]


def test_archives_and_links(tmp_path):
    assert edge.within("/a/b", "c/../d") and not edge.within("/a/b", "../bc/x") and not edge.within("/a", "/etc/x")
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("in/x.txt", "x")
    assert edge.extract(str(tmp_path / "ok.zip"), str(tmp_path / "out")) and not edge.extract(str(tmp_path / "ok.zip"), str(tmp_path / "out"))
    with tarfile.open(tmp_path / "bad.tar", "w") as t:
        t.add(tmp_path / "ok.zip", arcname="../x")
    with pytest.raises(ValueError):
        edge.extract(str(tmp_path / "bad.tar"), str(tmp_path / "out2"))
    src, dst = str(tmp_path / "out/in/x.txt"), str(tmp_path / "k/x.txt")
    assert edge.link_or_copy(src, dst) and not edge.link_or_copy(src, dst) and os.stat(src).st_nlink == 2
    assert edge.link_or_copy(src, dst + "2", copy=True) and os.stat(src).st_nlink == 2


def test_config(tmp_path):
    (tmp_path / "l.txt").write_text("a\n#b\n\nc\nd\n")
    c = config.from_dict({"shards_file": "l.txt", "limit_shards": 2, "models": [{"name": "m", "kind": "dummy", "threshold": 1, "num_frames": 3}], "selection": {"strategy": "m > 0"}, "other": 1}, str(tmp_path))
    assert c.shards == ["a", "c"] and c.models[0].extra == {"num_frames": 3} and c.thresholds() == {"m": 1.0} and c.selection.strategy == "m > 0"
    with pytest.raises(TypeError):
        config.from_dict({"ocr": {"nope": 1}})
    with pytest.raises(ValueError):
        config.from_dict({"caption": {"enabled": True}}).caption.stages()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    rows = [(i, {"a": float(i)}) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, scores map<string,double>")
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    df.where("id < 12").coalesce(1).write.parquet(src)
    run = lambda: ingest.select_stream(ingest.landing(spark, src, df.schema), {"a": 10.0}, out, check).awaitTermination()
    run()
    df.where("id >= 12").coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.where("keep").count() == 10
    copies = spark.createDataFrame([(1, None), (1, None), (1, ""), (2, "x")], "id int, t string")
    copies.write.parquet(str(tmp_path / "c"))
    new = ingest.new_records(ingest.landing(spark, str(tmp_path / "c"), copies.schema), ["id", "t"])
    seen = []
    ingest.each_batch(new, lambda b, i: seen.extend(one(b)), str(tmp_path / "check2")).awaitTermination()
    assert sorted(seen, key=str) == sorted([(1, None), (1, ""), (2, "x")], key=str)


def test_scene_spans_cover_the_video(spark):
    rows = spark.createDataFrame([("v", i, 90.0 if i in (20, 60) else 1.0) for i in range(100)] + [("w", i, 1.0) for i in range(10)], "path string, frame_idx int, content double")
    videos = spark.createDataFrame([("v", 10.0, 100), ("w", 10.0, 10)], "path string, fps double, total_frames int")
    got = sorted(one(scenes.scene_spans(rows, videos, "anything", 3.0, 15)))
    assert got == [("v", 0, 0.0, 2.0), ("v", 1, 2.0, 6.0), ("v", 2, 6.0, 10.0), ("w", 0, 0.0, 1.0)]


def test_small_control_plane_parts(spark, monkeypatch):
    lines = spark.createDataFrame([("0, 55 %, 100 MiB, 200 MiB, 60",), ("bad",), ("1, x, 1, 2, 3",)], "value string")
    assert one(progress.gpu_samples(lines)) == [(0, 55.0, 100.0, 200.0, 60.0)]
    pinned = spark.createDataFrame([("a", "abc"), ("b", "abc"), ("c", None), ("d", "x")], "name string, commit string")
    heads = spark.createDataFrame([("a", "abcdef"), ("b", "xyz")], "name string, commit string")
    assert {r.name: r.ok for r in progress.pinned_checks(pinned, heads).collect()} == {"a": True, "b": False, "c": True, "d": False}
    assert sink.pending_kinds(["x", "y", "x2", "y"], {"x2": "x"}) == ["x", "y"]
    for value, want in (("", False), ("off", False), ("No", False), ("1", True), ("yes", True)):
        monkeypatch.setenv("CLIPLOOM_T", value)
        assert config.env_flag("CLIPLOOM_T", True) is want
    monkeypatch.delenv("CLIPLOOM_T")
    assert config.env_flag("CLIPLOOM_T", True)
    states = spark.createDataFrame([(True, True, True, True), (True, True, True, False), (True, None, None, None)], "downloaded boolean, extracted boolean, scored boolean, uploaded boolean")
    assert [r[0] for r in states.select(progress.next_action()).collect()] == ["skip", "upload", "extract"]
    assert [r[0] for r in states.select(progress.next_action(calibrating=True)).collect()] == ["process", "process", "extract"]


def test_written_tables_are_released(spark):
    from cliploom import session

    t = session.write_table(spark.range(3).toDF("id"), "t")
    assert t.count() == 3 and session.release(spark) >= 1 and session.release(spark) == 0


def test_parse_generic_response_reads_every_caption(spark, tmp_path):
    texts = ["plain", 'says "hi"', "```json\nfenced\n```", "back\\slash \\n", "two\nlines\ttab", '{"caption": "wrapped"}', "", "  blank ends ", "[x]", "null", "5", None]
    rows = [(4 * i + k, t) for i, t in enumerate(texts) for k in range(4)]
    spark.createDataFrame(rows, "caption_id bigint, caption string").write.parquet(f"{tmp_path}/clip_captions.parquet")
    got = {r.caption_id: r.content for r in pipeline.parse_generic_response(spark, str(tmp_path)).collect()}

    def brute(i, t):
        k = i % 4
        if k == 3:
            return None if t is None else f"~{t}".strip() or None
        if t is None:  # an object has its id left, a JSON null nothing
            return "7" if k < 2 else None
        return t.strip() or None

    assert {i: got.get(i, "no row") for i, _ in rows} == {i: brute(i, t) for i, t in rows}


def test_rows_without_a_valid_branch_or_frame_rate_stay(spark, tmp_path):
    rows = [(1, 25.0, {"dover": 0.5, "dover_tech": math.nan}), (2, 0.0, {"dover": math.nan}), (3, None, {"dover": 0.5}), (4, -1.0, None)]
    df = spark.createDataFrame(rows, "clip_id bigint, fps double, scores map<string,double>").selectExpr("*", "300 as total_frames", "64 as width", "64 as height")
    df.write.parquet(f"{tmp_path}/clip_results.parquet")
    fused = {r.clip_id: r.fused for r in selection.fused_score(spark, str(tmp_path)).collect()}
    assert sorted(fused) == [1, 2, 3, 4] and math.isnan(fused[1]) and math.isnan(fused[2]) and fused[3] == 0.5 and fused[4] is None
    got = pipeline.scene_windows(spark, str(tmp_path)).collect()
    assert sorted((r.clip_id, r.scene, r.num_windows) for r in got if r.clip_id == 1) == [(1, 0, 7), (1, 1, 2)]
    assert sorted(tuple(r) for r in got if r.clip_id != 1) == [(i, None, None, None, None) for i in (2, 3, 4)]
