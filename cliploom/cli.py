"""Command line: python -m cliploom.cli {filter,caption,full,offline-filter,calibrate,grid-search,monitor,split,upload-manifest,doctor} ..."""

from __future__ import annotations

import argparse
import importlib.util
import json
import shutil
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom import config as configuration
from cliploom.session import local_session

STATE = (
    "downloaded boolean, extracted boolean, scored boolean, uploaded boolean, stage string, started_at double, finished_at double, "
    "progress struct<videos_total:int,videos_done:int,clips_queued:int,clips_scored:int,queue_pending:int,last_video:string,last_step:string>"
)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cliploom")
    p.add_argument("--cores", default="*")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("offline-filter", help="score and select records of a manifest or folders")
    a.add_argument("--config", required=True)
    a.add_argument("--manifest")
    a.add_argument("--input-dir", action="append", default=[])
    a.add_argument("--no-recursive", action="store_true")
    a.add_argument("--limit", type=int)
    a.add_argument("--output")
    a.add_argument("--no-resume", action="store_true")
    a.add_argument("--strategy")
    a.add_argument("--copy", action="store_true")
    a = sub.add_parser("calibrate", help="quantiles of each score")
    a.add_argument("--metadata", required=True)
    a.add_argument("--output")
    a.add_argument("--sample-size", type=int, default=10_000)
    a.add_argument("--quantiles", default="0.4,0.7")
    a = sub.add_parser("grid-search", help="precision and recall of threshold combinations against a label")
    a.add_argument("--metadata", required=True)
    a.add_argument("--label", default="keep_gt")
    a.add_argument("--labels", help="CSV or parquet with the label of each key, if the metadata has none")
    a.add_argument("--key", default="source_path")
    a.add_argument("--grid", required=True, help='JSON, such as {"aes": [4, 5]}')
    a.add_argument("--output")
    a = sub.add_parser("monitor", help="progress of shard states")
    a.add_argument("--state-dir", required=True)
    a = sub.add_parser("split", help="divide a shard list among workers")
    a.add_argument("--shards", required=True)
    a.add_argument("--workers", type=int, required=True)
    a.add_argument("--devices", type=int, default=1)
    a.add_argument("--balanced", action="store_true")
    a = sub.add_parser("upload-manifest", help="files to upload")
    a.add_argument("--folder", required=True)
    a.add_argument("--pattern", action="append", default=[])
    a.add_argument("--output", required=True)
    for name, about in (("filter", "split, filter, score and decide shards of frame features"), ("caption", "caption kept clips"), ("full", "filter, then caption")):
        a = sub.add_parser(name, help=about)
        a.add_argument("--config", required=True)
        a.add_argument("--videos", help="parquet: shard, path, fps, total_frames, width, height, size_bytes")
        a.add_argument("--frames", help="parquet: path, frame_idx and features of frames")
        a.add_argument("--output", required=True)
    sub.add_parser("doctor", help="check what is installed")
    return p


def doctor() -> list[tuple[str, bool, str]]:
    """(name, ok, detail) of each check."""
    found = [(m, importlib.util.find_spec(m) is not None, "python package") for m in ("pyspark", "pyarrow", "pandas", "numpy", "yaml")]
    return [*found, *[(x, shutil.which(x) is not None, shutil.which(x) or "not found") for x in ("java", "ffmpeg")]]


def _print(rows: DataFrame) -> None:
    """All rows, a line each, as they come."""
    print("\t".join(rows.columns))
    for r in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in r))


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "doctor":
        checks = doctor()
        for name, ok, detail in checks:
            print(f"{'ok' if ok else 'MISSING':8}{name}  {detail}")
        print(f"{sum(ok for _, ok, _ in checks)}/{len(checks)} passed")
        return int(not all(ok for _, ok, _ in checks))
    spark = local_session(args.cores)
    spark.sparkContext.setLogLevel("ERROR")
    from cliploom.operators import calibrate, partition, progress
    from cliploom.sinks import metadata as sink
    from cliploom.sources import files, manifests

    if args.command == "offline-filter":
        from cliploom.plans.offline import Job, run

        job = Job(args.manifest, args.input_dir, not args.no_recursive, args.limit, args.output, not args.no_resume, args.strategy, args.copy)
        print(json.dumps(run(spark, configuration.load(args.config), job), ensure_ascii=False, indent=2))
    elif args.command == "calibrate":
        rows = calibrate.capped(manifests.read_metadata(spark, args.metadata), ["source_path"], args.sample_size)
        if args.output:
            sink.write_calibration(rows, args.output)
        _print(calibrate.quantiles(rows, [float(q) for q in args.quantiles.split(",")]).orderBy("name", "q"))
    elif args.command == "grid-search":
        if args.labels:
            read = spark.read.parquet(args.labels) if args.labels.endswith(".parquet") else spark.read.csv(args.labels, header=True)
            rows = calibrate.with_labels(manifests.read_metadata(spark, args.metadata), read, args.key, args.label)
        else:
            rows = manifests.read_metadata(spark, args.metadata, f"{manifests.METADATA}, {args.label} boolean")
        grid = json.loads(args.grid)
        table = calibrate.threshold_grid(rows, grid, args.label)
        if args.output:
            sink.write_grid(table, args.output)
        calibrate.best_thresholds(table, list(grid)).orderBy("place").show(10, False)
    elif args.command == "monitor":
        states = files.states(spark, args.state_dir, STATE).cache()
        progress.flag_totals(states).show()
        _print(progress.stage_counts(states).orderBy("place"))
        progress.average_duration(states).show()
        progress.oldest_active(states, "mtime").select("shard", "stage", "mtime").show(5, False)
    elif args.command == "split":
        shards = files.shard_list(spark, args.shards)
        divide = partition.balanced_chunks if args.balanced else partition.even_chunks
        divided = divide(shards, "shard", args.workers).withColumn("device", partition.round_robin(F.col("chunk"), args.devices)).orderBy("place")
        _print(divided)
    elif args.command in ("filter", "caption", "full"):
        from cliploom.plans import shards as plan

        conf = configuration.load(args.config)
        if args.command != "caption":
            log = plan.run(spark, conf, spark.read.parquet(args.videos), spark.read.parquet(args.frames), args.output)
            print(json.dumps(log, ensure_ascii=False, indent=2))
        if args.command != "filter":
            plan.caption_kept(spark, conf, args.output)
    elif args.command == "upload-manifest":
        files.upload_manifest(files.listing(spark, [args.folder]), args.folder, args.pattern or ["**/*"]).write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
