"""Plug-in interfaces for what the relational core can't do: decoding, models, text recognition, network, transcoding.

A scorer, splitter or caption provider is registered under its kind. It runs in ``mapInPandas``: created once in each
Python worker, fed batches, and a failing item gives a null instead of ending the task.
"""

from __future__ import annotations

import os
import shutil
import tarfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import PurePosixPath
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Scorer(Protocol):
    """Scores a batch of records (video_path, text, meta); as many numbers as records, None for a failure."""

    def score(self, records: pd.DataFrame) -> Sequence[float | None]: ...


class CaptionProvider(Protocol):
    """Captions a batch of paths with a prompt each; raises for a failing item."""

    def caption(self, path: str, prompt: str, frames: Sequence[bytes]) -> str: ...


ScorerFactory = Callable[[dict[str, Any]], Scorer]
_columns: dict[str, Callable[[dict[str, Any]], Column]] = {}
_scorers: dict[str, ScorerFactory] = {}
_captions: dict[str, Callable[[dict[str, Any]], CaptionProvider]] = {}
_splitters: dict[str, Callable[..., DataFrame]] = {}


def register_scorer(kind: str, factory: ScorerFactory) -> None:
    _scorers[kind] = factory


def register_column_scorer(kind: str, make: Callable[[dict[str, Any]], Column]) -> None:
    """A scorer that is a Column expression and needs no Python worker."""
    _columns[kind] = make


def register_caption_provider(name: str, factory: Callable[[dict[str, Any]], CaptionProvider]) -> None:
    _captions[name] = factory


def register_splitter(kind: str, split: Callable[..., DataFrame]) -> None:
    _splitters[kind] = split


def _unsupported(_: dict[str, Any]) -> Column:
    raise NotImplementedError("this consistency scorer needs a model that isn't available")


#: Stubs, which need no model, and the checks still to be made that they stand for.
STUBS = {"clip_consistency_stub": "clip_text_consistency", "egovideo_consistency_stub": "egovideo_text_consistency"}
for _kind in ("dummy", *STUBS):
    register_column_scorer(_kind, lambda options: F.lit(1.0))
for _kind in ("clip_text_consistency", "egovideo_text_consistency"):
    register_column_scorer(_kind, _unsupported)


def splitter(kind: str) -> Callable[..., DataFrame] | None:
    """The splitter registered under ``kind``, which then takes the place of the built-in one."""
    return _splitters.get(kind)


class FrameReader(Protocol):
    """Decodes frames of a clip: how many it has, and some of them as JPEG no larger than ``max_side``."""

    def total(self, path: str) -> int: ...
    def jpeg(self, path: str, frames: Sequence[int], max_side: int) -> Sequence[bytes]: ...


_readers: dict[str, Callable[[dict[str, Any]], FrameReader]] = {}


def register_frame_reader(name: str, factory: Callable[[dict[str, Any]], FrameReader]) -> None:
    _readers[name] = factory


def caption_frames(total: int, wanted: int) -> list[int]:
    """Frame numbers for a caption: evenly from the first to the last, the middle one if one is wanted."""
    if total <= 0 or wanted <= 0:
        return []
    if wanted == 1:
        return [total // 2]
    return sorted({min(round(i * (total - 1) / (wanted - 1)), total - 1) for i in range(wanted)})


def read_frames(clips: DataFrame, name: str, options: dict[str, Any], num_frames: int, max_side: int) -> DataFrame:
    """``clips`` (path, ...) with ``frames``; whatever fails in decoding a clip leaves it without pictures."""
    factory = _readers[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = None
        for batch in batches:
            out = []
            for path in batch["path"]:
                try:
                    reader = reader or factory(options)  # once a worker
                    out.append([bytes(b) for b in reader.jpeg(path, caption_frames(reader.total(path), num_frames), max_side)])
                except Exception:
                    out.append([])
            yield batch.assign(frames=out)

    return clips.mapInPandas(run, T.StructType([*clips.schema.fields, T.StructField("frames", T.ArrayType(T.BinaryType()))]))


def has_frame_reader(name: str) -> bool:
    return name in _readers


class Uploader(Protocol):
    """Sends a file to a remote place; must bear being repeated."""

    def upload(self, path: str, target: str) -> None: ...


class Downloader(Protocol):
    """Fetches a shard's archive to a local path; returns whether there was one."""

    def download(self, shard: str, path: str) -> bool: ...


_uploaders: dict[str, Callable[[dict[str, Any]], Uploader]] = {}
_downloaders: dict[str, Callable[[dict[str, Any]], Downloader]] = {}


def register_uploader(name: str, factory: Callable[[dict[str, Any]], Uploader]) -> None:
    _uploaders[name] = factory


def register_downloader(name: str, factory: Callable[[dict[str, Any]], Downloader]) -> None:
    _downloaders[name] = factory


def _attempts(call: Callable[[], Any], retry: int, wait: float) -> tuple[Any, str | None]:
    """(result, error) of a call with ``retry`` further attempts."""
    import time

    for attempt in range(retry + 1):
        try:
            return call(), None
        except Exception as e:
            error = str(e) or type(e).__name__
            if attempt < retry:
                time.sleep(wait)
    return None, error


def transfer(files: DataFrame, kind: str, name: str, options: dict[str, Any], retry: int = 2) -> DataFrame:
    """``files`` (source, target, ...) with ``done`` and ``error``: uploaded or downloaded on the executors, each with
    ``retry`` further attempts; a failure is a row, not the end of the job."""
    table = {"upload": _uploaders, "download": _downloaders}[kind]
    if name not in table:
        raise ValueError(f"unsupported {kind} {name}; supported: {', '.join(sorted(table))}")
    factory = table[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mover = None
        for batch in batches:
            got = []
            for r in batch.itertuples():
                def call(r=r):
                    nonlocal mover
                    mover = mover or factory(options)  # once a worker
                    done = mover.upload(r.source, r.target) if kind == "upload" else mover.download(r.source, r.target)
                    return True if kind == "upload" else bool(done)

                got.append(_attempts(call, retry, float(options.get("wait", 1.0))))
            yield batch.assign(done=[bool(d) for d, _ in got], error=[e for _, e in got])

    schema = T.StructType([*files.schema.fields, T.StructField("done", T.BooleanType()), T.StructField("error", T.StringType())])
    return files.mapInPandas(run, schema)


def clean(paths: DataFrame, root: str) -> None:
    """Delete the files and folders of a column ``path`` that lie under ``root``; missing ones are no error."""
    base = os.path.realpath(root)

    def run(part: Iterator) -> None:
        for r in part:
            p = os.path.realpath(r["path"]) if r["path"] else base
            if p != base and p.startswith(base + os.sep):
                shutil.rmtree(p, ignore_errors=True) if os.path.isdir(p) else os.path.exists(p) and os.remove(p)

    paths.select("path").foreachPartition(run)


def caption_provider(name: str, options: dict[str, Any]) -> CaptionProvider:
    if name not in _captions:
        raise ValueError(f"unsupported caption provider {name}; supported: {', '.join(sorted(_captions))}")
    return _captions[name](options)


def supported_kinds() -> list[str]:
    return sorted({*_columns, *_scorers})


def check_kinds(kinds: Sequence[str]) -> None:
    for k in kinds:
        if k not in _columns and k not in _scorers:
            raise ValueError(f"unsupported model kind {k}; supported: {', '.join(supported_kinds())}")


def _score_batches(factory: ScorerFactory, options: dict[str, Any]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer: Scorer | None = None
        broken = False
        for batch in batches:
            values: list[float | None]
            if scorer is None and not broken:
                try:
                    scorer = factory(options)  # once a worker, when the first batch comes
                except Exception:
                    broken = True
            if scorer is None:
                yield batch.assign(score=pd.Series([None] * len(batch), index=batch.index, dtype="float64"), init_failed=True)
                continue
            try:
                values = list(scorer.score(batch))
                if len(values) != len(batch):
                    raise ValueError(f"{len(values)} scores for {len(batch)} records")
            except Exception:
                values = []
                for i in range(len(batch)):
                    try:
                        values.append(list(scorer.score(batch.iloc[[i]]))[0])
                    except Exception:
                        values.append(None)  # becomes a scoring error of this record alone
            yield batch.assign(score=pd.Series(values, index=batch.index, dtype="float64"), init_failed=False)

    return run


def score(records: DataFrame, models: Sequence[tuple[str, str, dict[str, Any]]], init_failed: str | None = None) -> DataFrame:
    """``records`` (video_path, text, meta, ...) with ``scores``, a map by model name; models are (name, kind, options).

    ``init_failed`` names a column that tells whether a scorer of the record could not be started; its scores are null.
    Filter before this call: a Python step is not skipped for rows that a later filter drops.
    """
    check_kinds([kind for _, kind, _ in models])
    out, names = records, list(dict.fromkeys(name for name, _, _ in models))
    last, flags = {name: (kind, options) for name, kind, options in models}, []
    for name in names:
        kind, options = last[name]
        if kind in _columns:
            out = out.withColumn(f"__s_{name}", _columns[kind](options))
        else:
            schema = T.StructType([*out.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("init_failed", T.BooleanType())])
            out = out.mapInPandas(_score_batches(_scorers[kind], options), schema).withColumnRenamed("score", f"__s_{name}").withColumnRenamed("init_failed", f"__i_{name}")
            flags.append(f"__i_{name}")
    pairs = [x for name in names for x in (F.lit(name), F.col(f"`__s_{name}`").cast("double"))]
    scores = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    out = out.withColumn("scores", scores)
    if init_failed:
        failed = F.lit(False)
        for f in flags:
            failed = failed | F.col(f"`{f}`")
        out = out.withColumn(init_failed, failed)
    return out.drop(*[f"__s_{name}" for name in names], *flags)


def _caption_batches(factory: Callable[[dict[str, Any]], CaptionProvider], options: dict[str, Any], retry: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        provider = None
        for batch in batches:
            provider = provider or factory(options)  # once a worker; the registry lives on the driver
            done, errors = [], []
            for r in batch.itertuples():
                said, error = None, None
                for attempt in range(retry + 1):
                    try:
                        said, error = provider.caption(r.path, r.prompt, list(getattr(r, "frames", None) or [])), None
                        break
                    except Exception as e:
                        error = str(e) or type(e).__name__
                        if attempt < retry:
                            time.sleep(float(options.get("wait", 1.0)))
                done.append(said)
                errors.append(error)
            yield batch[["path"]].assign(response=done, error=errors)

    return run


def caption(clips: DataFrame, provider: str, options: dict[str, Any], retry: int = 1) -> DataFrame:
    """(path, response, error) of each clip (path, prompt, frames?), with ``retry`` further attempts."""
    if provider not in _captions:
        raise ValueError(f"unsupported caption provider {provider}; supported: {', '.join(sorted(_captions))}")
    return clips.mapInPandas(_caption_batches(_captions[provider], options, retry), "path string, response string, error string")


# File work, one call per file, made to be repeated safely


def within(root: str, member: str) -> bool:
    """Whether an archive member stays inside the folder, by path components."""
    p = PurePosixPath(member)
    if p.is_absolute():
        return False
    depth = 0
    for part in p.parts:
        depth += -1 if part == ".." else 0 if part == "." else 1
        if depth < 0:
            return False
    return True


def extract(archive: str, folder: str) -> bool:
    """Extract an archive unless its success marker exists; True if it was done now."""
    marker = os.path.join(folder, "_EXTRACTED")
    if os.path.exists(marker):
        return False
    shutil.rmtree(folder, ignore_errors=True)
    os.makedirs(folder)
    if archive.endswith(".zip"):
        with zipfile.ZipFile(archive) as z:
            if bad := [n for n in z.namelist() if not within(folder, n)]:
                raise ValueError(f"member leaves the folder: {bad[0]}")
            z.extractall(folder)
    elif archive.endswith((".tar", ".gz", ".tgz", ".bz2")):
        with tarfile.open(archive) as t:
            if bad := [m.name for m in t.getmembers() if not within(folder, m.name)]:
                raise ValueError(f"member leaves the folder: {bad[0]}")
            t.extractall(folder, filter="data")
    else:
        shutil.unpack_archive(archive, folder)
    open(marker, "w").close()
    return True


def link_or_copy(source: str, target: str, copy: bool = False) -> bool:
    """Put a file at the target as a hard link, or as a copy where links fail or are not wanted; an existing one stays."""
    if os.path.exists(target):
        return False
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    work = f"{target}.part"
    if os.path.exists(work):
        os.remove(work)
    if not copy:
        try:
            os.link(source, work)
        except OSError:
            copy = True
    if copy:
        shutil.copy2(source, work)
    os.replace(work, target)
    return True


@F.arrow_udf(T.BooleanType())
def exists(paths: pa.Array) -> pa.Array:
    """Whether there is a file at each path or URI, asked on the executors; a null path has none."""
    out = []
    for p in paths.to_pylist():
        if p is None:
            out.append(False)
        elif "://" in p or p.startswith("file:"):
            from pyarrow import fs

            try:
                system, at = fs.FileSystem.from_uri(p)
                out.append(system.get_file_info(at).type != fs.FileType.NotFound)
            except (OSError, pa.ArrowInvalid):
                out.append(False)
        else:
            out.append(os.path.exists(p))
    return pa.array(out, pa.bool_())


def materialize(rows: DataFrame, source: str, target: str, copy: bool = False) -> None:
    """Link or copy the files of rows to their targets on the executors; repeated tasks do no harm."""

    def run(part: Iterator) -> None:
        for r in part:
            if r[source] and r[target] and os.path.exists(r[source]):
                link_or_copy(r[source], r[target], copy)

    rows.select(source, target).foreachPartition(run)


def cut_command(video: str, start: float, end: float, target: str) -> list[str]:
    """Command that copies a scene out of a video."""
    return ["ffmpeg", "-y", "-ss", f"{start:.3f}", "-i", video, "-t", f"{max(end - start, 0.001):.3f}", "-c", "copy", target]


def scale_command(video: str, target: str, height: int = 720) -> list[str]:
    """Command that transcodes a video to a height."""
    return ["ffmpeg", "-y", "-i", video, "-vf", f"scale=-2:{height}", "-c:a", "copy", target]


from cliploom.edge import scorers as _scorer_kinds  # noqa: E402,F401  (registers the model-backed kinds)
