"""Directory listings and line lists. Contents are never read: only path, length and time are selected."""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.functions.text import base_name, stem, strip, suffix
from cliploom.session import is_folder

#: Extensions of videos and of archives.
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv", ".webm", ".flv", ".wmv", ".m4v")
ARCHIVE_SUFFIXES = (".zip", ".gz", ".tar", ".tgz")
LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modificationTime", T.TimestampType())])


def listing(spark: SparkSession, roots: Iterable[str], recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of the files under local or shared folders; missing roots warn and are skipped.

    Files without any content are not listed, as the file source plans no read for them.
    """
    good = []
    for r in roots:
        if is_folder(r):
            good.append(r)
        else:
            warnings.warn(f"not a folder, skipped: {r}", stacklevel=2)
    if not good:
        return spark.createDataFrame([], LISTING)
    good = [r.rstrip("/") if "://" in r else os.path.abspath(r) for r in good]
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(good)
    rows = read.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime")
    return rows if recursive else rows.where(F.regexp_replace("path", "/[^/]+$", "").isin(good))


def is_video(path: Column, excluded: Iterable[str] = ()) -> Column:
    """A video's suffix, in no folder of the excluded names."""
    ok = suffix(path).isin(*VIDEO_SUFFIXES)
    for d in excluded:
        ok = ok & ~F.array_contains(F.split(path, "/"), d)
    return ok


def videos(spark: SparkSession, roots: Iterable[str], recursive: bool = True, excluded: Iterable[str] = ()) -> DataFrame:
    """Video records (video_path, text, meta, bytes); a path alone has no text and no meta."""
    rows = listing(spark, roots, recursive).where(is_video(F.col("path"), excluded))
    return rows.select(F.col("path").alias("video_path"), F.lit(None).cast("string").alias("text"), F.create_map().cast("map<string,string>").alias("meta"), F.col("length").alias("bytes"))


def archives(spark: SparkSession, root: str) -> DataFrame:
    """Names of archives directly in a folder, in order."""
    rows = listing(spark, [root], recursive=False).select(base_name(F.col("path")).alias("shard"))
    return rows.where(suffix(F.col("shard")).isin(*ARCHIVE_SUFFIXES)).orderBy("shard")


def shard_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Shard names of text lines; blank ones and those that begin with # are left out."""
    return lines.select(strip(F.col(column)).alias("shard")).where((F.length("shard") > 0) & ~F.col("shard").startswith("#"))


def shard_list(spark: SparkSession, path: str | None = None, inline: Iterable[str] = (), missing_ok: bool = False) -> DataFrame:
    """Shards of a list file, which overrides the inline list; a missing file is an error unless allowed."""
    if path is None:
        return shard_lines(spark.createDataFrame([(s,) for s in inline], "value string"))
    if "://" not in path and not os.path.exists(path):
        if not missing_ok:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], "shard string")
    return shard_lines(spark.read.text(path))


def states(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """State files ``<shard>.json`` with shard and modification time; unreadable ones are left out."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*[f for f in kind.fields if f.name != "shard"], T.StructField("_bad", T.StringType())])
    rows = spark.read.schema(full).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", "*.json").json(folder)
    rows = rows.select("*", stem(F.col("_metadata.file_name")).alias("shard"), F.col("_metadata.file_modification_time").alias("mtime"))
    return rows.where("_bad is null").drop("_bad").orderBy("shard")


def upload_manifest(files: DataFrame, root: Column | str, patterns: Iterable[str]) -> DataFrame:
    """(path, bytes): files matching any pattern, relative to the root; one row for each pattern that matches.

    ``*`` stays within a folder, ``**`` crosses folders, ``?`` is one character.
    """
    base = root if isinstance(root, Column) else F.lit(root.rstrip("/") + "/")
    relative = F.when(F.startswith(F.col("path"), base), F.substring(F.col("path"), F.length(base) + 1, F.length("path"))).otherwise(F.col("path"))
    hits = F.array_compact(F.array(*[F.when(relative.rlike(glob_regex(p)), F.lit(p)) for p in patterns]))
    return files.select(relative.alias("path"), F.col("length").alias("bytes"), F.explode(hits).alias("pattern")).drop("pattern")


def glob_regex(pattern: str) -> str:
    """A glob as a regular expression over a whole relative path."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            c = pattern[i]
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(c, "\\" + c if not c.isalnum() and c not in "_/" else c), i + 1
    return f"^{out}$"
