"""Clip manifests (CSV, JSON lines) and metadata files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.functions.text import strip
from cliploom.session import is_folder

RECORD = "video_path string, text string, meta map<string,string>"
METADATA = (
    "source_path string, output_path string, size_bytes bigint, scores map<string,double>, keep boolean, reason string, "
    "flash_hit boolean, ocr_hit boolean, caption string, fps double, total_frames int, duration_sec double, width int, "
    "height int, num_windows int, text string, meta map<string,string>, index bigint"
)


def collapsed(path: Column) -> Column:
    """A path without empty, ``.`` and ``..`` parts, as far as the root; the scheme and host of a URI stay."""
    head = F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    parts = F.split(F.substring(path, F.length(head) + 1, F.length(path)), "/")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when((part == "") | (part == "."), kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    clean = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"/\.{0,2}(/|$)"), F.concat(head, F.lit("/"), F.array_join(clean, "/"))).otherwise(path)


def resolved(path: Column, base: str) -> Column:
    """A path with ``~`` expanded and without ``.`` and ``..``; a relative one is taken from ``base``."""
    home = F.lit(os.path.expanduser("~"))
    p = F.when(path.startswith("~/"), F.concat(home, F.substring(path, 2, 1_000_000))).when(path == "~", home).otherwise(path)
    return collapsed(F.when(p.startswith("/") | p.contains("://"), p).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), p)))


def with_lines(lines: DataFrame) -> DataFrame:
    """Lines read as text with ``line``, their number in the file from 1; the file is read twice.

    Each block of a file is read in order by one task, so a line's number is its place there and the lines before, of
    which one number a block is broadcast.
    """
    at = lines.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    sizes = at.groupBy("__file", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__file", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    return at.join(F.broadcast(starts), ["__file", "__block"]).select(*lines.columns, (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line"))


def json_records(lines: DataFrame, base: str, path_field: str = "video_path", text_field: str = "text") -> DataFrame:
    """Records of JSON lines (column ``value``, optionally ``line`` for messages).

    Blank lines are skipped. A line that is no object or lacks the path fails the read, naming the line; other fields
    become meta, nested ones as JSON text.
    """
    row = lines.where(F.length(strip(F.col("value"))) > 0)
    where = F.col("line").cast("string") if "line" in lines.columns else F.lit("?")
    got = row.select(F.from_json("value", "map<string,string>").alias("m"), where.alias("at"), *(["line"] if "line" in lines.columns else []))
    path = F.try_element_at("m", F.lit(path_field))
    checked = F.when(F.length(path) > 0, path).otherwise(F.raise_error(F.concat(F.lit("manifest line "), F.col("at"), F.lit(f" has no {path_field}"))))
    return got.select(
        resolved(checked, base).alias("video_path"),
        F.try_element_at("m", F.lit(text_field)).alias("text"),
        F.map_filter("m", lambda k, v: ~k.isin(path_field, text_field)).alias("meta"),
        *(["line"] if "line" in lines.columns else []),
    )


def csv_records(rows: DataFrame, base: str, path_field: str = "video_path", text_field: str = "text") -> DataFrame:
    """Records of a CSV table read with a header; an empty text is null, other columns become meta."""
    rest = [c for c in rows.columns if c not in (path_field, text_field)]
    path = F.col(f"`{path_field}`")
    checked = F.when(F.length(path) > 0, path).otherwise(F.raise_error(F.lit(f"a manifest row has no {path_field}")))
    text = F.col(f"`{text_field}`") if text_field in rows.columns else F.lit(None).cast("string")
    meta = F.create_map(*[x for c in rest for x in (F.lit(c), F.col(f"`{c}`"))]) if rest else F.create_map().cast("map<string,string>")
    return rows.select(resolved(checked, base).alias("video_path"), F.when(F.length(text) > 0, text).alias("text"), F.map_filter(meta, lambda k, v: v.isNotNull()).alias("meta"))


def read_manifest(spark: SparkSession, path: str, path_field: str = "video_path", text_field: str = "text") -> DataFrame:
    """Records of a manifest file by its suffix."""
    base, kind = os.path.dirname(path if "://" in path else os.path.abspath(path)), os.path.splitext(path)[1].lower()
    if kind in (".jsonl", ".ndjson"):
        return json_records(with_lines(spark.read.text(path)), base, path_field, text_field)
    if kind == ".csv":
        return csv_records(spark.read.csv(path, header=True, multiLine=True, escape='"'), base, path_field, text_field)
    raise ValueError(f"a manifest must be .jsonl or .csv: {path}")


def read_metadata(spark: SparkSession, path: str, schema: T.StructType | str = METADATA) -> DataFrame:
    """All ``metadata.jsonl`` files under a folder, or one file; malformed lines and rows without a source are left out."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    read = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    if is_folder(path):
        read = read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    return read.json(path).where("_bad is null and source_path is not null").drop("_bad")
