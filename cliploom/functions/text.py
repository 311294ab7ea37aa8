"""String kernels: coercion of cells, keys, paths, URLs, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal literals that Python's float() takes, after trimming; Spark's cast takes others ("5d") and fewer ("1_000").
FLOAT = r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
INTEGER = r"^[+-]?\d+(_\d+)*$"


def strip(s: Column) -> Column:
    """Without white space of any kind on both ends."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def try_float(s: Column) -> Column:
    """The number a string stands for, or null; infinities and NaN by name included."""
    t = F.lower(strip(s))
    sign = F.when(t.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return (
        F.when(t.rlike(FLOAT), F.regexp_replace(t, "_", "").try_cast("double"))
        .when(t.rlike(r"^[+-]?(inf|infinity)$"), sign * F.lit(float("inf")))
        .when(t.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
    )


def to_context_number(s: Column) -> Column:
    """Value of a meta cell for expressions: blank is null, true/false are 1/0, else the number or null."""
    t = F.lower(strip(s))
    return F.when(t == "true", F.lit(1.0)).when(t == "false", F.lit(0.0)).otherwise(try_float(s))


def meta_cell(s: Column) -> Column:
    """A manifest cell as a struct (kind, text, number): bool, float (with a point), int, or the string as it is.

    A blank cell stays a string; so does what doesn't parse.
    """
    t = strip(s)
    low = F.lower(t)
    is_bool, is_float = low.isin("true", "false"), t.contains(".") & try_float(t).isNotNull()
    is_int = ~t.contains(".") & t.rlike(INTEGER)
    kind = F.when(s.isNull(), F.lit(None)).when(is_bool, "bool").when(is_float, "float").when(is_int, "int").otherwise("string")
    number = F.when(is_bool, (low == "true").cast("double")).when(is_float | is_int, try_float(t))
    return F.struct(kind.alias("kind"), s.alias("text"), number.alias("number"))


def normalise_key(k: Column) -> Column:
    """A key as a name: trimmed, other characters to one underscore, ``v_`` before a digit; null if nothing is left."""
    s = F.regexp_replace(strip(k), r"(?U)\W+", "_")
    return F.when(F.length(s) > 0, F.when(s.rlike(r"(?U)^\d"), F.concat(F.lit("v_"), s)).otherwise(s))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Last extension with its point, lower case; empty for none and for names that only begin with a point."""
    name = base_name(path)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^./]+)$", 1))


def stem(path: Column) -> Column:
    name = base_name(path)
    return F.when(name.rlike(r"^.+\.[^./]+$"), F.regexp_replace(name, r"\.[^./]+$", "")).otherwise(name)


def output_name(index: Column, path: Column) -> Column:
    """``00000012_name.mp4``; a wider index keeps its digits."""
    digits = index.cast("string")
    return F.concat(F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits), F.lit("_"), base_name(path))


def scene_name(path: Column, number: Column) -> Column:
    """Name of a cut scene: ``clip_scene_0003.mp4``."""
    name = base_name(path)
    return F.format_string("%s_scene_%04d%s", stem(path), number.cast("int"), F.regexp_extract(name, r"^.+(\.[^./]+)$", 1))


def age(seconds: Column) -> Column:
    """An age in whole seconds below a minute, whole minutes below an hour, else hours with one digit."""
    return (
        F.when(seconds < 60, F.format_string("%ds", F.floor(seconds).cast("int")))
        .when(seconds < 3600, F.format_string("%dm", F.floor(seconds / 60).cast("int")))
        .otherwise(F.format_string("%.1fh", seconds / 3600.0))
    )


def chat_url(base: Column) -> Column:
    """Address of the chat endpoint of a base address."""
    b = F.regexp_replace(base, r"/+$", "")
    return F.when(b.endswith("/chat/completions"), b).when(b.endswith("/v1"), F.concat(b, F.lit("/chat/completions"))).otherwise(F.concat(b, F.lit("/v1/chat/completions")))


def without_placeholder(s: Column) -> Column:
    """Null for a blank value and for one that still holds a ``${...}`` placeholder."""
    return F.when((F.length(s) > 0) & ~s.contains("${"), s)


def device(s: Column) -> Column:
    """``cuda:1`` as (kind, index); index 0 where none is given."""
    return F.struct(F.regexp_extract(s, r"^([a-z]+)", 1).alias("kind"), F.coalesce(F.regexp_extract(s, r":(\d+)$", 1).try_cast("int"), F.lit(0)).alias("index"))
