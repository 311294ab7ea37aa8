"""Caption results: parsing of responses, the two-stage outcome, prompts and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import base_name, strip, without_placeholder


def _filled(c: Column) -> Column:
    s = strip(c)
    return F.when(F.length(s) > 0, s)


def parse_generic(body: Column, field: str | None = None) -> Column:
    """Caption of a response body.

    Not JSON: the stripped text. A JSON string: itself. An object: the response field, else caption, text or message,
    else its first scalar value in key order of the text. Blank is null.
    """
    plain = strip(body)
    value = F.try_parse_json(plain)
    kind = F.schema_of_variant(value)
    names = [n for n in [field, "caption", "text", "message"] if n]
    picked = F.coalesce(*[F.try_variant_get(value, f"$['{n}']" if not n.isidentifier() else f"$.{n}", "string") for n in names])
    keys = F.json_object_keys(plain)
    scalars = F.filter(
        F.transform(keys, lambda k: F.element_at(F.from_json(plain, "map<string,string>"), k)),
        lambda v: v.isNotNull() & ~F.substring(v, 1, 1).isin("{", "["),
    )
    of_object = F.coalesce(picked, F.get(scalars, F.lit(0)))
    return F.when(plain.isNull(), None).when(value.isNull(), _filled(plain)).when(kind == "STRING", _filled(F.try_variant_get(value, "$", "string"))).when(kind.startswith("OBJECT"), _filled(of_object))


MESSAGE = "choices array<struct<message:struct<content:string>>>"
PART = "array<struct<type:string,text:string>>"


def parse_chat(body: Column) -> Column:
    """Content of a chat completion's first choice: a string, or its text parts joined by line ends."""
    content = F.get(F.from_json(body, f"struct<{MESSAGE}>")["choices"], F.lit(0))["message"]["content"]
    parts = F.from_json(content, PART)
    texts = F.transform(F.filter(parts, lambda p: (p["type"] == "text") & p["text"].isNotNull()), lambda p: p["text"])
    is_list = content.startswith("[") & parts.isNotNull()
    return _filled(F.when(is_list, F.array_join(texts, "\n")).otherwise(content))


def two_stage(visual: Column, visual_error: Column, rewritten: Column, rewrite_error: Column) -> Column:
    """(caption, caption_visual, caption_error) from both stages' results and error texts."""
    v, r = _filled(visual), _filled(rewritten)
    error = (
        F.when(visual_error.isNotNull(), F.concat(F.lit("visual_failed:"), visual_error))
        .when(v.isNull(), "rewrite_skipped:visual_caption_missing")
        .when(rewrite_error.isNotNull(), F.concat(F.lit("rewrite_failed:"), rewrite_error))
        .when(r.isNull(), "rewrite_empty_fallback_visual")
    )
    seen = F.when(visual_error.isNull(), v)
    caption = F.when(visual_error.isNotNull() | v.isNull(), None).when(rewrite_error.isNotNull(), v).otherwise(F.coalesce(r, v))
    return F.struct(caption.alias("caption"), seen.alias("caption_visual"), error.alias("caption_error"))


def eligible(clips: DataFrame, include_unkept: bool = False, overwrite: bool = False) -> DataFrame:
    """Clips to caption: kept ones unless all are asked for, without a caption unless it may be replaced."""
    rows = clips if include_unkept else clips.where("keep")
    return rows if overwrite else rows.where("caption is null or caption = ''")


def non_empty(captions: DataFrame) -> DataFrame:
    return captions.where(F.length(strip(F.col("caption"))) > 0)


def prompt(base: Column, path: Column) -> Column:
    """The base prompt with the file's name; fixed text of the prompt."""
    return F.concat(base, F.lit("\n文件名: "), base_name(path))


def fill_template(template: Column, visual: Column, path: Column) -> Column:
    """The template with its two placeholders filled; one with other placeholders is put before the caption instead."""
    left = F.regexp_replace(template, r"\{(visual_caption|filename)\}|\{\{|\}\}", "")
    filled = F.replace(F.replace(template, F.lit("{filename}"), base_name(path)), F.lit("{visual_caption}"), visual)
    return F.when(left.rlike(r"[{}]"), F.concat(template, F.lit("\n"), visual)).otherwise(filled)


def request_body(model: Column, system: Column, user: Column, images: Column) -> Column:
    """JSON body of a chat request: an optional system prompt, then text and images of the user."""
    text = F.struct(F.lit("text").alias("type"), user.alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url"))
    pictures = F.transform(images, lambda b: F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(F.concat(F.lit("data:image/jpeg;base64,"), F.base64(b)).alias("url")).alias("image_url")))
    said = F.struct(F.lit("user").alias("role"), F.concat(F.array(text), pictures).alias("content"))
    told = F.struct(F.lit("system").alias("role"), F.array(F.struct(F.lit("text").alias("type"), system.alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url"))).alias("content"))
    messages = F.when(without_placeholder(system).isNotNull(), F.array(told, said)).otherwise(F.array(said))
    return F.to_json(F.struct(model.alias("model"), messages.alias("messages")))


def error_kind(error: Column) -> Column:
    """The part of an error before its detail."""
    return F.substring_index(error, ":", 1)
