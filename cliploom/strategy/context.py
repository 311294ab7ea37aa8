"""Names a keep/drop expression may read in a row.

In this order: each score by its model's name, ``<name>_thr`` its threshold, ``has_text`` and ``text_len``, then the
record's meta entries as ``meta_<key>`` and, where no other binding exists, as ``<key>``. Keys are normalised, values are
coerced to numbers. Of keys that normalise alike, ``meta_<key>`` takes the last and ``<key>`` the first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliploom.functions.text import normalise_key, to_context_number


def _entries(meta: Column) -> Column:
    """(key, value) entries of a string map with normalised keys and numeric values, in order; unusable ones dropped."""
    pairs = F.transform(F.map_entries(meta), lambda e: F.struct(normalise_key(e["key"]).alias("k"), to_context_number(e["value"]).alias("v")))
    return F.filter(pairs, lambda e: e["k"].isNotNull() & e["v"].isNotNull())


def lookup(
    scores: Column, thresholds: Mapping[str, float], text: Column | None = None, meta: Column | None = None
) -> Callable[[str], Column | None]:
    """Binding of names for :meth:`cliploom.strategy.ir.Strategy.columns`; only entries that are read are looked up.

    ``text`` and ``meta`` are None for records that are a path alone: they lack has_text, text_len and meta names.
    """

    def first(key: str) -> Column:
        return F.get(F.filter(_entries(meta), lambda e: e["k"] == key), F.lit(0))["v"]

    def last(key: str) -> Column:
        return F.try_element_at(F.filter(_entries(meta), lambda e: e["k"] == key), F.lit(-1))["v"]

    def look(name: str) -> Column | None:
        options: list[Column] = []
        if meta is not None and name.startswith("meta_"):
            options.append(last(name[5:]))
        if name in thresholds:
            options.append(F.try_element_at(scores, F.lit(name)))
        elif name.endswith("_thr") and name[:-4] in thresholds:
            options.append(F.lit(float(thresholds[name[:-4]])))
        elif text is not None and name == "has_text":
            options.append((F.coalesce(F.length(text), F.lit(0)) > 0).cast("double"))
        elif text is not None and name == "text_len":
            options.append(F.coalesce(F.length(text), F.lit(0)).cast("double"))
        elif meta is not None:
            options.append(first(name))
        return F.coalesce(*options) if options else None

    return look
