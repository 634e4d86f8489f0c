"""Column functions for use in any DataFrame expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_json_strict(text: Column | str) -> Column:
    """The JSON document in ``text`` as a Variant, or NULL.

    NULL when the text is malformed, empty, or holds anything after the first
    value (``{"a":1} x``, ``{"a":1}{"b":2}``), which plain ``try_parse_json``
    would accept.
    """
    col = F.col(text) if isinstance(text, str) else text
    wrapped = F.try_parse_json(F.concat(F.lit("["), col, F.lit(","), F.xxhash64(col), F.lit("]")))
    marked = F.try_variant_get(wrapped, "$[1]", "bigint") == F.xxhash64(col)
    single = marked & F.try_variant_get(wrapped, "$[2]", "variant").isNull()
    return F.when(single, F.try_variant_get(wrapped, "$[0]", "variant"))


def json_leaf_text(doc: Column | str, path: str) -> Column:
    """Text of the leaf at ``path`` (JSONPath) of a Variant: scalars as text,
    objects and arrays as JSON, JSON null and missing as NULL."""
    col = F.col(doc) if isinstance(doc, str) else doc
    return F.try_variant_get(col, path, "string")


__all__ = ["json_leaf_text", "parse_json_strict"]
