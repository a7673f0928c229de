"""Extraction from JSON text and from XML that is embedded in it."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.functions.scalars import is_blank

# Fixed values that decide results.
UNAVAILABLE_PAYLOAD = "__debezium_unavailable_value"
NO_COUNTRY = "None"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_str(c: Column | str, path: str) -> Column:
    """One scalar (or the JSON text of a nested value) by dotted path, e.g. ``a.b.c``.

    For more than a few fields of the same document use :func:`parse_payload`, which reads the text once.
    """
    return F.get_json_object(_col(c), "$." + path)


def parse_payload(df: DataFrame, fields: Iterable[str], payload: str = "data", into: str = "doc") -> DataFrame:
    """Parse a JSON column once into a struct of strings holding just ``fields``.

    Catalyst keeps this a single parse per row and prunes fields nobody selects, where n calls of
    ``get_json_object`` would scan the text n times. Of a VARIANT column (:func:`parse_variant`) the fields are taken as they
    are; the column itself then only tells whether a payload is there, so that nothing wide is carried along.
    """
    if _is_variant(df, payload):
        names = list(dict.fromkeys(fields))
        fields_of = "struct<" + ", ".join(f"`{f}`: string" for f in names) + ">"
        doc = F.try_variant_get(payload, "$", fields_of)  # all fields in one pass
        there = F.when(F.col(payload).isNotNull(), F.lit("variant"))
        return df.select("*", doc.alias(into)).withColumn(payload, there)
    schema = T.StructType([T.StructField(f, T.StringType()) for f in dict.fromkeys(fields)])
    # A placeholder has no fields; taken for a document, it would cost a parser's error a row.
    text = F.when(F.col(payload) != UNAVAILABLE_PAYLOAD, F.col(payload))
    return df.withColumn(into, F.from_json(text, schema))


def parse_nested(df: DataFrame, schema: str, payload: str = "data", into: str = "doc") -> DataFrame:
    """Like :func:`parse_payload` for nested fields: ``schema`` is DDL with structs."""
    return df.withColumn(into, F.from_json(F.col(payload), schema))


def is_json_array(c: Column | str) -> Column:
    """Shape guard for fields that hold a number in some report versions and an array in others."""
    return _col(c).startswith("[")


def json_items(c: Column | str) -> Column:
    """JSON array text as ``array<string>``, each element still JSON; NULL for anything else."""
    return F.from_json(_col(c), T.ArrayType(T.StringType()))


def has_item_country(c: Column | str) -> Column:
    """True for a usable country: not NULL, not '', not the literal 'None'."""
    return ~is_blank(c) & (_col(c) != F.lit(NO_COUNTRY))


def xml_child(c: Column | str, scope: str, tag: str) -> Column:
    """Text of the first ``<tag>`` in the first ``<scope>`` below the root of an XML document; NULL where there is none.

    The document is parsed: entities are decoded, attributes allowed, white space around the text dropped. What is no XML
    gives NULL, in place of an error. Several tags of one document are one parse where they are asked for together, as
    Spark shares equal expressions.
    """
    text = T.StructType([T.StructField("_VALUE", T.StringType())])
    inner = T.StructType([T.StructField(tag, T.ArrayType(text))])
    parsed = F.from_xml(_col(c), T.StructType([T.StructField(scope, T.ArrayType(inner))]), {"mode": "PERMISSIVE"})
    first = F.get(parsed[scope], F.lit(0))[tag]
    return F.get(first, F.lit(0))["_VALUE"]


def parse_variant(df: DataFrame, payload: str = "data") -> DataFrame:
    """The payload column as VARIANT, parsed once, for a log that many tables are built from.

    A placeholder for an unavailable payload becomes NULL. Text that is no JSON is kept as a VARIANT string, which has no fields
    but is there; so is a document that names a field twice. Written to Parquet it stays a VARIANT, and readers take their
    fields without reading the text again.
    """
    text = F.nullif(F.col(payload), F.lit(UNAVAILABLE_PAYLOAD))
    return df.withColumn(payload, F.coalesce(F.try_parse_json(text), text.cast(T.VariantType())))


def _is_variant(df: DataFrame, payload: str) -> bool:
    return isinstance(df.schema[payload].dataType, T.VariantType)


def xml_tag(c: Column | str, scope: str, tag: str, content: str = "[^<]+", mode: str = "first") -> Column:
    """Text of ``<tag>`` inside ``<scope>``, NULL where there is none.

    ``mode="first"`` takes the first tag of the scope element. ``mode="last"`` takes the last such tag
    anywhere after the scope opens, even past its end (the older behaviour, kept for parity). Both match text.
    ``mode="parsed"`` reads the document as XML (see :func:`xml_child`): entities are decoded, tags may carry attributes,
    and the scope is a child of the root; ``content`` must match the whole text.
    """
    if mode == "parsed":
        text = xml_child(_col(c), scope, tag)
        return F.when(text.rlike(f"^(?:{content})$") if content != "[^<]+" else text != F.lit(""), text)
    s, t = re.escape(scope), re.escape(tag)
    if mode == "first":
        # Two plain patterns: one with a lookahead for the end of the scope steps through every character.
        inside = F.regexp_extract(_col(c), f"(?s)<{s}>(.*?)</{s}>", 1)
        matches = F.regexp_extract_all(inside, F.lit(f"<{t}>({content})</{t}>"), F.lit(1))
    elif mode == "last":
        matches = F.regexp_extract_all(_col(c), F.lit(f"(?s)<{s}>.*<{t}>({content})</{t}>"), F.lit(1))
    else:
        raise ValueError(f"mode must be 'first', 'last' or 'parsed', not {mode!r}")
    # Indexing gives NULL for no match without naming the match twice, as a test for '' would.
    return F.get(matches, F.lit(0))
