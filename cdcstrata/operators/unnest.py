"""JSON arrays to rows. Rows with a NULL, empty or malformed array yield nothing, as an inner unnest does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.functions.payload import json_items

_ROW_MAP = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def explode_maps(df: DataFrame, json_array: Column, into: str = "item") -> DataFrame:
    """One row per object of a JSON array, as a string map (missing keys are NULL)."""
    return df.withColumn(into, F.explode(F.from_json(json_array, _ROW_MAP)))


def explode_items(df: DataFrame, json_array: Column, fields: list[str], into: str = "item") -> DataFrame:
    """One row per element of a JSON array, parsed into a struct of strings.

    Elements are taken one by one, so a stray scalar costs only itself and not the whole array. They are
    parsed inside the array, ahead of the unnesting: a filter on a field then reads a finished column, where
    it would otherwise move below the parse and repeat it for every mention of the field.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    items = F.transform(json_items(json_array), lambda text: F.from_json(text, schema))
    return df.withColumn(into, F.explode(items))
