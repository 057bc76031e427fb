"""Values of unknown type: metadata, arguments, JSON types, sets."""

from __future__ import annotations

import ast
import json
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def json_type(text: Column) -> Column:
    """The JSON type of a value in JSON text: boolean, number, array, object, else string."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return (
        F.when(kind == "BOOLEAN", "boolean")
        .when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|TINYINT|SMALLINT)"), "number")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("string")
    )


def metadata_object(text: Column) -> Column:
    """JSON text as an object in JSON text: other JSON goes under "value", text that is no JSON under "raw"."""
    v = F.try_parse_json(text)
    kind = F.schema_of_variant(v)
    return (
        F.when(text.isNull(), F.lit("{}"))
        .when(v.isNull(), F.to_json(F.struct(text.alias("raw"))))
        .when(kind.startswith("OBJECT"), F.to_json(v))
        .otherwise(F.concat(F.lit('{"value":'), F.coalesce(F.to_json(v), F.lit("null")), F.lit("}")))
    )


def parse_arguments(value: Any) -> dict:
    """A call's arguments: an object, JSON text of one, or a Python literal of one. Anything else is a ValueError."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except json.JSONDecodeError:
            try:
                value = ast.literal_eval(value)
            except (SyntaxError, ValueError, MemoryError, RecursionError) as e:
                raise ValueError("malformed_arguments") from e
    if not isinstance(value, dict):
        raise ValueError("arguments_not_an_object")
    return value


@F.pandas_udf(StringType())
def arguments_json(texts: pd.Series) -> pd.Series:
    """parse_arguments() of a column, as JSON text with sorted keys; null where it fails."""

    def one(t: str | None) -> str | None:
        try:
            return json.dumps(parse_arguments(t), ensure_ascii=False, sort_keys=True)
        except (ValueError, TypeError):
            return None

    return texts.map(one)


def string_set(value: Any) -> frozenset[str]:
    """A list's items as strings, a single value as one, nothing for null and the empty string."""
    if isinstance(value, list):
        return frozenset(map(str, value))
    return frozenset() if value is None or value == "" else frozenset([str(value)])


def as_set(values: Column) -> Column:
    """An array's distinct strings in order; null as the empty set."""
    return F.sort_array(F.array_distinct(F.coalesce(F.transform(values, lambda x: x.cast("string")), F.array().cast("array<string>"))))
