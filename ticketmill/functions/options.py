"""Select-list values and named objects, which arrive as JSON of several shapes, as text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


@F.pandas_udf(T.StringType())
def _printed(values: pd.Series) -> pd.Series:
    return values.map(lambda raw: None if raw is None else str(json.loads(raw)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _printed_items(lists: pd.Series) -> pd.Series:
    return lists.map(lambda items: None if items is None else [None if i is None else str(json.loads(i)) for i in items])


def _named(item: Column) -> Column:
    """The first non-empty text among ``value`` and ``name``."""
    return F.coalesce(
        F.nullif(F.try_variant_get(item, "$.value", "string"), F.lit("")),
        F.nullif(F.try_variant_get(item, "$.name", "string"), F.lit("")),
    )


def option_text(raw_json: str | Column) -> Column:
    """Text of an option value: plain, {value|name}, a list of these, or nothing ("Unknown").

    Objects without a usable value or name are printed; only those go through an Arrow batch function.
    """
    column = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    value = F.try_parse_json(column)
    kind = F.schema_of_variant(value)
    is_text = kind == "STRING"
    is_list = kind.startswith("ARRAY")
    is_object = kind.startswith("OBJECT")
    empty = column.isNull() | F.is_variant_null(value)

    items = F.from_json(F.when(is_list, column), T.ArrayType(T.VariantType()))

    def item_text(item: Column) -> Column:
        plain = F.when(F.schema_of_variant(item) == "STRING", F.try_variant_get(item, "$", "string"))
        return F.coalesce(plain, _named(item))

    # items without a text are printed: their JSON goes through the batch function, the others are null there
    texts = F.transform(items, item_text)
    odd = _printed_items(F.transform(items, lambda i: F.when(item_text(i).isNull(), F.to_json(i))))
    texts = F.when(F.exists(texts, lambda t: t.isNull()), F.zip_with(texts, odd, lambda t, o: F.coalesce(t, o))).otherwise(texts)
    joined = F.array_join(F.filter(texts, lambda t: t != ""), ", ")

    text = F.when(is_text, F.try_variant_get(value, "$", "string"))
    of_list = F.when(is_list, F.when(joined == "", F.lit(UNKNOWN)).otherwise(joined))
    of_object = F.when(is_object, _named(value))
    native = F.coalesce(F.when(empty, F.lit(UNKNOWN)), text, of_list, of_object)
    rest = F.when(value.isNotNull() & native.isNull() & ~is_list, column)
    return F.coalesce(native, _printed(rest), column)


def named_object_text(raw_json: str | Column) -> Column:
    """The name of a {name} object (kept if empty), plain text as it is, otherwise "Unknown"."""
    column = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    value = F.try_parse_json(column)
    kind = F.schema_of_variant(value)
    plain = F.nullif(F.try_variant_get(value, "$", "string"), F.lit(""))
    return F.coalesce(
        F.when(kind.startswith("OBJECT"), F.try_variant_get(value, "$.name", "string")),
        F.when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), plain),
        F.lit(UNKNOWN),
    )
