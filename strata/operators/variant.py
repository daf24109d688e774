"""JSON text of unknown shape: parse to VARIANT, find the schema, unpack.

Texts are parsed with ``try_parse_json``, so a broken text is a null VARIANT and
no error. The schema is one aggregate over all texts (``schema_of_variant_agg``,
with partial aggregation; only its text reaches the driver): it merges the
fields of all documents, at every depth. Values are then read out by
``try_variant_get`` in the types found, arrays with ``variant_explode_outer``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

# A quoted field name (left as it is), or a type name that DDL spells otherwise.
_NAMES = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def _object(text: str) -> tuple[Column, Column]:
    """The VARIANT of a text column, and its top-level fields as a map; both null
    for what isn't a JSON object."""
    parsed = F.try_parse_json(F.col(text))
    return parsed, F.try_variant_get(parsed, "$", "map<string, variant>")


def json_text_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: ``rows``, ``missing`` (null), ``broken`` (not JSON) and ``other``
    (JSON, but not an object) texts."""
    parsed, fields = _object(column)
    text = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(text.isNull()).alias("missing"),
        F.count_if(text.isNotNull() & parsed.isNull()).alias("broken"),
        F.count_if(parsed.isNotNull() & fields.isNull()).alias("other"),
    )


def _plain(kind: DataType, decimals: bool) -> DataType:
    """The type to read a found type in: decimals as doubles (their scale would
    change with the data), text where there is no common type or no value."""
    if isinstance(kind, (VariantType, NullType)):
        return StringType()
    if isinstance(kind, DecimalType):
        return kind if decimals else DoubleType()
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType, decimals))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType, decimals)) for f in kind.fields])
    return kind


def _ddl(kind: DataType) -> str:
    """A type as SQL text, field names quoted."""
    if isinstance(kind, ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    return kind.simpleString()


def _found(values: DataFrame, decimals: bool) -> DataType:
    """Common type of the VARIANT column ``v``."""
    said = values.agg(F.schema_of_variant_agg("v")).first()[0] or "VOID"
    return _plain(DataType.fromDDL(_NAMES.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], said)), decimals)


def _elements(df: DataFrame, array: Column) -> DataFrame:
    """``df`` with ``__pos`` and ``__value`` of each element of a VARIANT array;
    what is no array, or empty, keeps its row with nulls."""
    is_array = F.try_variant_get(array, "$", "array<variant>").isNotNull()
    rows = df.withColumn("__array", F.when(is_array, array))
    unnested = rows.sparkSession.tvf.variant_explode_outer(F.col("__array").outer())
    return rows.lateralJoin(unnested.select(F.col("pos").alias("__pos"), F.col("value").alias("__value")))


def found_json_schema(df: DataFrame, column: str, explode: str | None = None, decimals: bool = False) -> StructType:
    """Schema of all JSON objects in ``column``, fields by name (one job).

    A field with values of no common type, or of nulls only, is text; decimals
    are doubles unless ``decimals``. Without any object the schema has no field.
    ``explode`` names a field that is to be unnested: its element type is that of
    all elements of its arrays (one more job), whatever else the field may hold.
    """
    parsed, fields = _object(column)
    objects = df.select(F.when(fields.isNotNull(), parsed).alias("v")).filter("v is not null")
    kind = _found(objects, decimals)
    schema = kind if isinstance(kind, StructType) else StructType([])
    if explode is None or explode not in schema.names:
        return schema
    array = F.try_element_at(F.try_variant_get("v", "$", "map<string, variant>"), F.lit(explode))
    element = _found(_elements(objects, array).select(F.col("__value").alias("v")).filter("v is not null"), decimals)
    return StructType([StructField(f.name, ArrayType(element)) if f.name == explode else f for f in schema.fields])


def _lifted(value: Column, kind: DataType, name: str) -> list[Column]:
    """Columns for a value: a struct's fields each, at any depth, others as they are."""
    if not isinstance(kind, StructType):
        return [value.alias(name)]
    return [c for f in kind.fields for c in _lifted(value.getField(f.name), f.dataType, f"{name}_{f.name}" if name else f.name)]


def json_unpack(
    df: DataFrame,
    column: str,
    keep: Sequence[str] = (),
    schema: StructType | None = None,
    explode: str | None = None,
) -> DataFrame:
    """``keep`` and one column per field of the JSON objects in ``column``.

    ``schema`` is what ``found_json_schema`` gives (asked for if missing, which
    reads the texts once more), or one declared. Struct fields are lifted under
    ``outer_inner`` names; a value that doesn't fit its type is null. ``explode``
    names an array field to unnest: one row per element with its place (from 0)
    in ``<field>_pos`` and its fields lifted as ``<field>_<name>``; a missing or
    empty array, or one that is no array, keeps its row with nulls. ``broken``
    is true for a text that isn't JSON. A null text, and JSON that isn't an
    object, have nulls.
    """
    schema = found_json_schema(df, column, explode) if schema is None else schema
    if explode is not None and explode not in schema.names:
        raise ValueError(f"no field {explode}")
    if explode is not None and not isinstance(schema[explode].dataType, ArrayType):
        raise ValueError(f"{explode} is not an array field")
    parsed, fields = _object(column)
    broken = F.col(column).isNotNull() & parsed.isNull()
    rows = df.select(*[F.col(c) for c in keep], fields.alias("__fields"), broken.alias("__broken"))

    def value(name: str, kind: DataType) -> Column:
        return F.try_variant_get(F.try_element_at("__fields", F.lit(name)), "$", _ddl(kind))

    out: list[Column] = []
    for f in schema.fields:
        if f.name != explode:
            out += _lifted(value(f.name, f.dataType), f.dataType, f.name)
            continue
        rows = _elements(rows, F.try_element_at("__fields", F.lit(explode)))
        kind = f.dataType.elementType
        out.append(F.col("__pos").alias(f"{explode}_pos"))
        element = F.try_variant_get("__value", "$", _ddl(kind))
        out += _lifted(element, kind, explode)
    names = [*keep, *rows.select(*out).columns, "broken"]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several fields would be named {twice}")
    return rows.select(*[F.col(c) for c in keep], *out, F.col("__broken").alias("broken"))
