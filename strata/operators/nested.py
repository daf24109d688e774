"""Unpacking JSON text columns into typed, flat columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def json_flatten(
    df: DataFrame,
    column: str,
    schema: StructType | str,
    keep: Sequence[str] = (),
    explode: str | None = None,
) -> DataFrame:
    """Parse ``column`` with a declared schema and lift its fields to columns.

    Text that does not parse gives null fields. ``explode`` names an array
    field to unnest into one row per element (``explode_outer``: a null or
    empty array keeps its row with a null element).
    """
    parsed = df.select(*[F.col(c) for c in keep], F.from_json(F.col(column), schema).alias("__json"))
    flat = parsed.select(*[F.col(c) for c in keep], "__json.*")
    if explode:
        field = flat.schema[explode]
        if not isinstance(field.dataType, ArrayType):
            raise ValueError(f"{explode} is not an array field")
        flat = flat.withColumn(explode, F.explode_outer(explode))
    return flat
