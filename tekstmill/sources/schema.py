"""Schemas that every later file can be cast to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def nullable_type(data_type: T.DataType) -> T.DataType:
    """The type with all inner elements nullable and unknown (void) ones as strings."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(nullable_type(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(nullable_type(data_type.keyType), nullable_type(data_type.valueType), True)
    if isinstance(data_type, T.StructType):
        return nullable_schema(data_type)
    return T.StringType() if isinstance(data_type, T.NullType) else data_type


def nullable_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, nullable_type(f.dataType), True, f.metadata) for f in schema.fields])


def normalise_schema(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Cast to ``schema``, or to the nullable form of the frame's own schema.

    Columns the frame lacks become NULL, so a later frame fits an established schema.
    """
    target = nullable_schema(df.schema if schema is None else schema)

    def fit(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        # Written as a case, the column itself is nullable too, with the same values.
        return F.when(value.isNotNull(), value.cast(field.dataType)).alias(field.name)

    return df.select(*[fit(f) for f in target.fields])
