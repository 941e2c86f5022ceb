"""Uniform column types across files: T1 to T5 of the blueprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text a null becomes in an aligned text column.
NULL_TEXT = "None"
_TEXT_LIKE = (T.StringType, T.DecimalType, T.DateType, T.ArrayType, T.MapType, T.StructType, T.NullType)
_WIDE_INTS = (T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def align_text(col: Column, null_text: str | None = NULL_TEXT) -> Column:
    """Text, with nulls spelled out unless ``null_text`` is None."""
    text = col.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def align_number(col: Column) -> Column:
    """32-bit float; whole numbers above 2**24 lose digits."""
    return col.cast("float")


def align_timestamp(col: Column) -> Column:
    """Naive time in whole seconds."""
    return F.date_trunc("SECOND", col).cast("timestamp_ntz")


def parse_timestamp(col: Column) -> Column:
    """Naive time in whole seconds from text; null where the text is no time."""
    return align_timestamp(F.try_to_timestamp(col))


def aligned_type(data_type: T.DataType, lossless: bool = False) -> T.DataType:
    """The type a column has after alignment."""
    if isinstance(data_type, _TEXT_LIKE):
        return T.StringType()
    if isinstance(data_type, (*_WIDE_INTS, T.DoubleType)) and not lossless:
        return T.FloatType()
    if isinstance(data_type, _TIMES):
        return T.TimestampNTZType()
    return data_type


def align_types(df: DataFrame, keep=("geometry",), null_text: str | None = NULL_TEXT,
                lossless: bool = False) -> DataFrame:
    """All columns but ``keep`` in their aligned types; one projection.

    ``lossless`` leaves whole numbers and doubles as wide as they are.
    """
    def aligned(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if field.name in keep:
            return col
        if isinstance(field.dataType, _TEXT_LIKE):
            return align_text(col, null_text).alias(field.name)
        if isinstance(field.dataType, (*_WIDE_INTS, T.DoubleType)) and not lossless:
            return align_number(col).alias(field.name)
        if isinstance(field.dataType, _TIMES):
            return align_timestamp(col).alias(field.name)
        return col
    return df.select(*[aligned(f) for f in df.schema.fields])
