"""Projections, filters and schema reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lowercase_columns(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide once lower-cased: {df.columns}")
    return df.toDF(*names)


def select_with_fill(df: DataFrame, wanted: list[str], geometry: str | None = "geometry") -> DataFrame:
    """The wanted columns in that order, then geometry; an absent column becomes null text."""
    picked = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in wanted]
    return df.select(*picked, *([geometry] if geometry else []))


def drop_null_geometry(df: DataFrame, geometry: str = "geometry", report: Observation | None = None) -> DataFrame:
    """Rows with a geometry, empty ones included; ``report`` receives ``null_geometries`` from the same pass."""
    if report is not None:
        df = df.observe(report, F.count_if(F.col(geometry).isNull()).alias("null_geometries"))
    return df.where(F.col(geometry).isNotNull())


def filter_eq_project(df: DataFrame, key: str, value, columns: list[str]) -> DataFrame:
    return df.where(F.col(key) == value).select(*columns)


def filter_eq_head(df: DataFrame, key: str, value, order_by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows of one key in a stated order."""
    return df.where(F.col(key) == value).orderBy(*order_by).limit(n)


def lookup_by_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value)


def filter_contains(df: DataFrame, column: str, text: str, pattern: bool = False) -> DataFrame:
    """Rows whose column holds ``text``; a plain text is pushed down to the scan."""
    col = F.col(column)
    return df.where(col.rlike(text) if pattern else col.contains(text))


def any_match(col: Column, selectors: list[str] | None, how: str = "contains") -> Column:
    """Whether ``col`` contains, or starts with, any selector; no selector keeps all."""
    if not selectors:
        return F.lit(True)
    tests = [col.startswith(s) if how == "prefix" else col.contains(s) for s in selectors]
    return reduce(Column.__or__, tests)


def membership_flag(names: DataFrame, name: str, df: DataFrame, column: str, exact: bool = False) -> DataFrame:
    """Each file name with ``is_member``: does its stem occur among the values of a column?

    ``exact`` compares the whole name, extension included.
    """
    probe = F.col(name) if exact else F.regexp_replace(name, r"\.[^.]*$", "")
    values = df.select(F.col(column).alias("_value")).where("_value is not null").distinct()
    return (names.withColumn("_probe", probe)
            .join(values, F.col("_probe") == F.col("_value"), "left")
            .withColumn("is_member", F.col("_value").isNotNull())
            .drop("_probe", "_value"))


def head_n(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def feature_slice(df: DataFrame, start: int, end: int, fid: str = "_fid") -> DataFrame:
    """Features ``start`` to ``end - 1``; the range reaches the Parquet row groups."""
    return df.where((F.col(fid) >= start) & (F.col(fid) < end))


def columns_of_type(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def select_by_type(df: DataFrame, *types: type[T.DataType]) -> DataFrame:
    return df.select(*[f"`{c}`" for c in columns_of_type(df, *types)])


def schema_report(df: DataFrame, source: str) -> DataFrame:
    """One row per column: source, column_name, data_type, ordinal."""
    rows = [(source, f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "source string, column_name string, data_type string, ordinal int")
