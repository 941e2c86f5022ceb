"""Counts, distinct values, top-k and per-file checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.geometry import geom_key


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def null_geometry_count(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.agg(F.count_if(F.col(geometry).isNull()).alias("null_geometries"))


def value_counts_topk(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` most frequent non-null values; ties go to the smaller value."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
            .orderBy(F.desc("n_rows"), column).limit(n))


def kth_most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The value at rank ``k`` as one row; the ranking sees at most ``k`` rows."""
    rank = F.row_number().over(Window.orderBy(F.desc("n_rows"), column))
    return (value_counts_topk(df, column, k).withColumn("rank", rank)
            .where(F.col("rank") == k).select(column, "n_rows"))


def rows_of_kth_most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """All rows that carry the value at rank ``k``: a filter on a scalar subquery, no join."""
    return df.where(F.col(column) == kth_most_common(df, column, k).select(column).scalar())


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def single_value_check(df: DataFrame, file: str, control: str, order_by: str = "_fid") -> DataFrame:
    """Per file: number of distinct control values (null counts as one) and the first of them.

    Grouping by file and value first leaves one row per value before the files meet.
    """
    per_value = df.groupBy(file, control).agg(F.min(order_by).alias("_first"))
    return (per_value.groupBy(file)
            .agg(F.count("*").alias("n_values"), F.min_by(control, "_first").alias("first_value"))
            .withColumn("is_single", F.col("n_values") == 1))


def geom_dedupe(df: DataFrame, geometry: str = "geometry", order_by: str = "_fid") -> DataFrame:
    """One row per distinct geometry, the one with the smallest ``order_by``; copies meet before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return (df.groupBy(geom_key(F.col(geometry)).alias("_key"))
            .agg(F.min_by(row, order_by).alias("_kept")).select("_kept.*"))


def outcome_summary(report: DataFrame, status: str = "status") -> DataFrame:
    return report.groupBy(status).agg(F.count("*").alias("n_files"))
