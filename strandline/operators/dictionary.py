"""Dictionary codes for text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordering import with_global_index
from strandline.operators.skew import skew_join


def code_table(df: DataFrame, column: str) -> DataFrame:
    """(column, code, n): codes number the sorted distinct non-null values from 0."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return with_global_index(counts, [column], "code")


def dictionary_encode(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """``df`` with an integer code per value of ``column``; null becomes -1."""
    codes = code_table(df, column).select(column, F.col("code").alias(code))
    joined = skew_join(df, codes, [column], "left")
    return joined.select(*[c for c in df.columns], F.coalesce(F.col(code), F.lit(-1)).alias(code))
