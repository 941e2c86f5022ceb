"""Seeded samples of files and rows; the same seed gives the same sample on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(col: Column, seed: int) -> Column:
    """Sort key of a sample."""
    return F.md5(F.concat(col.cast("string"), F.lit(str(seed))))


def sample_files(files: DataFrame, name: str, n: int = 3, seed: int = 0) -> DataFrame:
    """``n`` files without replacement."""
    return files.orderBy(draw(F.col(name), seed), name).limit(n)


def sample_rows_per_file(df: DataFrame, file: str, fid: str = "_fid", n: int = 5, seed: int = 0) -> DataFrame:
    """``n`` rows of each file, or all where it has fewer; each task keeps at most ``n`` per file before the shuffle."""
    order = Window.partitionBy(file).orderBy(draw(F.col(fid), seed), fid)
    return df.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") <= n).drop("_pick")
