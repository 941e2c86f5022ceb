"""Joins on equal geometry.

Keys come from ``geom_key`` and have a fixed maximum length. Null geometries match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.geometry import canonical_wkb, geom_key
from strandline.operators.naming import quoted, unused
from strandline.operators.skew import skew_join

KEY = "_geom_key"


def with_key(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.withColumn(KEY, geom_key(F.col(geometry)))


def keyed(df: DataFrame, geometry: str = "geometry") -> tuple[DataFrame, str]:
    """``df`` with its join key under a name that no column has, and that name."""
    key = unused(df.columns, KEY)[0]
    return df.withColumn(key, geom_key(F.col(geometry))), key


def distinct_keys(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return with_key(df, geometry).where(F.col(KEY).isNotNull()).select(KEY).distinct()


def geom_inner_join(left: DataFrame, right: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Left rows whose geometry occurs on the right, once each; the right side counts without duplicates."""
    left, key = keyed(left, geometry)
    return skew_join(left, distinct_keys(right, geometry).withColumnRenamed(KEY, key), [key], "left_semi").drop(key)


def geom_anti_join(left: DataFrame, right: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Left rows with a geometry that does not occur on the right."""
    left, key = keyed(left.where(F.col(geometry).isNotNull()), geometry)
    return skew_join(left, distinct_keys(right, geometry).withColumnRenamed(KEY, key), [key], "left_anti").drop(key)


def _counts(df: DataFrame, name: str, geometry: str) -> DataFrame:
    return with_key(df, geometry).where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias(name))


def geom_match_counts(left: DataFrame, right: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row of counts: matched and unmatched rows of the left, distinct geometries of either side.

    Both sides shrink to one row per geometry before they meet, so copies cost nothing.
    """
    both = _counts(left, "l", geometry).join(_counts(right, "r", geometry), KEY, "full")
    in_left, in_right = F.col("l").isNotNull(), F.col("r").isNotNull()
    zero = F.lit(0).cast("bigint")
    return both.agg(
        F.coalesce(F.sum(F.when(in_right, F.col("l"))), zero).alias("matched"),
        F.coalesce(F.sum(F.when(~in_right, F.col("l"))), zero).alias("unmatched_left"),
        F.count_if(in_right & ~in_left).alias("unmatched_right"),
        F.count_if(in_left).alias("unique_left"),
        F.count_if(in_right).alias("unique_right"))


def geom_equals(df: DataFrame, probe: bytes, geometry: str = "geometry") -> DataFrame:
    """Rows whose geometry equals one given stored geometry; the comparison reaches the scan."""
    return df.where(F.col(geometry) == F.lit(probe))


def geom_equals_set(df: DataFrame, probes: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows whose geometry equals any probe, in whatever WKB flavour the probes come."""
    return geom_inner_join(df, probes.withColumn(geometry, canonical_wkb(geometry)), geometry)


def _null_safe(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def control_value_join(left: DataFrame, right: DataFrame, control: str, geometry: str = "geometry") -> DataFrame:
    """Left rows with ``status``: match, control_mismatch or not_found.

    A geometry matches if any right row with that geometry carries the same control value, null equal to null. The
    geometries and control values of either side meet once each; the left rows then take their status in one join.
    """
    if "status" in map(str.lower, left.columns):
        raise ValueError("the table already has a column status")

    def pairs(df: DataFrame, flag: str) -> DataFrame:
        return (df.select(geom_key(F.col(geometry)).alias("key"), _null_safe(F.col(control)).alias("value"))
                .where("key is not null").distinct().withColumn(flag, F.lit(True)))

    both = pairs(left, "ours").join(pairs(right, "theirs"), ["key", "value"], "full")
    found = F.max(F.coalesce("theirs", F.lit(False))).over(Window.partitionBy("key"))
    verdict = F.when(F.col("theirs"), "match").when(F.col("found"), "control_mismatch").otherwise("not_found")
    key, value, told = unused(left.columns, KEY, "_control", "_verdict")
    verdicts = both.withColumn("found", found).where("ours").select(
        F.col("key").alias(key), F.col("value").alias(value), verdict.alias(told))
    asked = left.withColumn(key, geom_key(F.col(geometry))).withColumn(value, _null_safe(F.col(control)))
    joined = skew_join(asked, verdicts, [key, value], "left")
    return joined.select(*map(quoted, left.columns), F.coalesce(told, F.lit("not_found")).alias("status"))
