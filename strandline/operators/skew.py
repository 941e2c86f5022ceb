"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.naming import unused

HOW = ("inner", "left", "left_semi", "left_anti")


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str, condition: Column | None = None) -> DataFrame:
    """``left.join(right, on, how)`` as a plain equi-join of two shuffled sides, built without running a job.

    Adaptive execution measures both shuffles and cuts partitions that hold a hot key, on the left side of any of
    these joins and on either side of an inner one, nulls included; no pass over the data goes before. That needs
    the join to be followed by no operator that relies on its partitioning, which holds for all callers.
    ``condition`` adds a test over columns of both sides, whose names must then differ.
    """
    if how not in HOW:
        raise ValueError(f"unsupported join type {how}")
    if condition is None:
        return left.join(right, on, how)
    theirs = unused([*left.columns, *right.columns], *(f"_right_{k}" for k in on))
    right = right.withColumnsRenamed(dict(zip(on, theirs, strict=True)))
    for ours, other in zip(on, theirs, strict=True):
        condition = condition & (F.col(ours) == F.col(other))
    return left.join(right, condition, how).drop(*theirs)
