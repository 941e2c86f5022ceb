"""Profile of an occurrence table: schema, top values, and the rows of the k-th most common one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strandline.operators.aggregates import rows_of_kth_most_common, value_counts_topk
from strandline.operators.columns import schema_report


@dataclass
class OccurrenceProfile:
    schema: DataFrame
    top: DataFrame
    sample: DataFrame
    coordinates: DataFrame


def occurrence_profile(df: DataFrame, key: str, coordinates: list[str], order_by: list[str],
                       k: int = 3, top: int = 5, sample: int = 5, geometry: str = "geometry") -> OccurrenceProfile:
    """Lazy tables: column types, the ``top`` values, ``sample`` rows and all ``coordinates`` of the k-th value."""
    plain = df.drop(geometry)
    chosen = rows_of_kth_most_common(plain, key, k)
    return OccurrenceProfile(
        schema_report(df, "occurrence"), value_counts_topk(plain, key, top),
        chosen.orderBy(*order_by).limit(sample), chosen.select(*coordinates))
