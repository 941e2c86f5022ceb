"""Agreement of file schemas, and the files that fail it.

All functions take the long form ``file_name, column_name, data_type``, one row
per column of a file; no file's rows are touched. They look at it several times,
so a table that comes straight from footers or headers is best written first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.skew import skew_join
from strandline.session import write_through

QUARANTINE_SCHEMA = "file_name string, reason string, column_name string, data_type string"


def _signature() -> Column:
    """Columns and types of one file in a fixed order; as long as the file is wide."""
    return F.array_sort(F.collect_set(F.struct("column_name", "data_type")))


def schema_gate(columns: DataFrame, record: DataFrame | None = None) -> DataFrame:
    """(file_name, accepted): whether a file has exactly the columns and types of record.

    Without ``record`` those of the file with the smallest name count.
    """
    files = columns.groupBy("file_name").agg(_signature().alias("_columns"))
    if record is None:
        wanted = files.agg(F.min_by("_columns", "file_name")).scalar()
    else:
        wanted = record.agg(_signature()).scalar()
    return files.select("file_name", (F.col("_columns") == wanted).alias("accepted"))


def quarantine_report(columns: DataFrame, failed: DataFrame) -> DataFrame:
    """Failed files (file_name, reason) with the columns they came with, one row per column.

    A file whose columns could not be read still gets one row.
    """
    return (failed.join(columns, "file_name", "left")
            .select("file_name", "reason", "column_name", "data_type"))


def isolate_failures(rows: DataFrame, file: str = "_source_file", error: str = "_error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failed files): one bad row sends its whole file to the failed list.

    Both read the rows, so they are written first and decoded once.
    """
    rows = write_through(rows, "isolated")
    failed = (rows.where(F.col(error).isNotNull()).groupBy(F.col(file).alias("file_name"))
              .agg(F.min(error).alias("reason")))
    return skip_quarantined(rows, failed, file).drop(error), failed


def skip_quarantined(df: DataFrame, failed: DataFrame, file: str) -> DataFrame:
    """Rows whose file is not in the failed list; how the two meet is left to Spark's size check."""
    return skew_join(df, failed.select(F.col("file_name").alias(file)).distinct(), [file], "left_anti")


def common_columns(columns: DataFrame) -> DataFrame:
    """Columns every file has."""
    pairs = columns.select("file_name", "column_name").distinct()
    n_files = columns.agg(F.count_distinct("file_name")).scalar()
    return (pairs.groupBy("column_name").agg(F.count("*").alias("n_files"))
            .where(F.col("n_files") == n_files))


def concat_by_name(tables: dict[str, DataFrame] | list[DataFrame]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(rows of the tables that fit together, the others with the reason); a column absent from a table is null there.

    A table in which a column has another type than in the tables before it is recorded and left out:
    widening the type silently would hide a drift. Tables of a list are named by their number.
    """
    named = tables if isinstance(tables, dict) else {str(i): t for i, t in enumerate(tables)}
    seen: dict[str, str] = {}
    kept, left_out = [], []
    for name, table in named.items():
        clash = [(c, kind) for c, kind in table.dtypes if seen.get(c, kind) != kind]
        if clash:
            left_out.append((name, "; ".join(f"{c} is {kind}, elsewhere {seen[c]}" for c, kind in clash)))
            continue
        seen.update(table.dtypes)
        kept.append(table)
    if not kept:
        raise ValueError("no tables to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept), left_out


def map_partitions(df: DataFrame, fn, schema: str) -> DataFrame:
    """Apply ``fn(partition_number, frame)`` once to each partition that has rows, whole, as a pandas frame.

    A partition must fit a task's memory; ``repartition`` before, if it does not.
    """
    numbered = df.withColumn("_partition", F.spark_partition_id())

    def run(batches):
        held = [b for b in batches if len(b)]
        if held:
            frame = pd.concat(held, ignore_index=True)
            yield fn(int(frame["_partition"].iloc[0]), frame.drop(columns="_partition"))
    return numbered.mapInPandas(run, schema)


def stream_partitions(df: DataFrame, fn: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Apply ``fn(partition_number, frames)`` once to each partition, whose frames come one Arrow batch at a time.

    ``fn`` yields frames of ``schema`` and may carry state from one frame to the next, so a partition of any size passes
    through bounded memory. Frames come in the order of the partition and have
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows at most: no result may depend on where they are cut. Partitions
    keep their number if ``df`` was dealt with a number of partitions (``repartition(n)``, ``repartitionById``).
    A partition without rows has no frames.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(TaskContext.get().partitionId(), batches)
    return df.mapInPandas(run, schema)
