"""Row numbers and running totals over a whole table without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.naming import quoted, unused
from strandline.session import write_through

# monotonically_increasing_id keeps the partition number above this many bits.
_PARTITION_BITS = 33


def with_global_index(df: DataFrame, order_by: list[str | Column], index: str = "_fid",
                      total_of: str | None = None, total: str = "running_total") -> DataFrame:
    """Dense 0-based row numbers in the given total order; optionally a running sum as well.

    Rows are range-partitioned and written once, so both later reads see the same
    partitions. Only one row per partition passes through the offset window, and
    that table, as long as the number of partitions, is broadcast. Columns of any name come through as they are;
    one that has the name of the ``index`` or the ``total`` is an error.
    """
    added = [index, *([total] if total_of else [])]
    if {c.lower() for c in df.columns} & {c.lower() for c in added}:
        raise ValueError(f"the table already has a column {' or '.join(added)}")
    row, part, n, sums_to, start, base = unused(
        [*df.columns, *added], "_row", "_part", "_n", "_sum", "_start", "_base")
    ranged = (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
              .withColumn(row, F.monotonically_increasing_id()))
    ranged = write_through(ranged, "ordered").withColumn(part, F.shiftright(row, _PARTITION_BITS))
    sums = [F.sum(total_of).alias(sums_to)] if total_of else []
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(part).agg(F.count("*").alias(n), *sums)
               .select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start),
                       *([F.coalesce(F.sum(sums_to).over(before), F.lit(0)).alias(base)] if total_of else [])))
    local = F.col(row).bitwiseAND((1 << _PARTITION_BITS) - 1)
    out = ranged.join(F.broadcast(offsets), part).withColumn(index, F.col(start) + local)
    if total_of:
        so_far = Window.partitionBy(part).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(total, F.col(base) + F.sum(total_of).over(so_far))
    return out.select(*map(quoted, [*df.columns, *added]))
