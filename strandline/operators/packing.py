"""Packing of files and rows into chunks.

The size rules fold over the manifest (one row per file) in name order, without
any sequential step: every file's next chunk start comes from one global sort,
and the chain of starts from the first file is found by doubling its reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.naming import quoted
from strandline.operators.ordering import with_global_index
from strandline.session import write_through

# Default chunk sizes in bytes of the two rules, and features per row chunk.
AT_LEAST_BYTES = 400 * 1024 * 1024
AT_MOST_BYTES = 200 * 1024 * 1024
ROWS_PER_CHUNK = 100_000


def pack_files(manifest: DataFrame, limit: int, rule: str = "at_least", path: str = "path",
               size: str = "size_bytes") -> DataFrame:
    """``manifest`` with ``chunk_id``, numbered from 0 without gaps.

    ``at_least`` adds files in path order until the chunk holds ``limit`` bytes or
    more; ``at_most`` opens a new chunk before a file would take it past ``limit``.
    Files of one path follow by size and then by a hash of their other columns, so chunks never depend on how rows are dealt.
    """
    if rule not in ("at_least", "at_most"):
        raise ValueError(f"unknown packing rule {rule}")
    return _double(manifest, limit, rule, path, size)


def pack_at_least(manifest: DataFrame, limit: int = AT_LEAST_BYTES, **kwargs) -> DataFrame:
    return pack_files(manifest, limit, "at_least", **kwargs)


def pack_at_most(manifest: DataFrame, limit: int = AT_MOST_BYTES, **kwargs) -> DataFrame:
    return pack_files(manifest, limit, "at_most", **kwargs)


def _double(manifest: DataFrame, limit: int, rule: str, path: str, size: str) -> DataFrame:
    others = [F.col(quoted(c)) for c, kind in manifest.dtypes if c not in (path, size) and "map<" not in kind and "variant" not in kind]
    files = with_global_index(manifest, [path, size, *([F.xxhash64(*others)] if others else [])], "_i", total_of=size, total="_end")
    files = write_through(files, "packing-files")
    n = files.count()
    if not n:
        return files.select(*manifest.columns, F.lit(0).cast("bigint").alias("chunk_id"))
    # The chunk that starts at file i ends by the number of files whose running total stays below `reach`.
    reach = F.col("_end") - F.col(size) + limit
    merged = (files.select(F.col("_end").alias("_at"), F.lit(1).alias("_is_file"), "_i")
              .union(files.select(reach, F.lit(0), "_i")))
    ties = F.col("_is_file") if rule == "at_least" else -F.col("_is_file")
    ranked = with_global_index(merged.withColumn("_tie", ties), ["_at", "_tie", "_i"], "_rank")
    below = F.col("_rank") - F.col("_i")
    after = below + 1 if rule == "at_least" else F.greatest(below, F.col("_i") + 1)
    jump = ranked.where("_is_file = 0").select(F.col("_i").alias("_from"), F.least(after, F.lit(n)).alias("_to"))
    jump = write_through(jump, "packing-jump")
    starts = manifest.sparkSession.range(1).select(F.col("id").alias("_from"))
    while True:
        starts = write_through(
            starts.union(starts.join(jump, "_from").where(F.col("_to") < n).select("_to")).distinct(),
            "packing-starts")
        if jump.where("_from = 0").first()["_to"] >= n:
            break
        on = jump.select(F.col("_from").alias("_to"), F.col("_to").alias("_further"))
        jump = jump.join(on, "_to", "left").select("_from", F.coalesce("_further", F.lit(n)).alias("_to"))
        jump = write_through(jump, "packing-jump")
    both = (files.select("_i", F.lit(1).alias("_is_file"))
            .union(starts.select(F.col("_from").alias("_i"), F.lit(0))))
    ranked = with_global_index(both, ["_i", "_is_file"], "_rank").where("_is_file = 1")
    chunks = ranked.select("_i", (F.col("_rank") - F.col("_i") - 1).alias("chunk_id"))
    return files.join(chunks, "_i").select(*manifest.columns, "chunk_id")


def pack_count(manifest: DataFrame, limit: int, size: str = "size_bytes") -> DataFrame:
    """How many chunks the total size suggests; 0 for no bytes."""
    total = F.coalesce(F.sum(size), F.lit(0)).cast("bigint")
    return manifest.agg(total.alias("total_bytes"), F.ceil(total / F.lit(limit)).cast("bigint").alias("n_chunks"))


def size_total(manifest: DataFrame, size: str = "size_bytes") -> DataFrame:
    return manifest.agg(F.count("*").alias("n_files"),
                        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total_bytes"))


def row_chunk(fid: Column, rows: int = ROWS_PER_CHUNK) -> Column:
    """1-based chunk of a feature: a projection, because feature numbers are dense."""
    return (F.floor(fid / rows) + 1).cast("bigint")


def compact_chunks(df: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Rows of a chunk brought together for writing; AQE splits a chunk too big for one task."""
    return df.hint("rebalance", F.col(chunk))
