"""Parquet, CSV and text tables: scans, appends, chunks and quarantine lists."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from strandline.operators.gate import QUARANTINE_SCHEMA
from strandline.operators.ordering import with_global_index
from strandline.operators.packing import ROWS_PER_CHUNK, row_chunk
from strandline.session import write_through
from strandline.sources.files import list_files, object_store_options, resolve, stem

# Advised size of a packed file.
TARGET_FILE_BYTES = 256 * 1024 * 1024


# ---------------------------------------------------------------- scans

def parquet_scan(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """One or many Parquet files or directories as one table; only ``columns`` are read if given."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def object_store_scan(spark: SparkSession, url: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet from an object store without credentials, or from any other path."""
    path, options = object_store_options(url)
    df = spark.read.options(**options).parquet(path)
    return df.select(*columns) if columns else df


def layer_ingest(df: DataFrame, layer: str, order_by: list[str | Column] | None = None,
                 fid: str | None = None) -> DataFrame:
    """A table as a named layer with dense feature numbers ``_fid``.

    ``fid`` names a column that already numbers the features from 0; otherwise they
    are numbered in ``order_by`` order, which must be total.
    """
    if fid is not None:
        df = df.withColumn("_fid", F.col(fid).cast("bigint"))
    else:
        df = with_global_index(df, order_by, "_fid")
    return df.withColumn("_layer", F.lit(layer))


# ---------------------------------------------------------------- footers

FOOTER_SCHEMA = ("path string, column_name string, data_type string, spark_type string, ordinal int, n_rows bigint, "
                 "error string")


def footer_columns(files: DataFrame) -> DataFrame:
    """One row per column of each Parquet file in ``files`` (path), read from the footers on executors.

    ``data_type`` is Arrow's name of the type, ``spark_type`` Spark's.
    """
    def read(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                try:
                    fs, local = resolve(path)
                    with fs.open_input_file(local) as handle:
                        footer = pq.ParquetFile(handle)
                        rows += [(path, f.name, str(f.type), from_arrow_type(f.type).simpleString(), i,
                                  footer.metadata.num_rows, None) for i, f in enumerate(footer.schema_arrow)]
                except (OSError, pa.ArrowException, UnsupportedOperationException) as err:
                    rows.append((path, None, None, None, None, None, str(err)[:200]))
            if rows:
                kinds = (*[pa.string()] * 4, pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["path", "column_name", "data_type", "spark_type", "ordinal", "n_rows", "error"])
    return spread(files.select("path")).mapInArrow(read, FOOTER_SCHEMA)


def spread(files: DataFrame, per_task: int = 64) -> DataFrame:
    """A manifest over enough partitions that no task opens more than about ``per_task`` files."""
    return files.repartition(max(1, -(-files.count() // per_task)))


# ---------------------------------------------------------------- datasets

def append_by_source(df: DataFrame, path: str, source: str = "_source_file", mode: str = "append") -> None:
    """Append to a dataset with one directory ``source_stem=…`` per source file.

    The rebalance brings a source's rows together and lets AQE cut a large source into several files.
    """
    keyed = df.withColumn("source_stem", stem(F.col(source))).hint("rebalance", F.col("source_stem"))
    keyed.write.mode(mode).partitionBy("source_stem").parquet(path)


def dataset_columns(footers: DataFrame) -> T.StructType:
    """The columns of all files of a dataset, from ``footer_columns``; a column of two types is an error.

    One row for each different column reaches the driver.
    """
    found = (footers.where("error is null and column_name is not null").groupBy("column_name")
             .agg(F.collect_set("spark_type").alias("types"), F.min("ordinal").alias("ordinal"))
             .orderBy("ordinal", "column_name").collect())
    clash = [f"{r.column_name}: {', '.join(sorted(r.types))}" for r in found if len(r.types) > 1]
    if clash:
        raise TypeError(f"columns of more than one type: {'; '.join(clash)}")
    return T.StructType([T.StructField(r.column_name, T.DataType.fromDDL(r.types[0])) for r in found])


def read_by_source(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A dataset written by ``append_by_source``, with the columns that any of its files has.

    Stems stay text even where they look like numbers.
    """
    schema = schema or dataset_columns(write_through(footer_columns(parquet_sizes(spark, path)), "footers"))
    kept = [f for f in schema.fields if f.name != "source_stem"]
    return spark.read.schema(T.StructType([*kept, T.StructField("source_stem", T.StringType())])).parquet(path)


# Folders of a dataset of versions, hidden from plain reads: which sources a put wrote, and which puts count.
ENTRIES, COMMITS = "_entries", "_commits"
_ENTRY_SCHEMA, _COMMIT_SCHEMA = "source_stem string, source_put string", "number long, source_put string"


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of a dataset; without rows where it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if not _is_absent(err):
            raise
        return spark.createDataFrame([], schema)


def put_sources(df: DataFrame, path: str, source: str = "_source_file", put: str | None = None) -> None:
    """Write sources into a dataset of versions; a source that was there before is replaced as a whole.

    Rows go to a folder of this put, ``source_put=…/source_stem=…``, which nobody reads until the last step: one row, in one
    file, that commits it. So running it again gives the rows once, a run that fails leaves the version before it in place,
    and nothing is renamed or deleted. ``put`` names the put; it must be new. Sources without rows are not seen.
    """
    spark, put = df.sparkSession, put or uuid.uuid4().hex
    folder = f"{path}/source_put={put}"
    keyed = df.withColumn("source_stem", stem(F.col(source))).hint("rebalance", F.col("source_stem"))
    keyed.write.mode("errorifexists").partitionBy("source_stem").parquet(folder)
    stems = T.StructType([*df.schema, T.StructField("source_stem", T.StringType())])
    written = spark.read.schema(stems).parquet(folder).select("source_stem").distinct()
    written.withColumn("source_put", F.lit(put)).write.mode("append").parquet(f"{path}/{ENTRIES}")
    number = _log(spark, f"{path}/{COMMITS}", _COMMIT_SCHEMA).agg(F.coalesce(F.max("number"), F.lit(0)) + 1)
    commit = number.toDF("number").select("number", F.lit(put).alias("source_put"))
    write_through(commit, "commit").coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")


def source_versions(spark: SparkSession, path: str) -> DataFrame:
    """``source_stem, source_put, number``: the version of each source that counts, the last one committed."""
    commits = _log(spark, f"{path}/{COMMITS}", _COMMIT_SCHEMA)
    entries = _log(spark, f"{path}/{ENTRIES}", _ENTRY_SCHEMA).join(commits, "source_put")
    last = entries.groupBy("source_stem").agg(F.max(F.struct("number", "source_put")).alias("last"))
    return last.select("source_stem", F.col("last.source_put").alias("source_put"), F.col("last.number").alias("number"))


def read_sources(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The last committed version of every source of a dataset written by ``put_sources``, with ``source_stem``.

    The columns are those that any file has; folders that no source's version lies in are pruned by the join.
    """
    schema = schema or dataset_columns(write_through(footer_columns(parquet_sizes(spark, path)), "footers"))
    place = ["source_put", "source_stem"]
    kept = T.StructType([f for f in schema.fields if f.name not in place])
    rows = spark.read.schema(T.StructType([*kept, *(T.StructField(c, T.StringType()) for c in place)])).parquet(path)
    return rows.join(source_versions(spark, path).drop("number"), place, "left_semi").drop("source_put")


def _is_absent(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


def write_chunks(df: DataFrame, path: str, layer: str, rows: int = ROWS_PER_CHUNK, fid: str = "_fid",
                 mode: str = "overwrite") -> None:
    """One directory per layer and chunk of ``rows`` consecutive features.

    A chunk has a bounded number of rows, so one task per chunk never grows.
    """
    chunked = df.withColumn("_layer", F.lit(layer)).withColumn("chunk_id", row_chunk(F.col(fid), rows))
    (chunked.repartition("chunk_id").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("_layer", "chunk_id").parquet(path))


def read_chunks(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """All chunks of one layer; chunks may lack columns of others."""
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(f"{path}/_layer={layer}")


def combine_chunks(spark: SparkSession, chunks: str, layer: str, target: str) -> bool:
    """Chunks of one layer as one dataset outside the chunk directory; False if there are none."""
    try:
        df = read_chunks(spark, chunks, layer)
    except AnalysisException as err:
        if not _is_absent(err):
            raise
        return False
    df.drop("_layer", "chunk_id").hint("rebalance").write.mode("overwrite").parquet(target)
    return True


def parquet_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, size_bytes) of every Parquet file below ``path``."""
    return list_files(spark, path, ".parquet", recursive=True)


# ---------------------------------------------------------------- quarantine lists

def write_quarantine_csv(report: DataFrame, path: str) -> None:
    """Failed files with their columns; the header is there even if no file failed."""
    report.select("file_name", "reason", "column_name", "data_type") \
        .write.mode("overwrite").option("header", "true").csv(path)


def read_quarantine_csv(spark: SparkSession, path: str) -> DataFrame:
    """The failed-file table; empty where nothing was written."""
    try:
        return spark.read.schema(QUARANTINE_SCHEMA).option("header", "true").csv(path)
    except AnalysisException as err:
        if not _is_absent(err):
            raise
        return spark.createDataFrame([], QUARANTINE_SCHEMA)


def write_quarantine_text(failed: DataFrame, path: str, column: str = "path") -> None:
    failed.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
