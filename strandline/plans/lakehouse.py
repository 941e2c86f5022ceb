"""The feature lakehouse job: shapefiles to aligned, packed GeoParquet with a quarantine list."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.align import align_types, aligned_type
from strandline.functions.crs import WGS84
from strandline.functions.geometry import set_crs
from strandline.operators.gate import quarantine_report, schema_gate, skip_quarantined
from strandline.operators.packing import AT_LEAST_BYTES, compact_chunks, pack_files
from strandline.operators.skew import skew_join
from strandline.session import release, scratch_path, write_through
from strandline.sources.datasets import (
    dataset_columns, footer_columns, parquet_sizes, read_quarantine_csv, write_quarantine_csv, write_quarantine_text)
from strandline.sources.files import file_select_contains, list_files, plain_path
from strandline.sources.geoparquet import consolidate, geoparquet_scan, geoparquet_write
from strandline.sources.shapefile import RANGE_BYTES, read_features, read_headers, record_ranges

# Columns the job adds to those of the files.
KEYS = ["_source_file", "_fid"]


@dataclass
class LakehouseConfig:
    """``input_dir`` to ``columns_to_convert`` are fixed values, the keys of the JSON config; the rest are tuning."""

    input_dir: str
    output_dir: str
    log_dir: str | None = None
    file_name_selectors: list[str] | None = None
    columns_to_convert: list[str] | None = None
    chunk_bytes: int = AT_LEAST_BYTES
    packing_rule: str = "at_least"
    range_bytes: int = RANGE_BYTES
    schema_of_record: list[list[str]] | None = None

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LakehouseConfig:
        """Read a JSON config from any path Spark can read; unknown keys are ignored."""
        text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in json.loads(text).items() if k in known})


class FeatureLakehouse:
    """The stages; each can run alone once its inputs exist, and all replace their own output."""

    def __init__(self, spark: SparkSession, config: LakehouseConfig):
        self.spark, self.config = spark, config
        out = config.output_dir.rstrip("/")
        self.features_path, self.packed_path = f"{out}/features", f"{out}/packed"
        self.parts_path, self.final_path = f"{out}/parts", f"{out}/consolidated"
        logs = (config.log_dir or out).rstrip("/")
        self.failed_path, self.unpackable_path = f"{logs}/failed_files", f"{logs}/unpackable_files"

    def run(self) -> DataFrame:
        """All stages; returns the run report (file_name, status, reason). Without any good file it stops after the first."""
        report = self.ingest()
        if self.pack():
            self.to_geoparquet()
            self.consolidate()
        return report

    # ------------------------------------------------------------ stage 1

    def select_files(self) -> DataFrame:
        return file_select_contains(list_files(self.spark, self.config.input_dir), self.config.file_name_selectors)

    def aligned_columns(self, headers: DataFrame) -> DataFrame:
        """(file_name, column_name, data_type) as every file will look once selected and aligned."""
        wanted = self.config.columns_to_convert
        columns = headers.where("reason is null and column_name is not null")
        kinds = [r.data_type for r in columns.select("data_type").distinct().collect()]  # a few type names
        pairs = [F.lit(x) for k in kinds for x in (k, aligned_type(T.DataType.fromDDL(k)).simpleString())]
        kind = F.element_at(F.create_map(*pairs), F.col("data_type")) if pairs else F.col("data_type")
        columns = columns.select("file_name", "column_name", kind.alias("data_type"))
        if not wanted:
            return columns
        files = headers.where("reason is null").select("file_name").distinct()
        slots = files.select("file_name", F.explode(F.array(*[F.lit(c) for c in wanted])).alias("column_name"))
        return (slots.join(columns, ["file_name", "column_name"], "left")
                .select("file_name", "column_name", F.coalesce("data_type", F.lit("string")).alias("data_type")))

    def ingest(self) -> DataFrame:
        """Read, align and write all files that agree on a schema; list the others with their columns."""
        headers = write_through(read_headers(self.select_files()), "headers")
        columns = write_through(self.aligned_columns(headers), "columns")
        record = None
        if self.config.schema_of_record:
            record = self.spark.createDataFrame(self.config.schema_of_record, "column_name string, data_type string")
        verdict = write_through(schema_gate(columns, record), "verdict")
        accepted = verdict.where("accepted").select("file_name")
        rejected = (headers.where("reason is not null").select("file_name", "reason").distinct()
                    .unionByName(verdict.where("not accepted")
                                 .select("file_name", F.lit("schema_mismatch").alias("reason"))))
        good = headers.join(accepted, "file_name", "left_semi")
        features = read_features(record_ranges(good, self.config.range_bytes),
                                 self._attributes(headers, columns, accepted), task_bytes=self.config.range_bytes)
        staged = scratch_path(self.spark, "features")
        aligned = self._aligned(features)
        aligned.write.mode("overwrite").parquet(staged)
        self.null_geometries = self._nulls.get["n"]
        rows = self.spark.read.schema(aligned.schema).parquet(staged)
        broken = (rows.where("_error is not null").groupBy(F.col("_source_file").alias("file_name"))
                  .agg(F.min("_error").alias("reason")))
        failed = write_through(rejected.unionByName(broken), "failed")
        self._publish(rows, failed)
        release(self.spark, staged)
        write_quarantine_csv(
            quarantine_report(headers.where("column_name is not null")
                              .select("file_name", "column_name", "data_type"), failed), self.failed_path)
        names = headers.select("file_name").distinct()
        return (names.join(failed.withColumn("_failed", F.lit(True)), "file_name", "left")
                .select("file_name", F.when(F.col("_failed"), "failed").otherwise("succeeded").alias("status"),
                        "reason"))

    def absent_columns(self) -> DataFrame:
        """(file_name, column_name): configured columns that a readable file lacks; ingest fills them with nulls."""
        headers = read_headers(self.select_files()).where("reason is null and column_name is not null")
        wanted = F.explode(F.array(*[F.lit(c) for c in self.config.columns_to_convert or []])).alias("column_name")
        if not self.config.columns_to_convert:
            return headers.select("file_name", "column_name").limit(0)
        found = headers.select("file_name", "column_name").distinct()
        return found.select("file_name").distinct().select("file_name", wanted).join(
            found, ["file_name", "column_name"], "left_anti")

    def _attributes(self, headers: DataFrame, columns: DataFrame, accepted: DataFrame) -> T.StructType:
        """The attributes to read, in the order of record; one row per column of one file reaches the driver."""
        first = accepted.agg(F.min("file_name").alias("file_name"))
        of_first = columns.join(F.broadcast(first), "file_name", "left_semi")
        placed = headers.select("file_name", "column_name", "ordinal").distinct()
        found = of_first.join(placed, ["file_name", "column_name"], "left").orderBy("ordinal").collect()
        kinds = {r.column_name: r.data_type for r in found}
        order = self.config.columns_to_convert or list(kinds)
        # Dates and flags are read as they are stored; the alignment that follows turns them into text.
        as_read = {"string": T.StringType(), "float": T.FloatType(), "boolean": T.BooleanType()}
        return T.StructType([T.StructField(c, as_read[kinds[c]]) for c in order if c in kinds])

    def _aligned(self, features: DataFrame) -> DataFrame:
        """Aligned features; null geometries go, rows that report an error stay."""
        error, geometry = F.col("_error"), F.col("geometry")
        self._nulls = Observation("null geometries")
        features = features.observe(self._nulls, F.count_if(geometry.isNull() & error.isNull()).alias("n"))
        return align_types(features.where(geometry.isNotNull() | error.isNotNull()),
                           keep=(*KEYS, "geometry", "bbox", "_error"))

    def _publish(self, rows: DataFrame, failed: DataFrame) -> None:
        """Staged rows of files without any error, as one dataset in which ``_source_file`` tells the source.

        A staging task read whole ranges of a file, so a source's rows stay together as they come.
        """
        kept = skip_quarantined(rows, failed, "_source_file")
        kept = set_crs(kept.select(*[c for c in rows.columns if c != "_error"]), WGS84)
        kept.write.mode("overwrite").parquet(self.features_path)

    # ------------------------------------------------------------ stages 2 to 4

    def pack(self) -> bool:
        """Group sources into chunks of at least the configured size, in name order; False if there are none.

        A source's size is that of its values, so the chunks do not depend on how the files were written. Files that
        cannot be read, or do not fit the others, are listed and left out. That all other rows arrive is checked.
        """
        footers = write_through(footer_columns(parquet_sizes(self.spark, self.features_path)), "footers")
        verdict = schema_gate(footers.where("error is null").select(
            F.col("path").alias("file_name"), "column_name", "data_type"))
        failed = write_through(
            footers.where("error is not null").select("path").distinct()
            .unionByName(verdict.where("not accepted").select(F.col("file_name").alias("path"))), "unpackable")
        write_quarantine_text(failed, self.unpackable_path)
        good = write_through(footers.join(failed, "path", "left_anti"), "good-footers")
        schema = dataset_columns(good)
        if not schema.fields:
            return False
        # Spark leaves out what it cannot open; files it can open but that do not fit go by their path.
        rows = self.spark.read.schema(schema).options(ignoreCorruptFiles=True, recursiveFileLookup=True).parquet(
            self.features_path)
        rows = rows.withColumn("_path", plain_path(F.col("_metadata.file_path")))
        rows = rows.join(failed.withColumnRenamed("path", "_path"), "_path", "left_anti").drop("_path")
        sizes = rows.groupBy("_source_file").agg(F.sum(_value_bytes(schema)).alias("size_bytes"))
        plan = write_through(pack_files(write_through(sizes, "sizes"), self.config.chunk_bytes, self.config.packing_rule,
                                        path="_source_file").select("_source_file", "chunk_id"), "packing")
        expected = good.groupBy("path").agg(F.max("n_rows").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not expected:
            return False
        packed = Observation("packed rows")
        chunks = compact_chunks(skew_join(rows, plan, ["_source_file"], "inner"))
        chunks.observe(packed, F.count("*").alias("n")).write.mode("overwrite") \
            .partitionBy("chunk_id").parquet(self.packed_path)
        if packed.get["n"] != expected:
            raise RuntimeError(f"{packed.get['n']} of {expected} rows were packed")
        return True

    def to_geoparquet(self) -> None:
        """The packed rows as GeoParquet parts with their CRS; a part holds rows of one chunk only."""
        rows = self.spark.read.parquet(self.packed_path).hint("rebalance", F.col("chunk_id"))
        geoparquet_write(rows, self.parts_path, WGS84, split_by="chunk_id")

    def consolidate(self) -> int:
        """The parts as files of the target size, neighbours together."""
        return consolidate(self.spark, self.parts_path, self.final_path, self.config.chunk_bytes)

    # ------------------------------------------------------------ results

    def result(self) -> DataFrame:
        return geoparquet_scan(self.spark, self.final_path)

    def failed_files(self) -> DataFrame:
        return read_quarantine_csv(self.spark, self.failed_path)


def _value_bytes(schema: T.StructType) -> Column:
    """The bytes of a row's values: those of texts and geometries, eight for anything else."""
    long = (T.StringType, T.BinaryType)
    parts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, long) else F.lit(8)
             for f in schema.fields if f.name not in KEYS]
    return reduce(Column.__add__, parts, F.lit(0)).cast("bigint")
