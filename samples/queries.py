"""The registered queries, each next to the SQL that gives the same rows.

A query takes the session and the folder of the given tables. Outputs go to the
shared scratch folder and are read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samples import shapefiles
from samples.views import cell_features, features, point_features, table, view, with_clause
from strandline.functions import align, crs
from strandline.functions import geometry as geo
from strandline.operators import aggregates, columns, dictionary, gate, geojoin, ordering, packing, sampling, spatial
from strandline.plans.lakehouse import FeatureLakehouse, LakehouseConfig
from strandline.plans.layer_export import export_layer
from strandline.plans.occurrence import occurrence_profile
from strandline.plans.reconcile import lookup_status, reconcile_chunks, reconcile_sampled
from strandline.session import scratch_path, write_through
from strandline.sources import datasets, files, geoparquet, shapereader
from strandline.sources.shapefile import shapefile_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

GEOM = "CAST(wkt AS GEOMETRY)"
HEX = f"hex(ST_AsWKB({GEOM}))"
LIMIT = 50_000
FAILED_FILES = ["GB0003.shp", "IT0004.shp"]
SEED = 7


def query(sql: str):
    """Register a function under its name, without a ``_query`` that only avoids a clash."""
    def register(fn: Query) -> Query:
        key = fn.__name__.removesuffix("_query")
        QUERIES[key], ORACLE[key] = fn, sql
        return fn
    return register


def feat(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf, "feat")


def feat_copy(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf, "feat_copy")


def failed_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f,) for f in FAILED_FILES], "file_name string")


# ================================================================ sources and sinks

@query(with_clause("manifest") + """
SELECT path, size_bytes, n_rows FROM manifest WHERE contains(path, 'f001') OR contains(path, 'f009')""")
def file_select_contains(spark, sf):
    return files.file_select_contains(view(spark, sf, "manifest"), ["f001", "f009"], "path")


@query(with_clause("manifest") + "SELECT path, size_bytes, n_rows FROM manifest WHERE starts_with(path, 'f00')")
def file_select_prefix(spark, sf):
    return files.file_select_prefix(view(spark, sf, "manifest"), ["f00"], "path")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def sample_files_of(spark: SparkSession, sf: str, name: str, broken: bool = False) -> str:
    """The folder of the sample shapefiles of ``feat``, written once for an application and folder of tables."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        folder = scratch_path(spark, name)
        shapefiles.export_features(view(spark, sf, "feat"), folder).count()
        if broken:
            shapefiles.write_broken(folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]


@query(with_clause("feat") + f"""
SELECT _fid AS feature, gui, hab_type, orig_hab, sum_conf, round(comp, 4) AS comp, ST_AsText({GEOM}) AS wkt
FROM feat""")
def shapefile_ingest_query(spark, sf):
    rows = shapefile_ingest(files.list_files(spark, sample_files_of(spark, sf, "shapes")))
    return rows.select("feature", "gui", "hab_type", "orig_hab", "sum_conf", F.round("comp", 4).alias("comp"),
                       geo.geom_to_wkt("geometry").alias("wkt"))


@query(with_clause("pts", "feat") + f"""
SELECT _fid AS feature, gui, ST_AsText({GEOM}) AS wkt
FROM feat JOIN pts USING (_fid) WHERE wkt IS NOT NULL AND lon BETWEEN -20 AND 35.5 AND lat BETWEEN -10 AND 41""")
def shapefile_window(spark, sf):
    shapereader.register(spark)
    rows = spark.read.format("shapefile").load(sample_files_of(spark, sf, "shapes"))
    return rows.where(geoparquet.meets(F.col("bbox"), (-20, -10, 35.5, 41))).select("feature", "gui", geo.geom_to_wkt("geometry").alias("wkt"))


@query("""
SELECT 'orders' AS _layer, row_number() OVER (ORDER BY o_orderkey) - 1 AS _fid, o_orderkey, o_custkey FROM orders""")
def layer_ingest(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return datasets.layer_ingest(orders, "orders", order_by=["o_orderkey"])


@query("SELECT * FROM part")
def parquet_scan(spark, sf):
    return datasets.parquet_scan(spark, f"{sf}/part.parquet")


@query("SELECT p_partkey, p_brand, p_size FROM part")
def parquet_scan_pruned(spark, sf):
    return datasets.parquet_scan(spark, f"{sf}/part.parquet", columns=["p_partkey", "p_brand", "p_size"])


def write_parts(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "parts")
    parts = feat(spark, sf).where("geometry is not null").withColumn("bbox", geo.geom_bbox("geometry"))
    geoparquet.geoparquet_write(parts.withColumnRenamed("gui", "GUI").repartition(4), path)
    return path


@query(with_clause("feat") + f"""
SELECT _fid, gui, 4326 AS srid, ST_AsText({GEOM}) AS wkt FROM feat WHERE wkt IS NOT NULL""")
def geoparquet_scan(spark, sf):
    df = geoparquet.geoparquet_scan(spark, write_parts(spark, sf))
    return df.select("_fid", "gui", F.lit(geo.crs_of(df)).cast("int").alias("srid"),
                     geo.geom_to_wkt("geometry").alias("wkt"))


@query("SELECT * FROM part")
def object_store_scan(spark, sf):
    return datasets.object_store_scan(spark, f"{sf}/part.parquet")


@query(with_clause("feat") + "SELECT _fid, gui, replace(_source_file, '.shp', '') AS source_stem FROM feat")
def parquet_append_by_source(spark, sf):
    path = scratch_path(spark, "by-source")
    source = view(spark, sf, "feat")
    for country in ("IT", "GB"):
        datasets.append_by_source(source.where(F.col("_source_file").startswith(country)), path)
    return datasets.read_by_source(spark, path).select("_fid", "gui", "source_stem")


@query(with_clause("feat") + """
SELECT _fid, CASE WHEN _source_file LIKE 'IT%' THEN gui || '-again' ELSE gui END AS gui, replace(_source_file, '.shp', '') AS source_stem
FROM feat""")
def parquet_put_by_source(spark, sf):
    path = scratch_path(spark, "put-by-source")
    source = view(spark, sf, "feat").select("_source_file", "_fid", "gui")
    datasets.put_sources(source, path)
    datasets.put_sources(source.where("_source_file like 'IT%'").withColumn("gui", F.concat("gui", F.lit("-again"))), path)
    return datasets.read_sources(spark, path).select("_fid", "gui", "source_stem")


@query(with_clause("pts", "feat") + """
SELECT '1.1.0' AS version, 'WKB' AS encoding, 4326 AS srid,
       min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax
FROM pts JOIN feat USING (_fid) WHERE wkt IS NOT NULL""")
def geoparquet_write(spark, sf):
    footers = geoparquet.geo_footers(spark, write_parts(spark, sf))

    def item(path):
        return F.get_json_object("geo", f"$.{path}")
    box = [item(f"columns.geometry.bbox[{i}]").cast("double") for i in range(4)]
    return (footers.groupBy(item("version").alias("version"), item("columns.geometry.encoding").alias("encoding"),
                            item("columns.geometry.crs.id.code").cast("int").alias("srid"))
            .agg(F.min(box[0]).alias("xmin"), F.min(box[1]).alias("ymin"),
                 F.max(box[2]).alias("xmax"), F.max(box[3]).alias("ymax")))


@query(with_clause("feat") + f"SELECT _fid, gui, {HEX} AS wkb FROM feat WHERE wkt IS NOT NULL")
def geoparquet_consolidate(spark, sf):
    target = scratch_path(spark, "consolidated")
    geoparquet.consolidate(spark, write_parts(spark, sf), target, file_bytes=16_000)
    return geoparquet.geoparquet_scan(spark, target).select("_fid", "gui", F.hex("geometry").alias("wkb"))


@query(with_clause("pts", "feat") + f"""
SELECT _fid, gui, {HEX} AS wkb FROM feat JOIN pts USING (_fid) WHERE wkt IS NOT NULL AND lon BETWEEN -20 AND 35.5 AND lat BETWEEN -10 AND 41""")
def geoparquet_window(spark, sf):
    target = scratch_path(spark, "consolidated")
    geoparquet.consolidate(spark, write_parts(spark, sf), target, file_bytes=16_000)
    found = geoparquet.geoparquet_scan(spark, target, window=(-20, -10, 35.5, 41))
    return found.select("_fid", "gui", F.hex("geometry").alias("wkb"))


def layer_features(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return datasets.layer_ingest(orders, "orders", fid="o_orderkey")


def write_layer(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "chunks")
    datasets.write_chunks(layer_features(spark, sf), path, "orders", rows=1000)
    return path


@query("""
SELECT o_orderkey // 1000 + 1 AS chunk_id, count(*) AS n_rows, min(o_orderkey) AS first_fid, max(o_orderkey) AS last_fid
FROM orders GROUP BY 1""")
def chunk_write(spark, sf):
    return (datasets.read_chunks(spark, write_layer(spark, sf), "orders")
            .groupBy(F.col("chunk_id").cast("bigint").alias("chunk_id"))
            .agg(F.count("*").alias("n_rows"), F.min("_fid").alias("first_fid"), F.max("_fid").alias("last_fid")))


@query("SELECT o_orderkey AS _fid, o_custkey, o_orderstatus FROM orders")
def combine_chunks(spark, sf):
    target = scratch_path(spark, "combined")
    datasets.combine_chunks(spark, write_layer(spark, sf), "orders", target)
    return datasets.parquet_scan(spark, target, columns=["_fid", "o_custkey", "o_orderstatus"])


# Every source file of feat as Parquet: files divisible by five hold sum_conf as double, every seventh lacks hab_type.
_FILE_COLUMNS = """
files AS (SELECT DISTINCT replace(_source_file, '.shp', '') AS file_name,
                 CAST(substr(_source_file, 3, 4) AS INT) AS n FROM feat),
kinds(place, column_name, kind) AS (VALUES
    (0, '_source_file', 'string'), (1, '_fid', 'int64'), (2, 'gui', 'string'), (3, 'hab_type', 'string'),
    (4, 'orig_hab', 'string'), (5, 'sum_conf', 'int32'), (6, 'comp', 'double'), (7, 'wkt', 'string')),
cols AS (SELECT file_name, n, column_name, place,
                CASE WHEN column_name = 'sum_conf' AND n % 5 = 0 THEN 'double' ELSE kind END AS data_type
         FROM files CROSS JOIN kinds WHERE NOT (column_name = 'hab_type' AND n % 7 = 3)),
failed AS (SELECT file_name, 'schema_mismatch' AS reason FROM files WHERE n % 5 = 0 OR n % 7 = 3)
"""


def drifted(sql: str) -> str:
    return with_clause("feat").rstrip() + ", " + _FILE_COLUMNS + sql


def drifted_footers(spark: SparkSession, sf: str) -> DataFrame:
    """(file_name, column_name, data_type, ordinal) of the files described above, from their footers."""
    path, source = scratch_path(spark, "drifted"), view(spark, sf, "feat")
    number = F.substring("_source_file", 3, 4).cast("int")
    wide, short = number % 5 == 0, number % 7 == 3
    for is_wide in (False, True):
        for is_short in (False, True):
            rows = source.where((wide == is_wide) & (short == is_short))
            rows = rows.withColumn("sum_conf", F.col("sum_conf").cast("double")) if is_wide else rows
            datasets.append_by_source(rows.drop("hab_type") if is_short else rows, path)
    footers = datasets.footer_columns(datasets.parquet_sizes(spark, path))
    stem = F.regexp_extract("path", "source_stem=([^/]+)", 1)
    footers = footers.select(stem.alias("file_name"), "column_name", "data_type", "ordinal").distinct()
    return write_through(footers, "footers")


def drift_failures(found: DataFrame) -> DataFrame:
    verdict = gate.schema_gate(found.select("file_name", "column_name", "data_type"))
    return verdict.where("not accepted").select("file_name", F.lit("schema_mismatch").alias("reason"))


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    found = drifted_footers(spark, sf)
    return gate.quarantine_report(found.drop("ordinal"), drift_failures(found))


_REPORT = "SELECT file_name, reason, column_name, data_type FROM failed JOIN cols USING (file_name)"


@query(drifted(_REPORT))
def quarantine_csv(spark, sf):
    path = scratch_path(spark, "failed-csv")
    datasets.write_quarantine_csv(drift_report(spark, sf), path)
    return spark.read.option("header", "true").csv(path)


@query(drifted("SELECT file_name AS value FROM failed"))
def quarantine_text(spark, sf):
    path = scratch_path(spark, "failed-text")
    datasets.write_quarantine_text(drift_failures(drifted_footers(spark, sf)), path, "file_name")
    return spark.read.text(path)


@query(drifted("SELECT file_name, count(*) AS n_columns FROM failed JOIN cols USING (file_name) GROUP BY file_name"))
def quarantine_read(spark, sf):
    path = scratch_path(spark, "failed-csv")
    datasets.write_quarantine_csv(drift_report(spark, sf), path)
    found = datasets.read_quarantine_csv(spark, path)
    absent = datasets.read_quarantine_csv(spark, scratch_path(spark, "never-written"))
    return found.unionByName(absent).groupBy("file_name").agg(F.count("column_name").alias("n_columns"))


@query("SELECT o_orderkey, o_custkey FROM orders")
def overwrite_output(spark, sf):
    path = scratch_path(spark, "overwritten")
    table(spark, sf, "customer").write.mode("overwrite").parquet(path)
    table(spark, sf, "orders").select("o_orderkey", "o_custkey").write.mode("overwrite").parquet(path)
    return datasets.parquet_scan(spark, path)


@query(with_clause("manifest") + """
SELECT count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM manifest""")
def size_total(spark, sf):
    return packing.size_total(view(spark, sf, "manifest"))


# ================================================================ projections and filters

@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def lowercase_columns(spark, sf):
    part = table(spark, sf, "part")
    return columns.lowercase_columns(part.toDF(*[c.upper() for c in part.columns]))


@query(with_clause("feat") + f"SELECT gui, CAST(NULL AS VARCHAR) AS no_such, comp, {HEX} AS geometry FROM feat")
def select_with_fill(spark, sf):
    picked = columns.select_with_fill(feat(spark, sf), ["gui", "no_such", "comp"])
    return picked.withColumn("geometry", F.hex("geometry"))


@query(with_clause("feat") + f"SELECT _fid, {HEX} AS geometry FROM feat WHERE wkt IS NOT NULL")
def drop_null_geometry(spark, sf):
    return columns.drop_null_geometry(feat(spark, sf)).select("_fid", F.hex("geometry").alias("geometry"))


@query(with_clause("feat") + f"SELECT _fid, {HEX} AS wkb FROM feat")
def null_safe_geometry(spark, sf):
    return feat(spark, sf).select("_fid", F.hex(geo.geom_to_wkb(F.col("geometry"))).alias("wkb"))


@query(with_clause("feat") + "SELECT _source_file, _fid, gui, hab_type, orig_hab, sum_conf, comp FROM feat")
def drop_column(spark, sf):
    return feat(spark, sf).drop("geometry")


@query("SELECT l_orderkey, l_partkey FROM lineitem WHERE l_suppkey = 7")
def filter_eq_project(spark, sf):
    return columns.filter_eq_project(table(spark, sf, "lineitem"), "l_suppkey", 7, ["l_orderkey", "l_partkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey = 7
ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 5""")
def filter_eq_head(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    return columns.filter_eq_head(table(spark, sf, "lineitem"), "l_suppkey", 7, order).select(*order)


@query(with_clause("feat") + "SELECT _fid, gui, orig_hab FROM feat WHERE gui = 'GUI3'")
def lookup_by_key(spark, sf):
    return columns.lookup_by_key(view(spark, sf, "feat"), "gui", "GUI3").select("_fid", "gui", "orig_hab")


@query("SELECT p_partkey, p_type FROM part WHERE contains(p_type, 'ECON')")
def filter_contains(spark, sf):
    return columns.filter_contains(table(spark, sf, "part"), "p_type", "ECON").select("p_partkey", "p_type")


@query(with_clause("manifest") + """
SELECT path, replace(path, '.shp', '') IN (
    SELECT concat('f', lpad(CAST(s_suppkey AS VARCHAR), 4, '0')) FROM supplier WHERE s_acctbal > 5000) AS is_member
FROM manifest""")
def membership_flag(spark, sf):
    rich = table(spark, sf, "supplier").where("s_acctbal > 5000").select(
        F.concat(F.lit("f"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0")).alias("gui"))
    return columns.membership_flag(view(spark, sf, "manifest").select("path"), "path", rich, "gui")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def head_n(spark, sf):
    return columns.head_n(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"])


@query("SELECT o_orderkey AS _fid, o_custkey FROM orders WHERE o_orderkey >= 3000 AND o_orderkey < 3500")
def feature_slice(spark, sf):
    return columns.feature_slice(layer_features(spark, sf), 3000, 3500).select("_fid", "o_custkey")


@query("""
SELECT table_name AS source, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
                      ELSE data_type END AS data_type,
       CAST(ordinal_position - 1 AS INTEGER) AS ordinal
FROM information_schema.columns WHERE table_name IN ('customer', 'part', 'documents')""")
def schema_report(spark, sf):
    return reduce(DataFrame.unionAll, [columns.schema_report(table(spark, sf, t), t) for t in ("customer", "part", "documents")])


@query("SELECT p_name, p_brand, p_type FROM part")
def select_by_type(spark, sf):
    return columns.select_by_type(table(spark, sf, "part"), T.StringType)


# ================================================================ type alignment

@query(with_clause("feat") + "SELECT _fid, coalesce(hab_type, 'None') AS hab_type, gui FROM feat")
def align_text(spark, sf):
    df = align.align_types(view(spark, sf, "feat"), keep=("_fid",))
    return df.select("_fid", "hab_type", "gui")


@query("""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_orderkey * 1000003 + l_partkey AS FLOAT) AS DOUBLE) AS as_float
FROM lineitem""")
def align_int(spark, sf):
    wide = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 1000003 + F.col("l_partkey")).alias("as_float"))
    df = align.align_types(wide, keep=("l_orderkey", "l_linenumber"))
    # Written and read back: the optimizer folds a cast to float and on to double into one cast.
    return write_through(df, "aligned").withColumn("as_float", F.col("as_float").cast("double"))


@query("""
SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 4) AS price FROM lineitem""")
def align_double(spark, sf):
    prices = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    df = align.align_types(prices, keep=("l_orderkey", "l_linenumber"))
    return df.withColumn("price", F.round(F.col("price").cast("double"), 4))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def align_timestamp(spark, sf):
    df = align.align_types(table(spark, sf, "events").select("event_id", "ts"), keep=("event_id",))
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(with_clause("feat") + """
, codes AS (SELECT hab_type, dense_rank() OVER (ORDER BY hab_type) - 1 AS code
            FROM (SELECT DISTINCT hab_type FROM feat WHERE hab_type IS NOT NULL))
SELECT _fid, hab_type, coalesce(code, -1) AS code FROM feat LEFT JOIN codes USING (hab_type)""")
def dictionary_encode(spark, sf):
    df = view(spark, sf, "feat").select("_fid", "hab_type")
    return dictionary.dictionary_encode(df, "hab_type")


# ================================================================ geometry columns

@query(with_clause("shapes") + f"SELECT _fid, ST_AsText({GEOM}) AS wkt FROM shapes")
def geom_to_wkt(spark, sf):
    return features(spark, sf, "shapes").select("_fid", geo.geom_to_wkt("geometry").alias("wkt"))


@query(with_clause("shapes") + f"SELECT _fid, {HEX} AS wkb FROM shapes")
def wkt_to_geom(spark, sf):
    return view(spark, sf, "shapes").select("_fid", F.hex(geo.wkt_to_geom("wkt")).alias("wkb"))


@query(with_clause("shapes") + f"SELECT _fid, {HEX} AS wkb FROM shapes")
def geom_to_wkb(spark, sf):
    stored = features(spark, sf, "shapes").withColumn("geometry", geo.canonical_wkb("geometry"))
    return stored.select("_fid", F.hex(geo.geom_to_wkb(F.col("geometry"))).alias("wkb"))


@query(with_clause("shapes") + """
SELECT _fid,
       CASE _fid % 9 WHEN 0 THEN 'POINT' WHEN 1 THEN 'LINESTRING' WHEN 2 THEN 'POLYGON' WHEN 3 THEN 'MULTIPOINT'
            WHEN 4 THEN 'MULTILINESTRING' WHEN 5 THEN 'MULTIPOLYGON' WHEN 6 THEN 'GEOMETRYCOLLECTION'
            WHEN 7 THEN 'POLYGON' END AS kind,
       CASE _fid % 9 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3
            WHEN 6 THEN 2 WHEN 7 THEN 0 END AS n_paths,
       CASE _fid % 9 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 10 WHEN 3 THEN 2 WHEN 4 THEN 4 WHEN 5 THEN 14
            WHEN 6 THEN 3 WHEN 7 THEN 0 END AS n_vertices
FROM shapes""")
def wkb_to_geom(spark, sf):
    parts = features(spark, sf, "shapes").select("_fid", geo.geom_parts("geometry").alias("parts"))
    paths = F.col("parts.rings")
    return parts.select("_fid", "parts.kind", F.when(paths.isNotNull(), F.size(paths)).alias("n_paths"),
                        F.when(paths.isNotNull(), F.size(F.flatten(paths))).alias("n_vertices"))


@query(with_clause("feat") + f"""
SELECT _fid, CASE WHEN _fid % 31 <> 0 THEN {HEX} END AS wkb,
       CASE WHEN _fid % 31 = 0 THEN 'invalid_geometry' END AS reason FROM feat""")
def geom_normalise_mixed(spark, sf):
    odd = F.col("_fid") % 2 == 1
    mixed = view(spark, sf, "feat").select(
        "_fid", F.when(~odd, geo.wkt_to_geom("wkt")).alias("binary"), F.when(odd, F.col("wkt")).alias("text"))
    broken = F.col("_fid") % 31 == 0
    mixed = mixed.withColumn("binary", F.when(broken, F.lit(None)).otherwise(F.col("binary")))
    mixed = mixed.withColumn("text", F.when(broken, F.lit("POINT (1 2")).otherwise(F.col("text")))
    geom, reason = geo.normalise_mixed(F.col("binary"), F.col("text"))
    return mixed.select("_fid", F.hex(geom).alias("wkb"), reason.alias("reason"))


@query(with_clause("feat") + f"SELECT _fid, 4326 AS srid, {HEX} AS wkb FROM feat")
def set_crs(spark, sf):
    df = geo.set_crs(feat(spark, sf), crs.WGS84)
    return df.select("_fid", F.lit(geo.crs_of(df)).cast("int").alias("srid"), F.hex("geometry").alias("wkb"))


@query(with_clause("pts") + """
, found AS (SELECT _fid, degrees(lon * 100000 / 6378137.0) AS x,
                   degrees(2 * atan(exp(lat * 100000 / 6378137.0)) - pi() / 2) AS y FROM pts)
SELECT _fid, round(x, 6) + 0.0 AS lon, round(y, 6) + 0.0 AS lat,
       round(x, 6) + 0.0 AS geom_lon, round(y, 6) + 0.0 AS geom_lat FROM found""")
def reproject_to_4326(spark, sf):
    metres = view(spark, sf, "pts").select("_fid", (F.col("lon") * 100000).alias("x"), (F.col("lat") * 100000).alias("y"))
    lon, lat = crs.to_wgs84(F.col("x"), F.col("y"))
    df = point_features(metres, "x", "y").select("_fid", lon.alias("lon"), lat.alias("lat"), geo.geom_bbox(
        crs.reproject(F.col("geometry"), crs.WEB_MERCATOR, crs.WGS84)).alias("box"))
    return df.select("_fid", *[(F.round(c, 6) + 0.0).alias(n) for c, n in (
        ("lon", "lon"), ("lat", "lat"), ("box.xmin", "geom_lon"), ("box.ymin", "geom_lat"))])


@query(with_clause("pts") + """
, found AS (SELECT _fid, 6378137.0 * radians(lon) AS x,
                   6378137.0 * ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM pts)
SELECT _fid, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y,
       round(x, 3) + 0.0 AS geom_x, round(y, 3) + 0.0 AS geom_y FROM found""")
def reproject_to_3857(spark, sf):
    x, y = crs.to_web_mercator(F.col("lon"), F.col("lat"))
    df = point_features(view(spark, sf, "pts")).select("_fid", x.alias("x"), y.alias("y"), geo.geom_bbox(
        crs.reproject(F.col("geometry"), crs.WGS84, crs.WEB_MERCATOR)).alias("box"))
    return df.select("_fid", *[(F.round(c, 3) + 0.0).alias(n) for c, n in (
        ("x", "x"), ("y", "y"), ("box.xmin", "geom_x"), ("box.ymin", "geom_y"))])


_PROBES = {"point": "POINT ({0} {1})", "line": "LINESTRING ({0} {1}, {2} {3})",
           "polygon": "POLYGON (({0} {1}, {2} {1}, {2} {3}, {0} {1}))"}


@query(with_clause("boxes") + """
, first AS (SELECT x0 + 5 AS lon, y0 + 3 AS lat FROM boxes WHERE box_id = 1)
SELECT probe, box_id, 'contains' AS relation FROM boxes, first, (VALUES ('point', 0.0), ('line', 1.5), ('polygon', 1.5)) p(probe, side)
WHERE x0 < lon AND lon + side < x1 AND y0 < lat AND lat + side < y1""")
def geom_contains(spark, sf):
    boxes = features(spark, sf, "boxes").withColumn("bbox", geo.geom_bbox("geometry"))
    first = view(spark, sf, "boxes").where("box_id = 1").selectExpr("x0 + 5 AS lon", "y0 + 3 AS lat").first()
    corners = (first.lon, first.lat, first.lon + 1.5, first.lat + 1.5)
    found = [spatial.containing_rows(boxes, geo.wkb_from_wkt(text.format(*corners)), ["box_id"], box="bbox")
             .select(F.lit(name).alias("probe"), "box_id", "relation") for name, text in _PROBES.items()]
    return reduce(DataFrame.unionAll, found)


@query(with_clause("pts", "pts_copy") + """
SELECT _fid, abs(a.lon - b.lon) <= 0.001 AND a.lat = b.lat AS is_near, a.lon = b.lon AND a.lat = b.lat AS is_equal
FROM pts a JOIN pts_copy b USING (_fid)""")
def geom_equals_tolerance(spark, sf):
    ours = point_features(view(spark, sf, "pts")).select("_fid", "geometry")
    theirs = point_features(view(spark, sf, "pts_copy")).select("_fid", F.col("geometry").alias("other"))
    return ours.join(theirs, "_fid").select(
        "_fid", geo.geom_equals_within("geometry", "other", 0.001).alias("is_near"),
        (F.col("geometry") == F.col("other")).alias("is_equal"))


@query(with_clause("pts", "pts_copy") + """
SELECT _fid FROM pts a
WHERE EXISTS (SELECT 1 FROM pts_copy b WHERE a.lat = b.lat AND abs(a.lon - b.lon) <= 0.001)""")
def geom_near_copies(spark, sf):
    ours = point_features(view(spark, sf, "pts")).select("_fid", "geometry")
    theirs = point_features(view(spark, sf, "pts_copy")).select("geometry")
    return spatial.near_copies(ours, theirs, 0.001).select("_fid")


@query(with_clause("feat", "feat_copy") + "SELECT _fid FROM feat WHERE wkt IN (SELECT wkt FROM feat_copy)")
def geom_equals(spark, sf):
    return geojoin.geom_equals_set(feat(spark, sf), feat_copy(spark, sf)).select("_fid")


@query(with_clause("pts", "cells", "boxes", "feat", "feat_copy") + """
SELECT _fid, CASE WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = f.wkt AND c.gui = f.gui) THEN 'match'
                  WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = f.wkt) THEN 'control_mismatch'
                  WHEN wkt IS NOT NULL AND EXISTS (SELECT 1 FROM (SELECT x0, x1, y0, y1 FROM cells UNION ALL
                      SELECT x0, x1, y0, y1 FROM boxes) WHERE lon > x0 AND lon < x1 AND lat > y0 AND lat < y1)
                  THEN 'contained_not_exact' ELSE 'not_contained' END AS status
FROM feat f JOIN pts USING (_fid)
UNION ALL SELECT -1 - box_id, CASE box_id % 3 WHEN 0 THEN 'match' WHEN 1 THEN 'near_copy' ELSE 'contained_not_exact' END FROM boxes""")
def geom_lookup_status(spark, sf):
    polygons = cell_features(spark, sf).select(F.lit("CELL").alias("gui"), "geometry")
    boxes = view(spark, sf, "boxes")
    held = boxes.select(F.concat(F.lit("BOX"), "box_id").alias("gui"), geo.wkt_to_geom("wkt").alias("geometry"))
    dataset = feat_copy(spark, sf).select("gui", "geometry").unionByName(polygons).unionByName(held)
    # The probes of the boxes: the box itself, one smaller by less than the tolerance, one half as wide.
    shrink = F.expr("CASE box_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0005 ELSE 2.5 END")
    sides = boxes.select("box_id", (F.col("x0") + shrink).alias("x0"), (F.col("x1") - shrink).alias("x1"),
                         (F.col("y0") + shrink).alias("y0"), (F.col("y1") - shrink).alias("y1"))
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    ring = F.concat_ws(", ", *[F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string")) for x, y in corners])
    shrunk = sides.select((-1 - F.col("box_id")).alias("_fid"), F.concat(F.lit("BOX"), "box_id").alias("gui"),
                          geo.wkt_to_geom(F.concat(F.lit("POLYGON (("), ring, F.lit("))"))).alias("geometry"))
    probes = feat(spark, sf).select("_fid", "gui", "geometry").unionByName(shrunk)
    return lookup_status(probes, dataset.withColumn("bbox", geo.geom_bbox("geometry")), ["_fid"], "gui", box="bbox")


# ================================================================ joins

@query(with_clause("feat", "feat_copy") + """
SELECT _fid, gui FROM feat WHERE wkt IN (SELECT wkt FROM feat_copy)""")
def geom_inner_join(spark, sf):
    return geojoin.geom_inner_join(feat(spark, sf), feat_copy(spark, sf)).select("_fid", "gui")


@query(with_clause("feat", "feat_copy") + """
SELECT _fid, gui FROM feat WHERE wkt IS NOT NULL AND wkt NOT IN (SELECT wkt FROM feat_copy)""")
def geom_left_anti(spark, sf):
    return geojoin.geom_anti_join(feat(spark, sf), feat_copy(spark, sf)).select("_fid", "gui")


@query(with_clause("feat", "feat_copy") + """
SELECT min(_fid) AS _fid FROM feat_copy
WHERE wkt NOT IN (SELECT wkt FROM feat WHERE wkt IS NOT NULL) GROUP BY wkt""")
def geom_right_anti(spark, sf):
    unique = aggregates.geom_dedupe(feat_copy(spark, sf))
    return geojoin.geom_anti_join(unique, feat(spark, sf)).select("_fid")


@query(with_clause("feat", "feat_copy") + """
, l AS (SELECT wkt, count(*) AS n FROM feat WHERE wkt IS NOT NULL GROUP BY wkt),
  r AS (SELECT DISTINCT wkt FROM feat_copy)
SELECT CAST(coalesce(sum(CASE WHEN r.wkt IS NOT NULL THEN n END), 0) AS BIGINT) AS matched,
       CAST(coalesce(sum(CASE WHEN r.wkt IS NULL THEN n END), 0) AS BIGINT) AS unmatched_left,
       count(*) FILTER (WHERE l.wkt IS NULL) AS unmatched_right,
       count(l.wkt) AS unique_left, count(r.wkt) AS unique_right
FROM l FULL JOIN r ON l.wkt = r.wkt""")
def geom_match_counts(spark, sf):
    return geojoin.geom_match_counts(feat(spark, sf), feat_copy(spark, sf))


_FAILED = ", ".join(f"'{f}'" for f in FAILED_FILES)


@query(with_clause("feat") + f"SELECT _source_file, _fid FROM feat WHERE _source_file NOT IN ({_FAILED})")
def skip_quarantined(spark, sf):
    rows = view(spark, sf, "feat").select("_source_file", "_fid")
    return gate.skip_quarantined(rows, failed_list(spark), "_source_file")


@query(with_clause("feat", "feat_copy") + """
SELECT _fid, CASE WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = f.wkt AND c.gui = f.gui) THEN 'match'
                  WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = f.wkt) THEN 'control_mismatch'
                  ELSE 'not_found' END AS status FROM feat f""")
def control_value_join(spark, sf):
    return geojoin.control_value_join(feat(spark, sf), feat_copy(spark, sf), "gui").select("_fid", "status")


@query(with_clause("pts", "cells") + """
SELECT _fid, cell_id FROM pts JOIN cells ON lon > x0 AND lon < x1 AND lat > y0 AND lat < y1""")
def spatial_containment_join(spark, sf):
    points = point_features(view(spark, sf, "pts"))
    return spatial.containment_join(cell_features(spark, sf), points, ["cell_id"], ["_fid"]).drop("relation")


@query(with_clause("pts", "boxes") + """
SELECT _fid, box_id FROM pts JOIN boxes ON lon > x0 AND lon < x1 AND lat > y0 AND lat < y1""")
def spatial_points_in_boxes(spark, sf):
    points = point_features(view(spark, sf, "pts"))
    return spatial.containment_join(features(spark, sf, "boxes"), points, ["box_id"], ["_fid"]).drop("relation")


@query(with_clause("pts", "cells", "boxes") + """
SELECT cell_id, box_id FROM cells c JOIN boxes b ON b.x0 >= c.x0 AND b.x1 <= c.x1 AND b.y0 >= c.y0 AND b.y1 <= c.y1""")
def spatial_boxes_in_cells(spark, sf):
    inner = features(spark, sf, "boxes").select("box_id", "geometry")
    return spatial.containment_join(cell_features(spark, sf), inner, ["cell_id"], ["box_id"]).drop("relation")


# ================================================================ aggregations

@query("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf):
    return aggregates.row_count(table(spark, sf, "lineitem"))


@query(with_clause("feat") + "SELECT count(*) AS null_geometries FROM feat WHERE wkt IS NULL")
def null_geometry_count(spark, sf):
    return aggregates.null_geometry_count(feat(spark, sf))


@query("SELECT l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def value_counts_topk(spark, sf):
    return aggregates.value_counts_topk(table(spark, sf, "lineitem"), "l_suppkey", 5)


@query("SELECT l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1 OFFSET 2")
def kth_most_common(spark, sf):
    return aggregates.kth_most_common(table(spark, sf, "lineitem"), "l_suppkey", 3)


@query(with_clause("feat") + "SELECT DISTINCT gui FROM feat")
def distinct_values(spark, sf):
    return aggregates.distinct_values(view(spark, sf, "feat"), "gui")


@query(with_clause("feat", "feat_copy") + """
SELECT _source_file, count(DISTINCT gui) AS n_values, arg_min(gui, _fid) AS first_value,
       count(DISTINCT gui) = 1 AS is_single FROM feat_copy GROUP BY _source_file""")
def single_value_check(spark, sf):
    return aggregates.single_value_check(view(spark, sf, "feat_copy"), "_source_file", "gui")


@query(with_clause("feat") + """
SELECT _fid, gui, wkt IS NULL AS no_geometry FROM feat
WHERE _fid IN (SELECT min(_fid) FROM feat GROUP BY wkt)""")
def geom_dedupe(spark, sf):
    kept = aggregates.geom_dedupe(feat(spark, sf))
    return kept.select("_fid", "gui", F.col("geometry").isNull().alias("no_geometry"))


@query(drifted("""
SELECT CASE WHEN n % 5 = 0 OR n % 7 = 3 THEN 'failed' ELSE 'succeeded' END AS status, count(*) AS n_files
FROM files GROUP BY 1"""))
def file_outcome_summary(spark, sf):
    verdict = gate.schema_gate(drifted_footers(spark, sf).drop("ordinal"))
    return aggregates.outcome_summary(
        verdict.withColumn("status", F.when(F.col("accepted"), "succeeded").otherwise("failed")))


# ================================================================ unions and packing

@query("""
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment, NULL AS s_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
UNION ALL SELECT NULL, 'left out: parts', NULL, 'key is string, elsewhere bigint', NULL""")
def concat_by_name(spark, sf):
    buyers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        "c_mktsegment")
    sellers = table(spark, sf, "supplier").select(
        "s_acctbal", F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("key"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"))
    rows, left_out = gate.concat_by_name({"buyers": buyers, "parts": parts, "sellers": sellers})
    listed = spark.createDataFrame([(f"left out: {n}", why) for n, why in left_out], "name string, c_mktsegment string")
    return rows.unionByName(listed, allowMissingColumns=True)


@query(drifted("SELECT file_name, NOT (n % 5 = 0 OR n % 7 = 3) AS accepted FROM files"))
def schema_gate(spark, sf):
    return gate.schema_gate(drifted_footers(spark, sf).drop("ordinal"))


@query("""
SELECT row_number() OVER (ORDER BY nation, origin, key) - 1 AS _fid, nation, origin, key FROM (
    SELECT c_nationkey AS nation, 'customer' AS origin, c_custkey AS key FROM customer
    UNION ALL SELECT s_nationkey, 'supplier', s_suppkey FROM supplier)""")
def combine_tables(spark, sf):
    tables = [table(spark, sf, t).select(F.col(f"{t[0]}_nationkey").alias("nation"), F.lit(t).alias("origin"),
                                         F.col(key).alias("key")) for t, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"))]
    return ordering.with_global_index(gate.concat_by_name(tables)[0], ["nation", "origin", "key"])


_RANKED = """
, ranked AS (SELECT path, size_bytes, row_number() OVER (ORDER BY path) AS i FROM manifest)
"""


@query("WITH RECURSIVE" + with_clause("manifest").removeprefix("WITH") + _RANKED + f"""
, walk AS (
    SELECT i, path, size_bytes AS held, CAST(0 AS BIGINT) AS chunk_id FROM ranked WHERE i = 1
    UNION ALL
    SELECT r.i, r.path, CASE WHEN w.held >= {LIMIT} THEN r.size_bytes ELSE w.held + r.size_bytes END,
           w.chunk_id + CASE WHEN w.held >= {LIMIT} THEN 1 ELSE 0 END
    FROM walk w JOIN ranked r ON r.i = w.i + 1)
SELECT path, chunk_id FROM walk""")
def pack_at_least(spark, sf):
    return packing.pack_at_least(view(spark, sf, "manifest"), LIMIT).select("path", "chunk_id")


@query("WITH RECURSIVE" + with_clause("manifest").removeprefix("WITH") + _RANKED + f"""
, walk AS (
    SELECT i, path, size_bytes AS held, CAST(0 AS BIGINT) AS chunk_id FROM ranked WHERE i = 1
    UNION ALL
    SELECT r.i, r.path, CASE WHEN w.held + r.size_bytes > {LIMIT} THEN r.size_bytes ELSE w.held + r.size_bytes END,
           w.chunk_id + CASE WHEN w.held + r.size_bytes > {LIMIT} THEN 1 ELSE 0 END
    FROM walk w JOIN ranked r ON r.i = w.i + 1)
SELECT path, chunk_id FROM walk""")
def pack_at_most(spark, sf):
    return packing.pack_at_most(view(spark, sf, "manifest"), LIMIT).select("path", "chunk_id")


@query(with_clause("manifest") + f"""
SELECT CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
       CAST(ceil(sum(size_bytes) / {LIMIT}.0) AS BIGINT) AS n_chunks FROM manifest""")
def pack_count(spark, sf):
    return packing.pack_count(view(spark, sf, "manifest"), LIMIT)


@query("SELECT o_orderkey // 1000 + 1 AS chunk_id, count(*) AS n_rows FROM orders GROUP BY 1")
def row_chunks(spark, sf):
    chunk = packing.row_chunk(F.col("_fid"), 1000).alias("chunk_id")
    return layer_features(spark, sf).groupBy(chunk).agg(F.count("*").alias("n_rows"))


@query("SELECT o_orderkey AS _fid, o_orderkey // 1000 + 1 AS chunk_id FROM orders")
def compact_chunk(spark, sf):
    path = scratch_path(spark, "compacted")
    chunked = layer_features(spark, sf).withColumn("chunk_id", packing.row_chunk(F.col("_fid"), 1000))
    packing.compact_chunks(chunked).write.partitionBy("chunk_id").parquet(path)
    return spark.read.parquet(path).select("_fid", F.col("chunk_id").cast("bigint").alias("chunk_id"))


#: Rows of a partition that is counted whole.
PARTITION_ROWS = 200_000


@query("""
SELECT l_orderkey, l_linenumber, CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS BIGINT) AS place,
       count(*) OVER (PARTITION BY l_suppkey) AS of_all FROM lineitem""")
def partition_map(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    keys = ["l_suppkey", "l_extendedprice"]

    def counted(_, frame):
        return frame.groupby(keys, dropna=False).size().reset_index(name="n")
    # Partitions of a bounded number of rows, whatever their suppliers; Spark adds up what they have counted.
    parts = rows.select(*keys).repartition(rows.count() // PARTITION_ROWS + 1)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    counts = gate.map_partitions(parts, counted, f"{types}, n long").groupBy(*keys).agg(F.sum("n").alias("n"))
    dearer = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice")).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("place", F.coalesce(F.sum("n").over(dearer), F.lit(0)) + 1)
    of_all = counts.groupBy("l_suppkey").agg(F.sum("n").alias("of_all"))
    placed = placed.join(of_all.withColumnRenamed("l_suppkey", "_of"), F.col("l_suppkey").eqNullSafe(F.col("_of"))).select(
        F.col("l_suppkey").alias("_supplier"), F.col("l_extendedprice").alias("_price"), "place", "of_all")
    same = F.col("l_suppkey").eqNullSafe(F.col("_supplier")) & F.col("l_extendedprice").eqNullSafe(F.col("_price"))
    return rows.join(placed, same).select("l_orderkey", "l_linenumber", "place", "of_all")


#: Rows of a streamed partition, on average.
STREAM_ROWS = 10_000


def _running_lines(part, frames):
    """Lines of each order and of all orders so far in a partition that is sorted by order; one order stays open."""
    order, lines, total = None, 0, 0
    for frame in frames:
        counts = frame.groupby("l_orderkey", sort=False).size()
        keys, n = counts.index.to_numpy(), counts.to_numpy().copy()
        if order is not None and len(keys):
            if keys[0] == order:
                n[0] += lines
            else:
                keys, n = np.r_[order, keys], np.r_[lines, n]
        if len(keys):
            order, lines = keys[-1], n[-1]
            so_far = total + np.cumsum(n)
            yield pd.DataFrame({"part": part, "l_orderkey": keys[:-1], "n_lines": n[:-1], "running_lines": so_far[:-1]})
            total = so_far[-1] - lines
    if order is not None:
        yield pd.DataFrame({"part": [part], "l_orderkey": [order], "n_lines": [lines], "running_lines": [total + lines]})


@query(f"""
WITH orders_in AS (SELECT l_orderkey % (SELECT count(*) // {STREAM_ROWS} + 1 FROM lineitem) AS part, l_orderkey, count(*) AS n_lines
                   FROM lineitem GROUP BY l_orderkey)
SELECT CAST(part AS INTEGER) AS part, l_orderkey, n_lines,
       CAST(sum(n_lines) OVER (PARTITION BY part ORDER BY l_orderkey) AS BIGINT) AS running_lines FROM orders_in""")
def partition_stream(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey")
    parts = rows.count() // STREAM_ROWS + 1  # as many as the rows ask for
    dealt = rows.repartitionById(parts, (F.col("l_orderkey") % parts).cast("int")).sortWithinPartitions("l_orderkey")
    return gate.stream_partitions(dealt, _running_lines, "part int, l_orderkey long, n_lines long, running_lines long")


_BAD = "_fid % 11 = 5 AND CAST(substr(_source_file, 3, 4) AS INT) % 3 = 0"


@query(with_clause("feat") + f"""
SELECT _source_file, count(*) AS n_rows, NULL AS reason FROM feat
WHERE _source_file NOT IN (SELECT _source_file FROM feat WHERE {_BAD}) GROUP BY _source_file
UNION ALL SELECT DISTINCT _source_file, CAST(NULL AS BIGINT), 'invalid_geometry' FROM feat WHERE {_BAD}""")
def isolate_failures(spark, sf):
    text = F.when(F.expr(_BAD), F.lit("POINT (broken")).otherwise(F.col("wkt"))
    read = view(spark, sf, "feat").select("_source_file", "_fid", text.alias("wkt"))
    read = read.withColumn("geometry", geo.wkt_to_geom("wkt"))
    error = F.when(F.col("wkt").isNotNull() & F.col("geometry").isNull(), F.lit("invalid_geometry"))
    good, failed = gate.isolate_failures(read.withColumn("_error", error))
    listed = failed.select(F.col("file_name").alias("_source_file"), "reason")
    return good.groupBy("_source_file").agg(F.count("*").alias("n_rows")).unionByName(listed, allowMissingColumns=True)


# ================================================================ samples and reconciliation

def _drawn(column: str) -> str:
    return f"md5(concat(CAST({column} AS VARCHAR), '{SEED}'))"


@query(with_clause("feat") + f"""
SELECT _source_file FROM (SELECT DISTINCT _source_file FROM feat)
ORDER BY {_drawn('_source_file')}, _source_file LIMIT 3""")
def sample_files(spark, sf):
    names = view(spark, sf, "feat").select("_source_file").distinct()
    return sampling.sample_files(names, "_source_file", 3, SEED)


@query(with_clause("feat") + f"""
SELECT _source_file, _fid FROM feat
QUALIFY row_number() OVER (PARTITION BY _source_file ORDER BY {_drawn('_fid')}, _fid) <= 5""")
def sample_rows_per_file(spark, sf):
    return sampling.sample_rows_per_file(
        view(spark, sf, "feat").select("_source_file", "_fid"), "_source_file", n=5, seed=SEED)


_SAMPLED = f"""
, chosen AS (SELECT _source_file FROM (SELECT DISTINCT _source_file FROM feat)
             ORDER BY {_drawn('_source_file')}, _source_file LIMIT 3),
  checks AS (SELECT _source_file, arg_min(gui, _fid) AS gui, count(DISTINCT gui) = 1 AS single_control
             FROM feat GROUP BY _source_file),
  probes AS (SELECT f._source_file, _fid, c.gui, single_control, wkt FROM feat f JOIN checks c USING (_source_file)
             WHERE _source_file IN (SELECT _source_file FROM chosen) AND _source_file NOT IN ({_FAILED})
             QUALIFY row_number() OVER (PARTITION BY f._source_file ORDER BY {_drawn('_fid')}, _fid) <= 5)
SELECT _source_file, _fid, gui, single_control,
       CASE WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = p.wkt AND c.gui = p.gui) THEN 'match'
            WHEN EXISTS (SELECT 1 FROM feat_copy c WHERE c.wkt = p.wkt) THEN 'control_mismatch'
            ELSE 'not_contained' END AS status FROM probes p"""


@query(with_clause("feat", "feat_copy") + _SAMPLED)
def reconcile_sampled_query(spark, sf):
    return reconcile_sampled(feat(spark, sf), feat_copy(spark, sf), failed_list(spark), "gui", seed=SEED)


@query(with_clause("feat", "feat_copy") + """
, r AS (SELECT DISTINCT wkt FROM feat_copy),
  l AS (SELECT _fid // 500 + 1 AS chunk_id, wkt, count(*) AS n FROM feat GROUP BY 1, 2)
SELECT chunk_id, CAST(sum(n) AS BIGINT) AS n_features,
       CAST(coalesce(sum(CASE WHEN r.wkt IS NOT NULL THEN n END), 0) AS BIGINT) AS matched,
       CAST(coalesce(sum(CASE WHEN r.wkt IS NULL AND l.wkt IS NOT NULL THEN n END), 0) AS BIGINT) AS unmatched_source,
       (SELECT count(*) FROM r) - count(r.wkt) AS unmatched_dataset, count(l.wkt) AS unique_source
FROM l LEFT JOIN r ON l.wkt = r.wkt GROUP BY chunk_id""")
def reconcile_chunks_query(spark, sf):
    return reconcile_chunks(feat(spark, sf), feat_copy(spark, sf), ["_fid"], chunk_rows=500)


@query(drifted(_REPORT))
def quarantine_report(spark, sf):
    return drift_report(spark, sf)


@query(drifted("""
SELECT column_name, count(DISTINCT file_name) AS n_files FROM cols GROUP BY column_name
HAVING count(DISTINCT file_name) = (SELECT count(*) FROM files)"""))
def common_columns(spark, sf):
    return gate.common_columns(drifted_footers(spark, sf))


# ================================================================ jobs

@query(with_clause("feat") + f"""
, names AS (SELECT DISTINCT _source_file FROM feat UNION ALL VALUES ('IT_cut.shp'), ('IT_drift.shp')),
reasons(name, reason) AS (VALUES ('IT_cut.shp', 'not_a_shapefile'), ('IT_drift.shp', 'schema_mismatch'))
SELECT 'row' AS part, _source_file AS name, NULL AS reason, gui, coalesce(hab_type, 'None') AS hab_type,
       CAST(sum_conf AS DOUBLE) AS sum_conf, round(CAST(CAST(comp AS FLOAT) AS DOUBLE), 4) AS comp, {HEX} AS wkb
FROM feat WHERE wkt IS NOT NULL
UNION ALL SELECT CASE WHEN reason IS NULL THEN 'succeeded' ELSE 'failed' END, _source_file, reason, NULL, NULL, NULL, NULL, NULL
FROM names LEFT JOIN reasons ON _source_file = name
UNION ALL SELECT 'quarantine', name, reason, c, NULL, NULL, NULL, NULL FROM reasons LEFT JOIN
    (VALUES ('IT_drift.shp', 'gui'), ('IT_drift.shp', 'sum_conf')) q(n, c) ON name = n""")
def feature_lakehouse_job(spark, sf):
    job = FeatureLakehouse(spark, LakehouseConfig(
        sample_files_of(spark, sf, "in put 100%", broken=True), scratch_path(spark, "lake house 100%"), file_name_selectors=["IT", "GB"],
        columns_to_convert=["gui", "hab_type", "sum_conf", "comp"], chunk_bytes=100_000))
    report = job.run()
    rows = job.result().select(
        F.lit("row").alias("part"), F.col("_source_file").alias("name"), F.lit(None).cast("string").alias("reason"), "gui",
        "hab_type", F.col("sum_conf").cast("double").alias("sum_conf"), F.round(F.col("comp").cast("double"), 4).alias("comp"),
        F.hex("geometry").alias("wkb"))
    report = report.select(F.col("status").alias("part"), F.col("file_name").alias("name"), "reason")
    listed = job.failed_files().select(F.lit("quarantine").alias("part"), F.col("file_name").alias("name"), "reason",
                                       F.col("column_name").alias("gui"))
    return rows.unionByName(report, allowMissingColumns=True).unionByName(listed, allowMissingColumns=True)


@query("""
SELECT o_orderkey AS _fid, o_custkey, o_orderstatus, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS o_orderstatus_code
FROM orders""")
def layer_export_job(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    done = export_layer(orders, "orders", scratch_path(spark, "layer"), "orders_2023", fid="o_orderkey",
                        chunk_rows=1000, dictionary=["o_orderstatus"])
    return datasets.parquet_scan(spark, done.combined, columns=["_fid", "o_custkey", "o_orderstatus", "o_orderstatus_code"])


@query("""
WITH top AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5),
third AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem
          WHERE l_suppkey = (SELECT l_suppkey FROM top ORDER BY n DESC, l_suppkey LIMIT 1 OFFSET 2))
SELECT 'coordinates' AS part, NULL AS name, l_suppkey, l_orderkey, l_partkey AS value FROM third
UNION ALL SELECT 'sample', NULL, l_suppkey, l_orderkey, l_partkey FROM (SELECT * FROM third ORDER BY l_orderkey, l_linenumber LIMIT 5)
UNION ALL SELECT 'top', NULL, l_suppkey, NULL, n FROM top
UNION ALL SELECT 'schema', column_name, NULL, NULL, ordinal_position - 1 FROM information_schema.columns
WHERE table_name = 'lineitem'""")
def occurrence_profile_query(spark, sf):
    found = occurrence_profile(table(spark, sf, "lineitem"), "l_suppkey", ["l_suppkey", "l_orderkey", "l_partkey"],
                               ["l_orderkey", "l_linenumber"])
    parts = [
        found.coordinates.select(F.lit("coordinates").alias("part"), F.lit(None).cast("string").alias("name"), "l_suppkey",
                                 "l_orderkey", F.col("l_partkey").alias("value")),
        found.sample.select(F.lit("sample"), F.lit(None).cast("string"), "l_suppkey", "l_orderkey", "l_partkey"),
        found.top.select(F.lit("top"), F.lit(None).cast("string"), "l_suppkey", F.lit(None).cast("bigint"), "n_rows"),
        found.schema.select(F.lit("schema"), "column_name", F.lit(None).cast("bigint"), F.lit(None).cast("bigint"),
                            F.col("ordinal").cast("bigint"))]
    return reduce(DataFrame.unionAll, parts)
