import json
import os
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThanOrEqual

from samples.shapefiles import export_features, write_shapefile
from strandline.functions import codec
from strandline.functions import geometry as geo
from strandline.functions import crs, curve
from strandline.operators import packing
from strandline.plans.lakehouse import FeatureLakehouse, LakehouseConfig
from strandline.plans.layer_export import export_layer
from strandline.plans.reconcile import lookup_status, reconcile_chunks, reconcile_sampled
from strandline.sources import datasets, files, geoparquet, shapefile, shapereader

POINTS = ["POINT (1 2)", "POINT (3 4.5)", None, "POINT (-7 8)"]


def attributes(n, gui="G1", **more):
    return {"GUI": ("C", 8, 0, [gui] * n), "Sum_Conf": ("N", 5, 0, list(range(n))), **more}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- files

def test_listing_and_selection(spark, tmp_path):
    for name, size in (("a_IT.shp", 3), ("IT_b.shp", 5), ("c.SHP", 7), ("d.shx", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "e.shp").write_bytes(b"x")
    listed = files.list_files(spark, str(tmp_path))
    assert rows(listed.select("file_name", "size_bytes")) == [("IT_b.shp", 5), ("a_IT.shp", 3)]
    assert files.file_select_contains(listed, ["IT"]).count() == 2
    assert files.file_select_prefix(listed, ["IT"]).count() == 1
    assert packing.size_total(listed).first().total_bytes == 8


@pytest.mark.parametrize("url,path", [
    ("https://host.example/bucket/a/b.parquet", "s3a://bucket/a/b.parquet"), ("s3://bucket/k", "s3a://bucket/k"),
    ("/data/x.parquet", "/data/x.parquet"), ("hdfs://n/x", "hdfs://n/x")])
def test_object_store_paths(url, path):
    found, options = datasets.object_store_options(url)
    assert found == path
    if url.startswith("https"):
        assert options["fs.s3a.bucket.bucket.endpoint"] == "https://host.example"
        assert options["fs.s3a.bucket.bucket.aws.credentials.provider"].endswith("AnonymousAWSCredentialsProvider")


# ---------------------------------------------------------------- shapefiles

def ingest(spark, folder, **kwargs):
    return shapefile.shapefile_ingest(files.list_files(spark, str(folder)), **kwargs)


def test_points_with_attributes(spark, tmp_path):
    import datetime as dt
    write_shapefile(f"{tmp_path}/a.shp", POINTS, attributes(
        4, WIDE=("N", 12, 0, [1, None, 3, 4]), RATE=("N", 10, 3, [0.5, 1.25, None, 2.0]), BIG=("N", 20, 0, [1, 2, 3, 4]),
        DAY=("D", 8, 0, ["20240102", "", "99999999", "20231231"]), FLAG=("L", 1, 0, ["T", "n", "?", "Y"])))
    df = ingest(spark, tmp_path)
    assert dict(df.dtypes) | {} == {
        "_source_file": "string", "_fid": "bigint", "gui": "string", "sum_conf": "int", "wide": "bigint",
        "rate": "double", "big": "double", "day": "date", "flag": "boolean", "geometry": "binary",
        "bbox": "struct<xmin:double,ymin:double,xmax:double,ymax:double>", "_error": "string"}
    found = df.withColumn("wkt", geo.geom_to_wkt("geometry")).orderBy("_fid").collect()
    assert [r.wkt for r in found] == POINTS and [r.wide for r in found] == [1, None, 3, 4]
    assert [r.rate for r in found] == [0.5, 1.25, None, 2.0] and [r.flag for r in found] == [True, False, None, True]
    assert [r.day for r in found] == [dt.date(2024, 1, 2), None, None, dt.date(2023, 12, 31)]
    assert found[0].bbox.xmin == 1 and {r._error for r in found} == {None}


SHAPES = [
    "POLYGON ((0 0, 0 10, 10 10, 10 0, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))",
    "MULTIPOLYGON (((0 0, 0 10, 10 10, 10 0, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4)), ((20 0, 20 5, 25 5, 20 0)))",
    "MULTIPOLYGON (((0 0, 0 10, 10 10, 10 0, 0 0), (2 2, 8 2, 8 8, 2 8, 2 2)), ((4 4, 4 6, 6 6, 6 4, 4 4)))",
    "POLYGON ((30 30, 30 31, 31 31, 30 30))"]


@pytest.mark.parametrize("wkts", [SHAPES, ["LINESTRING (0 0, 1 1, 2 0)", "MULTILINESTRING ((0 0, 1 1), (5 5, 6 6, 7 7))"],
                                  ["MULTIPOINT (1 2, 3 4)", "MULTIPOINT (9 9)"]], ids=["areas", "lines", "points"])
def test_shape_types(spark, tmp_path, wkts):
    write_shapefile(f"{tmp_path}/a.shp", wkts, attributes(len(wkts)))
    found = ingest(spark, tmp_path).withColumn("wkt", geo.geom_to_wkt("geometry")).orderBy("_fid").collect()
    assert [r.wkt for r in found] == wkts


def test_ranges_cover_a_file_once(spark, tmp_path, monkeypatch):
    n = 1000
    wkts = [f"POINT ({i} {i / 2})" if i % 50 else None for i in range(n)]
    write_shapefile(f"{tmp_path}/a.shp", wkts, attributes(n))
    headers = shapefile.read_headers(files.list_files(spark, str(tmp_path)))
    ranges = shapefile.record_ranges(headers, range_bytes=1500)
    assert ranges.count() > 10
    found = ingest(spark, tmp_path, range_bytes=1500).select("_fid", "sum_conf", geo.geom_to_wkt("geometry").alias("w"))
    expected = [(i, i, None if w is None else codec.encode_wkt(codec.decode_wkt(w))) for i, w in enumerate(wkts)]
    assert sorted(map(tuple, found.collect())) == expected


def test_mercator_sources_are_reprojected(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", ["POINT (111319.49079327358 0)"], attributes(1), srid=3857)
    write_shapefile(f"{tmp_path}/b.shp", ["MULTIPOINT (111319.49079327358 0, 0 0)"], attributes(1), srid=3857)
    found = ingest(spark, tmp_path).select("bbox.xmax", "bbox.ymax").collect()
    assert all(abs(r.xmax - 1) < 1e-9 and abs(r.ymax) < 1e-9 for r in found) and len(found) == 2


def test_deleted_records_and_code_pages(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, {"NAME": ("C", 8, 0, ["é", "b", "c", "d"])})
    (tmp_path / "a.cpg").write_text("ISO-8859-1")
    raw = bytearray((tmp_path / "a.dbf").read_bytes())
    raw[32 + 32 + 1 + 9] = ord("*")
    (tmp_path / "a.dbf").write_bytes(raw)
    assert rows(ingest(spark, tmp_path).select("_fid", "name")) == [(0, "é"), (2, "c"), (3, "d")]


def spoil(path, keep=None, at=None, value=b""):
    data = Path(path).read_bytes()
    if keep is not None:
        data = data[:keep]
    if at is not None:
        data = data[:at] + value + data[at + len(value):]
    Path(path).write_bytes(data)


def broken_folder(folder):
    for name in ("cut", "nodbf", "noprj", "odd", "text", "short", "badshape", "counts"):
        write_shapefile(f"{folder}/{name}.shp", POINTS, attributes(4), srid={"noprj": None, "odd": 2154}.get(name, 4326))
    spoil(f"{folder}/cut.shp", keep=150)
    os.remove(f"{folder}/nodbf.dbf")
    Path(f"{folder}/text.shp").write_text("hello")
    spoil(f"{folder}/short.dbf", keep=60)
    spoil(f"{folder}/badshape.shp", at=108, value=(77).to_bytes(4, "little"))
    spoil(f"{folder}/counts.shx", keep=116)
    return {"cut.shp": "truncated_shp", "nodbf.shp": "missing_dbf", "noprj.shp": "no_crs", "odd.shp": "unsupported_crs",
            "text.shp": "not_a_shapefile", "short.shp": "truncated_dbf", "badshape.shp": "unknown_shape_type",
            "counts.shp": "record_counts_differ"}


def test_bad_files_become_rows(spark, tmp_path):
    expected = broken_folder(tmp_path)
    write_shapefile(f"{tmp_path}/good.shp", POINTS, attributes(4))
    df = ingest(spark, tmp_path)
    assert dict(rows(df.where("_error is not null").select("_source_file", "_error"))) == expected
    assert df.where("_error is null").select("_source_file").distinct().first()[0] == "good.shp"


# ---------------------------------------------------------------- GeoParquet

def parts(spark, n=300):
    df = spark.range(n).select(F.col("id").alias("_fid"), geo.wkt_to_geom(
        F.concat(F.lit("POINT ("), F.col("id").cast("string"), F.lit(" 1)"))).alias("geometry"))
    return df.withColumn("bbox", geo.geom_bbox("geometry"))


def test_geoparquet_footers_and_modes(spark, tmp_path):
    path = str(tmp_path / "geo")
    df = parts(spark)
    geoparquet.geoparquet_write(df.repartition(3), path)
    names = sorted(os.listdir(path))
    assert len(names) == 3 and all(n.startswith("part-") for n in names)
    geo_json = json.loads(pq.read_metadata(f"{path}/{names[0]}").metadata[b"geo"])
    column = geo_json["columns"]["geometry"]
    assert geo_json["version"] == "1.1.0" and geo_json["primary_column"] == "geometry"
    assert column["encoding"] == "WKB" and column["geometry_types"] == ["Point"] and len(column["bbox"]) == 4
    assert column["crs"]["id"] == {"authority": "EPSG", "code": 4326}
    assert column["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
    scanned = geoparquet.geoparquet_scan(spark, path)
    assert geo.crs_of(scanned) == 4326 and rows(scanned.select("_fid", "geometry")) == rows(df.select("_fid", "geometry"))
    geoparquet.geoparquet_write(df.limit(10), path, mode="append")
    assert geoparquet.geoparquet_scan(spark, path).count() == 310
    geoparquet.geoparquet_write(df.limit(5), path, srid=3857)
    again = geoparquet.geoparquet_scan(spark, path)
    assert again.count() == 5 and geo.crs_of(again) == 3857


def test_files_roll_at_their_size_and_empty_partitions_write_nothing(spark, tmp_path):
    geoparquet.geoparquet_write(parts(spark, 30_000).coalesce(1), str(tmp_path / "r"), max_file_bytes=500_000)
    assert len(os.listdir(tmp_path / "r")) > 1
    geoparquet.geoparquet_write(parts(spark, 4).repartitionByRange(8, "_fid").where("_fid < 2"), str(tmp_path / "e"))
    assert 1 <= len(os.listdir(tmp_path / "e")) <= 2
    assert geoparquet.geoparquet_scan(spark, str(tmp_path / "r")).count() == 30_000


def test_a_failed_write_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "f")
    geoparquet.geoparquet_write(parts(spark, 5).coalesce(1), path)
    before = os.listdir(path)
    bad = parts(spark, 1000).repartition(4).withColumn("_fid", F.when(F.col("_fid") == 999, F.raise_error(F.lit("no")))
                                                       .otherwise(F.col("_fid")))
    with pytest.raises(Exception):
        geoparquet.geoparquet_write(bad, path)
    assert [n for n in os.listdir(path) if not n.startswith("_")] == before
    assert geoparquet.geoparquet_scan(spark, path).count() == 5


def test_consolidation_keeps_neighbours_together(spark, tmp_path):
    geoparquet.geoparquet_write(parts(spark, 5000).repartition(6), str(tmp_path / "p"))
    n = geoparquet.consolidate(spark, str(tmp_path / "p"), str(tmp_path / "c"), file_bytes=40_000)
    assert n > 2 and geoparquet.geoparquet_scan(spark, str(tmp_path / "c")).count() == 5000
    boxes = sorted(json.loads(r.geo)["columns"]["geometry"]["bbox"]
                   for r in geoparquet.geo_footers(spark, str(tmp_path / "c")).collect())
    assert all(a[2] <= b[0] for a, b in zip(boxes, boxes[1:]))


def test_places_on_the_curve_are_neighbours(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.expr("id div 8").alias("y"))
    found = cells.select("x", "y", curve.curve_place(F.col("x"), F.col("y"), 3).alias("place")).orderBy("place").collect()
    assert [r.place for r in found] == list(range(64))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(found, found[1:]))
    assert (found[0].x, found[0].y, found[-1].x, found[-1].y) == (0, 0, 7, 0)


def test_keys_of_odd_boxes(spark):
    inf, nan, most = float("inf"), float("nan"), (1 << 2 * curve.LEVELS) - 1
    boxes = [None, (-180.0, -90.0, -180.0, -90.0), (180.0, -90.0, 180.0, -90.0), (999.0, -999.0, 999.0, -999.0), (-inf, -inf, inf, inf), (nan,) * 4]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(boxes)], T.StructType([T.StructField("i", T.LongType()), T.StructField("b", geo.BBOX_TYPE)]))
    keys = [r.key for r in df.select("i", curve.curve_key(F.col("b"), (-180, -90, 180, 90)).alias("key")).orderBy("i").collect()]
    assert keys[:4] == [None, 0, most, most] and all(0 <= k <= most for k in keys[4:])


def test_a_small_window_over_a_full_place_meets_few_files(spark, tmp_path):
    spots = spark.range(20_000).select(F.col("id").alias("_fid"), geo.wkt_to_geom(F.format_string(
        "POINT (%.6f %.6f)", F.lit(5.0) + F.rand(1), F.lit(5.0) + F.rand(2))).alias("geometry"))
    geoparquet.geoparquet_write(spots.repartition(6), str(tmp_path / "p"))
    whole = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "400")  # files roll between batches
    try:
        n = geoparquet.consolidate(spark, str(tmp_path / "p"), str(tmp_path / "c"), file_bytes=10_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", whole)
    index = geoparquet.box_index(spark, str(tmp_path / "c")).cache()
    near = index.where(geoparquet.meets(F.col("bbox"), (5.4, 5.4, 5.5, 5.5)))
    assert n > 20 and index.count() > 15 and near.count() <= index.count() // 4
    assert geoparquet.geoparquet_scan(spark, str(tmp_path / "c")).count() == 20_000


def test_a_window_opens_only_files_that_meet_it(spark, tmp_path):
    target = str(tmp_path / "c")
    tiles = parts(spark, 5000).repartitionById(10, F.expr("cast(_fid div 500 as int)"))
    geoparquet.geoparquet_write(tiles.sortWithinPartitions("_fid"), target)
    whole = geoparquet.geoparquet_scan(spark, target)
    near = geoparquet.geoparquet_scan(spark, target, window=(1200.5, 0, 1300, 5))
    assert sorted(r._fid for r in near.collect()) == list(range(1201, 1301)) and geo.crs_of(near) == 4326
    read, there = (sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles()) for df in (near, whole))
    assert len(whole.inputFiles()) == 10 and len(near.inputFiles()) == 1 and read < there / 5
    assert "PushedFilters: [IsNotNull(bbox.xmin)" in near._jdf.queryExecution().toString()  # reaches the row groups
    edge = geoparquet.geoparquet_scan(spark, target, window=(499, 1, 500, 1))
    assert sorted(r._fid for r in edge.collect()) == [499, 500] and len(edge.inputFiles()) == 2
    none = geoparquet.geoparquet_scan(spark, target, window=(0, 2, 9, 3))
    assert none.count() == 0 and none.columns == whole.columns
    bare = str(tmp_path / "bare dir%")
    geoparquet.geoparquet_write(parts(spark, 100).drop("bbox").unionByName(spark.createDataFrame(
        [(100, None)], "_fid long, geometry binary")).repartition(2), bare)
    assert sorted(r._fid for r in geoparquet.geoparquet_scan(spark, bare, window=(5, 0, 7, 9)).collect()) == [5, 6, 7]
    plain = str(tmp_path / "plain")
    parts(spark, 30).write.parquet(plain)  # no footers: every file is opened
    assert geoparquet.geoparquet_scan(spark, plain, window=(5, 0, 7, 9)).count() == 3


# ---------------------------------------------------------------- other datasets

def test_append_by_source_keeps_odd_names(spark, tmp_path):
    df = spark.createDataFrame([("0001.shp", 1), ("a+b c%.shp", 2), ("x=y.shp", 3)], "_source_file string, _fid long")
    datasets.append_by_source(df, str(tmp_path / "d"))
    datasets.append_by_source(df, str(tmp_path / "d"))
    back = datasets.read_by_source(spark, str(tmp_path / "d"))
    assert back.count() == 6
    assert {r.source_stem for r in back.collect()} == {"0001", "a+b c%", "x=y"}


def test_a_source_put_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "d")

    def put(items, **kwargs):
        datasets.put_sources(spark.createDataFrame(items, "_source_file string, _fid long"), path, **kwargs)

    def held():
        return rows(datasets.read_sources(spark, path).select("source_stem", "_fid"))
    put([("0001.shp", 1), ("0001.shp", 2), ("b c%.shp", 3)])
    assert held() == [("0001", 1), ("0001", 2), ("b c%", 3)]
    put([("0001.shp", 1), ("0001.shp", 2), ("b c%.shp", 3)])
    assert held() == [("0001", 1), ("0001", 2), ("b c%", 3)]  # the same run twice
    put([("0001.shp", 9), ("x=y.shp", 4)])
    assert held() == [("0001", 9), ("b c%", 3), ("x=y", 4)]
    assert rows(datasets.source_versions(spark, path).select("source_stem", "number")) == [("0001", 3), ("b c%", 2), ("x=y", 3)]
    put([])
    assert len(held()) == 3


def test_a_put_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    one, two = (spark.createDataFrame([("a.shp", i)], "_source_file string, _fid long") for i in (1, 2))
    datasets.put_sources(one, path)
    broken = two.withColumn("_fid", F.when(F.col("_fid") == 2, F.raise_error(F.lit("no"))).cast("long"))
    with pytest.raises(Exception, match="no"):
        datasets.put_sources(broken, path)
    with monkeypatch.context() as patched:  # all written, not committed
        patched.setattr(datasets, "write_through", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            datasets.put_sources(two, path)
    assert [r._fid for r in datasets.read_sources(spark, path, one.schema).collect()] == [1]
    datasets.put_sources(two, path)
    assert [r._fid for r in datasets.read_sources(spark, path).collect()] == [2]
    with pytest.raises(Exception):
        datasets.put_sources(one, path, put="x"), datasets.put_sources(one, path, put="x")


def test_columns_of_all_files_are_read(spark, tmp_path):
    path = str(tmp_path / "d")
    datasets.append_by_source(spark.createDataFrame([("a.shp", 1)], "_source_file string, _fid long"), path)
    datasets.append_by_source(spark.createDataFrame([("b.shp", 2, "x")], "_source_file string, _fid long, more string"), path)
    assert rows(datasets.read_by_source(spark, path).select("_fid", "more")) == [(1, None), (2, "x")]
    datasets.append_by_source(spark.createDataFrame([("c.shp", "3")], "_source_file string, _fid string"), path)
    with pytest.raises(TypeError):
        datasets.read_by_source(spark, path)


def test_only_absent_paths_count_as_empty(spark, tmp_path):
    assert datasets.read_quarantine_csv(spark, str(tmp_path / "none")).count() == 0
    assert not datasets.combine_chunks(spark, str(tmp_path / "none"), "x", str(tmp_path / "t"))
    (tmp_path / "c" / "_layer=x").mkdir(parents=True)
    with pytest.raises(AnalysisException):
        datasets.combine_chunks(spark, str(tmp_path / "c"), "x", str(tmp_path / "t"))


PRJ_NAD27 = ('GEOGCS["NAD27",DATUM["North_American_Datum_1927",SPHEROID["Clarke 1866",6378206.4,294.9786982138982],'
             'TOWGS84[-8,160,176,0,0,0,0]],PRIMEM["Greenwich",0],AUTHORITY["EPSG","4267"]]')


@pytest.mark.parametrize(("text", "srid"), [
    (PRJ_NAD27, None), (PRJ_NAD27.replace(',AUTHORITY["EPSG","4267"]', ""), None),
    ('GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563,AUTHORITY["EPSG","7030"]],'
     'AUTHORITY["EPSG","6326"]],PRIMEM["Greenwich",0],AUTHORITY["EPSG","4326"]]', 4326),
    ('GEOGCS["anything",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]]]', 4326),
    ('PROJCS["WGS 84 / UTM zone 33N",GEOGCS["WGS 84",DATUM["WGS_1984"],AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","32633"]]', None),
    ('PROJCS["WGS 84 / Pseudo-Mercator",GEOGCS["WGS 84",DATUM["WGS_1984"]],PROJECTION["Mercator_1SP"]]', 3857),
    ('PROJCS["Web_Mercator",GEOGCS["x",DATUM["y"]],AUTHORITY["EPSG","3857"]]', 3857), ("", None), ("nonsense", None)])
def test_reference_system_of_a_prj(text, srid):
    assert crs.srid_of_prj(text) == srid


def test_systems_of_all_parts_count(spark, tmp_path):
    path = str(tmp_path / "p")
    geoparquet.geoparquet_write(parts(spark, 50).coalesce(1), path, srid=3857)
    assert geo.crs_of(geoparquet.geoparquet_scan(spark, path)) == 3857
    geoparquet.consolidate(spark, path, str(tmp_path / "c"))
    assert geoparquet.dataset_crs(spark, str(tmp_path / "c")) == ("geometry", 3857)
    geoparquet.geoparquet_write(parts(spark, 50).coalesce(1), path, srid=4326, mode="append")
    with pytest.raises(ValueError, match="different systems"):
        geoparquet.geoparquet_scan(spark, path)


def test_a_table_without_rows_has_a_file(spark, tmp_path):
    geoparquet.geoparquet_write(parts(spark, 5).limit(0), str(tmp_path / "e"))
    back = geoparquet.geoparquet_scan(spark, str(tmp_path / "e"))
    assert back.count() == 0 and "geometry" in back.columns and geo.crs_of(back) == 4326


def test_files_hold_one_value_of_the_splitting_column(spark, tmp_path):
    rows_ = parts(spark, 90).withColumn("c", F.col("_fid") % 3).coalesce(1)
    geoparquet.geoparquet_write(rows_, str(tmp_path / "s"), split_by="c")
    back = geoparquet.geoparquet_scan(spark, str(tmp_path / "s"))
    assert "c" not in back.columns and back.count() == 90
    found = back.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.collect_set(F.col("_fid") % 3).alias("c")).collect()
    assert len(found) == 3 and all(len(r.c) == 1 for r in found)


def test_options_of_an_object_store_reach_the_file_system():
    path, options = files.object_store_options("https://store.example.org/bucket/a/b.parquet")
    fs, local = files.resolve(path, options)
    assert fs.type_name == "s3" and local == "bucket/a/b.parquet"
    assert files.resolve("file:///a/b")[1] == "/a/b"


def test_rejected_files_do_not_set_the_columns(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, {"OTHER": ("C", 8, 0, ["x"] * 4)}, srid=2154)
    write_shapefile(f"{tmp_path}/b.shp", POINTS, {"GUI": ("C", 8, 0, ["x"] * 4)})
    write_shapefile(f"{tmp_path}/c.shp", POINTS, {"GUI": ("C", 8, 0, ["y"] * 4), "MORE": ("C", 8, 0, ["z"] * 4)})
    write_shapefile(f"{tmp_path}/d.shp", POINTS, {"GUI": ("N", 8, 0, [1] * 4)})
    found = ingest(spark, tmp_path)
    errors = {(r._source_file, r._error) for r in found.where("_error is not null").collect()}
    assert errors == {("a.shp", "unsupported_crs"), ("d.shp", "schema_mismatch")}
    good = found.where("_error is null")
    assert {(r._source_file, r.gui, r.more) for r in good.collect()} == {("b.shp", "x", None), ("c.shp", "y", "z")}
    assert "other" not in good.columns


def test_footers_of_unreadable_files(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "ok"))
    (tmp_path / "ok" / "bad.parquet").write_bytes(b"nothing")
    found = datasets.footer_columns(datasets.parquet_sizes(spark, str(tmp_path / "ok"))).collect()
    assert sorted((r.column_name, r.data_type, r.n_rows) for r in found if r.error is None) == [("id", "int64", 5)]
    assert [r.path.endswith("bad.parquet") for r in found if r.error] == [True]


def test_layers_share_an_output(spark, tmp_path):
    a = spark.range(2500).select(F.col("id").alias("k"), F.lit("x").alias("only_a"))
    b = spark.range(2000).select((F.col("id") * 7 % 2000).alias("k"))
    out = str(tmp_path)
    first = export_layer(a, "A", out, "a_2023", fid="k", chunk_rows=1000)
    second = export_layer(b, "B", out, "b_2023", order_by=["k"], chunk_rows=1000)
    again = export_layer(b, "B", out, "b_2023", order_by=["k"], chunk_rows=1000)
    assert sorted(os.listdir(f"{out}/chunks/_layer=A")) == ["chunk_id=1", "chunk_id=2", "chunk_id=3"]
    assert sorted(os.listdir(f"{out}/chunks/_layer=B")) == ["chunk_id=1", "chunk_id=2"]
    assert spark.read.parquet(first.combined).count() == 2500
    assert spark.read.parquet(second.combined).where("k = _fid").count() == 2000 and again.combined == second.combined
    assert not datasets.combine_chunks(spark, f"{out}/chunks", "C", f"{out}/c")


def test_quarantine_csv_round_trip(spark, tmp_path):
    empty = spark.createDataFrame([], "file_name string, reason string, column_name string, data_type string")
    assert datasets.read_quarantine_csv(spark, str(tmp_path / "none")).count() == 0
    datasets.write_quarantine_csv(empty, str(tmp_path / "empty"))
    assert datasets.read_quarantine_csv(spark, str(tmp_path / "empty")).count() == 0
    one = spark.createDataFrame([("a,b.shp", 'say "x"', None, "int")], empty.schema)
    datasets.write_quarantine_csv(one, str(tmp_path / "one"))
    assert rows(datasets.read_quarantine_csv(spark, str(tmp_path / "one"))) == rows(one)


# ---------------------------------------------------------------- the job and its checks

def build_input(folder):
    for i in range(6):
        country, gui = ("IT", "GB", "FR")[i % 3], f"GUI{i}"
        wkts = [f"POINT ({10 * i + j} {j})" if j != 3 else None for j in range(12)]
        write_shapefile(f"{folder}/{country}{i}.shp", wkts, attributes(12, gui, DAY=("D", 8, 0, ["20240102"] * 12)))
    write_shapefile(f"{folder}/IT_drift.shp", POINTS, {
        "GUI": ("N", 8, 0, [1] * 4), "SUM_CONF": ("N", 5, 0, [1] * 4), "DAY": ("D", 8, 0, ["20240102"] * 4)})
    write_shapefile(f"{folder}/IT_wide.shp", POINTS, attributes(4, "GUIW", DAY=("D", 8, 0, [""] * 4)) | {
        "Sum_Conf": ("N", 9, 2, [0.5] * 4)})
    write_shapefile(f"{folder}/IT_less.shp", POINTS, {"GUI": ("C", 8, 0, ["GUIL"] * 4)})


def test_a_source_of_many_features_is_one_sample_shapefile(spark, tmp_path):
    rows = [(f"S{i % 3}.shp", i, f"g{i}", None if i % 7 == 0 else "h", "o", i % 101, i / 4, None if i < 300 or i % 5 == 0 else f"POINT ({i} {i / 2})")
            for i in range(1000)]
    feat = spark.createDataFrame(rows, "_source_file string, _fid long, gui string, hab_type string, orig_hab string, sum_conf int, comp double, wkt string")
    done = export_features(feat.repartition(5), f"{tmp_path}/out", rows_per_piece=4).collect()
    assert sorted(map(tuple, done)) == [("S0.shp", 334), ("S1.shp", 333), ("S2.shp", 333)]
    assert sorted(p.name for p in (tmp_path / "out").glob("*.shp")) == ["S0.shp", "S1.shp", "S2.shp"]
    for name in ("S0", "S1", "S2"):
        of = [r for r in rows if r[0] == f"{name}.shp"]
        write_shapefile(f"{tmp_path}/whole/{name}.shp", [r[7] for r in of], {
            "FEATURE": ("N", 12, 0, [r[1] for r in of]), "GUI": ("C", 16, 0, [r[2] for r in of]), "HAB_TYPE": ("C", 16, 0, [r[3] for r in of]),
            "ORIG_HAB": ("C", 32, 0, [r[4] for r in of]), "SUM_CONF": ("N", 6, 0, [r[5] for r in of]), "COMP": ("N", 18, 4, [r[6] for r in of])})
        for suffix in (".shp", ".shx", ".dbf", ".prj"):
            assert (tmp_path / f"out/{name}{suffix}").read_bytes() == (tmp_path / f"whole/{name}{suffix}").read_bytes()


def test_lakehouse_job_and_reconciliation(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    build_input(folder)
    bad = {f"IT_{k}": v for k, v in broken_folder_in(folder).items()}
    config = tmp_path / "config.json"
    config.write_text(json.dumps({
        "download_url": "unused", "input_dir": str(folder), "output_dir": str(tmp_path / "out"),
        "log_dir": str(tmp_path / "logs"), "file_name_selectors": ["IT", "GB"],
        "columns_to_convert": ["gui", "sum_conf", "day", "NOT_THERE"], "chunk_bytes": 500, "range_bytes": 200}))
    job = FeatureLakehouse(spark, LakehouseConfig.load(spark, str(config)))
    for _ in range(2):
        report = {r.file_name: r.reason if r.status == "failed" else "ok" for r in job.run().collect()}
    good = {"IT0.shp", "IT3.shp", "GB1.shp", "GB4.shp", "IT_wide.shp"}
    assert report == {**{g: "ok" for g in good}, **bad, "IT_drift.shp": "schema_mismatch", "IT_less.shp": "schema_mismatch"}
    failed = job.failed_files()
    assert {r.file_name for r in failed.collect()} == set(report) - good
    assert ("sum_conf", "int") in [(r.column_name, r.data_type) for r in failed.where("file_name = 'IT_drift.shp'").collect()]
    out = job.result()
    assert geo.crs_of(out) == 4326 and out.count() == 4 * 11 + 3 and job.null_geometries == 4 + 1
    row = out.where("_source_file = 'GB1.shp' and _fid = 2").first()
    assert (row.gui, row.sum_conf, row.day, row.not_there) == ("GUI1", 2.0, "2024-01-02", "None")
    assert out.where("_source_file = 'IT_wide.shp'").first().sum_conf == 0.5
    assert {f.dataType for f in out.schema.fields if f.name in ("gui", "day", "not_there")} == {T.StringType()}
    packed = spark.read.parquet(job.packed_path)
    chunks = packed.select("chunk_id").distinct().count()
    assert chunks > 1 and packed.groupBy("_source_file").agg(F.count_distinct("chunk_id").alias("n")).where("n > 1").count() == 0
    assert geoparquet.geo_footers(spark, job.parts_path).count() >= chunks
    assert ("IT0.shp", "NOT_THERE".lower()) in rows(job.absent_columns()) or ("IT0.shp", "NOT_THERE") in rows(job.absent_columns())
    source = shapefile.shapefile_ingest(files.file_select_contains(job.select_files(), ["IT", "GB"])).where(
        "_error is null and geometry is not null")
    checked = reconcile_sampled(source, out, failed, "gui", n_files=9, seed=3, box="bbox")
    assert {r.status for r in checked.collect()} == {"match"} and checked.count() > 0


def test_chunks_do_not_depend_on_files_or_folder_names(spark, tmp_path):
    for i in range(25):
        write_shapefile(f"{tmp_path}/in/{i:04d}.shp", POINTS, attributes(4, f"G{i}"))
    (tmp_path / "in" / "0007.shp").write_bytes(b"")
    found = []
    for out in ("out", "with space", "100% + more"):
        job = FeatureLakehouse(spark, LakehouseConfig(str(tmp_path / "in"), str(tmp_path / out), chunk_bytes=1))
        assert job.run().where("status = 'succeeded'").count() == 24
        packed = spark.read.parquet(job.packed_path)
        found.append(rows(packed.select("_source_file", "chunk_id").distinct()))
        assert rows(job.result().groupBy("_source_file", "gui").count()) == [
            (f"{i:04d}.shp", f"G{i}", 3) for i in range(25) if i != 7]
        assert geoparquet.geo_footers(spark, job.parts_path).count() == 24
    assert found[0] == found[1] == found[2] and len(found[0]) == 24


def test_files_that_cannot_be_packed_are_listed_and_left_out(spark, tmp_path):
    write_shapefile(f"{tmp_path}/in/a.shp", POINTS, attributes(4))
    job = FeatureLakehouse(spark, LakehouseConfig(str(tmp_path / "in"), str(tmp_path / "out put %")))
    job.ingest()
    odd = Path(job.features_path) / "source_stem=z"
    odd.mkdir()
    (odd / "broken.parquet").write_bytes(b"nothing")
    spark.range(3).coalesce(1).write.mode("append").parquet(str(Path(job.features_path) / "source_stem=y"))
    assert job.pack()
    job.to_geoparquet()
    listed = [r.value for r in spark.read.text(job.unpackable_path).collect()]
    assert len(listed) == 2 and any("broken" in v for v in listed)
    assert geoparquet.geoparquet_scan(spark, job.parts_path).count() == 3


def broken_folder_in(folder):
    found = broken_folder(folder / "b")
    for path in (folder / "b").iterdir():
        path.rename(folder / f"IT_{path.name}")
    return found


def test_lakehouse_without_columns_takes_the_first_schema(spark, tmp_path):
    folder = tmp_path / "in"
    write_shapefile(f"{folder}/a.shp", POINTS, attributes(4))
    write_shapefile(f"{folder}/b.shp", POINTS, attributes(4, EXTRA=("C", 3, 0, ["x"] * 4)))
    job = FeatureLakehouse(spark, LakehouseConfig(str(folder), str(tmp_path / "out")))
    report = {r.file_name: r.status for r in job.run().collect()}
    assert report == {"a.shp": "succeeded", "b.shp": "failed"}
    assert job.result().columns == ["_source_file", "_fid", "gui", "sum_conf", "geometry", "bbox"]
    record = [["gui", "string"], ["sum_conf", "float"], ["extra", "string"]]
    job = FeatureLakehouse(spark, LakehouseConfig(str(folder), str(tmp_path / "out2"), schema_of_record=record))
    assert {r.file_name: r.status for r in job.run().collect()} == {"a.shp": "failed", "b.shp": "succeeded"}


def test_lakehouse_with_nothing_good(spark, tmp_path):
    broken_folder(tmp_path / "in")
    job = FeatureLakehouse(spark, LakehouseConfig(str(tmp_path / "in"), str(tmp_path / "out")))
    assert {r.status for r in job.run().collect()} == {"failed"}
    assert job.failed_files().select("file_name").distinct().count() == 8


def test_lookup_statuses(spark):
    def features(items):
        df = spark.createDataFrame([(i, g, w) for i, (g, w) in enumerate(items)], "_fid long, gui string, wkt string")
        return df.withColumn("geometry", geo.wkt_to_geom("wkt"))
    dataset = features([("a", "POINT (1 1)"), ("b", "POINT (1 1)"), (None, "POINT (2 2)"), ("c", SHAPES[3]),
                        ("d", "POLYGON ((0 0, 5 0, 5 5, 0 5, 0 0))"),
                        ("e", "GEOMETRYCOLLECTION (POLYGON ((50 50, 60 50, 60 60, 50 50)))")] + [("z", "POINT (1 1)")] * 20)
    probes = features([("b", "POINT (1 1)"), ("x", "POINT (1 1)"), (None, "POINT (2 2)"), ("q", "POINT (3 3)"),
                       ("q", "POINT (99 9)"), ("c", SHAPES[3]), ("q", "POINT (55 52)"), ("q", None)])

    def verdicts(**kwargs):
        return [r.status for r in lookup_status(probes, kwargs.pop("dataset", dataset), ["_fid"], "gui", **kwargs)
                .orderBy("_fid").collect()]
    expected = ["match", "control_mismatch", "match", "contained_not_exact", "not_contained", "match", "unsupported",
                "not_contained"]
    assert verdicts() == expected == verdicts(few_probes=True)
    boxed = dataset.withColumn("bbox", geo.geom_bbox("geometry"))
    assert verdicts(dataset=boxed, box="bbox", few_probes=True) == expected
    assert verdicts(dataset=boxed, box="bbox") == expected
    assert verdicts(dataset=dataset.drop("gui"))[:4] == [
        "no_control_column", "no_control_column", "no_control_column", "contained_not_exact"]


def test_lookup_of_near_copies_and_of_places_without_end(spark):
    def features(items):
        df = spark.createDataFrame([(i, g, w) for i, (g, w) in enumerate(items)], "_geom_key long, gui string, wkt string")
        return df.withColumn("geometry", geo.wkt_to_geom("wkt"))

    def square(x, y, side):
        return f"POLYGON (({x} {y}, {x + side} {y}, {x + side} {y + side}, {x} {y + side}, {x} {y}))"
    dataset = features([("a", square(0, 0, 8)), ("a", square(0, 0, 8)), ("b", square(20, 20, 8)), ("c", "LINESTRING (0 0, 4 4)"),
                        ("d", "POLYGON ((40 0, 48 0, 48 8, 44 4, 40 8, 40 0))")])
    cases = [(square(0.0004, 0.0004, 7.9995), "near_copy"), (square(-0.0004, 0, 8), "not_contained"), (square(1, 1, 2), "contained_not_exact"),
             (square(20, 20, 8), "control_mismatch"), (square(0, 0, 8), "match"), ("LINESTRING (1 1, 2 2)", "contained_not_exact"),
             ("LINESTRING (0 0, 4 4)", "contained_not_exact"), ("POINT (1e999 0)", "unsupported"), ("POINT EMPTY", "not_contained"),
             (square(43, 2, 2), "contained_not_exact"), (square(43, 4, 2), "not_contained"), ("POINT (41 1)", "contained_not_exact")]
    probes = features([("a", w) for w, _ in cases])
    want = [s if i != 6 else "control_mismatch" for i, (_, s) in enumerate(cases)]
    for few in (False, True):
        found = lookup_status(probes, dataset, ["_geom_key"], "gui", few_probes=few).orderBy("_geom_key").collect()
        assert [r.status for r in found] == want


def test_chunks_with_null_geometries(spark):
    def features(wkts):
        df = spark.createDataFrame(list(enumerate(wkts)), "_fid long, wkt string")
        return df.withColumn("geometry", geo.wkt_to_geom("wkt"))
    source = features(["POINT (1 1)", "POINT (1 1)", "POINT (2 2)", None, "POINT (9 9)", "POINT (2 2)"])
    dataset = features(["POINT (1 1)", "POINT (1 1)", None, "POINT (2 2)", "POINT (7 7)", "POINT (9 9)"])
    found = [tuple(r) for r in reconcile_chunks(source, dataset, ["_fid"], chunk_rows=4, head_rows=5)
             .orderBy("chunk_id").collect()]
    assert found == [(1, 4, 3, 0, 1, 2), (2, 2, 1, 1, 2, 2)]
    whole = [tuple(r) for r in reconcile_chunks(source, dataset, ["_fid"], chunk_rows=4)
             .orderBy("chunk_id").collect()]
    assert whole == [(1, 4, 3, 0, 2, 2), (2, 2, 2, 0, 2, 2)]


def test_random_polygons_survive_the_round_trip(spark, tmp_path):
    rng = np.random.default_rng(8)
    wkts = []
    for _ in range(40):
        turn = -np.sort(rng.uniform(0, 2 * np.pi, 11))
        ring = np.column_stack([np.cos(turn), np.sin(turn)]) * 5 + rng.uniform(-80, 80, 2)
        wkts.append(codec.encode_wkt((codec.POLYGON, "", [np.vstack([ring, ring[:1]])])))
    write_shapefile(f"{tmp_path}/a.shp", wkts, attributes(40))
    found = ingest(spark, tmp_path).withColumn("wkt", geo.geom_to_wkt("geometry")).orderBy("_fid").collect()
    assert [r.wkt for r in found] == wkts


# ---------------------------------------------------------------- shapefiles as a source

def shapes(spark, folder, **options):
    shapereader.register(spark)
    return spark.read.format("shapefile").options(**options).load(str(folder))


def test_the_source_returns_what_ingest_does(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, attributes(4))
    write_shapefile(f"{tmp_path}/b.shp", ["LINESTRING (0 0, 3 4)", None, "MULTIPOINT (1 1, 2 2)"], attributes(3, MORE=("C", 4, 0, ["x", "", "z"])))
    write_shapefile(f"{tmp_path}/c.shp", ["POINT (111319.49079327358 0)"], attributes(1), srid=3857)
    write_shapefile(f"{tmp_path}/d.shp", POINTS, attributes(4), srid=2154)
    write_shapefile(f"{tmp_path}/e.shp", [], attributes(0))
    write_shapefile(f"{tmp_path}/f.shp", POINTS, {"GUI": ("N", 8, 0, [1] * 4)})
    (tmp_path / "g.shp").write_bytes(b"x")
    expected = ingest(spark, tmp_path)
    assert {r[-1] for r in rows(expected)} == {None, "unsupported_crs", "schema_mismatch", "missing_shx"}
    for options in ({}, {"rangeBytes": "60"}, {"rangeBytes": "1"}):
        found = shapes(spark, tmp_path, mergeSchema="true", **options)
        assert found.columns == expected.columns
        assert rows(found) == rows(expected)
    assert "more" not in shapes(spark, tmp_path).columns
    assert rows(shapes(spark, f"{tmp_path}/a.shp")) == rows(expected.where("_source_file = 'a.shp'").drop("more"))
    (tmp_path / "empty").mkdir()
    assert shapes(spark, tmp_path / "empty").count() == 0


def test_a_schema_narrows_what_is_read(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, attributes(4))
    shapereader.register(spark)
    found = spark.read.format("shapefile").schema("sum_conf int, geometry binary").load(str(tmp_path))
    assert rows(found) == rows(ingest(spark, tmp_path).select("sum_conf", "geometry"))
    other = spark.read.format("shapefile").schema("_fid bigint, sum_conf string, absent int, _error string").load(str(tmp_path))
    assert rows(other) == [(None, None, None, "schema_mismatch")]


@pytest.mark.parametrize("srid", [4326, 3857])
def test_a_window_decodes_only_records_that_meet_it(spark, tmp_path, srid):
    scale = 1 if srid == 4326 else 111319.49079327358
    far = [f"POINT ({x * scale} 0)" for x in range(100)]
    lines = [f"LINESTRING ({x * scale} 0, {(x + 0.5) * scale} 0)" for x in range(100)] + [None]
    write_shapefile(f"{tmp_path}/a.shp", far, attributes(100), srid=srid)
    write_shapefile(f"{tmp_path}/b.shp", lines, attributes(101), srid=srid)
    window = geoparquet.meets(F.col("bbox"), (20.25, -1, 30.25, 1))
    found = shapes(spark, tmp_path).where(window)
    whole = ingest(spark, tmp_path)
    assert rows(found) == rows(whole.where(window)) and found.count() == 10 + 11
    assert rows(found.where("_source_file in ('b.shp')")) == rows(whole.where(window).where("_source_file = 'b.shp'"))

    schema = shapes(spark, tmp_path).schema
    reader = shapereader.ShapefileReader({f"{tmp_path}/{n}.shp": (4000, k) for n, k in (("a", 100), ("b", 101))}, schema, 4326, 10 ** 6)
    back = [GreaterThanOrEqual(("bbox", "xmax"), 20.25), LessThanOrEqual(("bbox", "xmin"), 30.25), EqualTo(("_source_file",), "a.shp")]
    assert list(reader.pushFilters(back)) == back
    (part,) = reader.partitions()
    assert [r.path for r in part.value] == [f"{tmp_path}/a.shp"]
    assert sum(b.num_rows for b in reader.read(part)) == 10  # what tasks hand over, before Spark filters


def test_a_file_whose_extent_is_elsewhere_is_not_read(spark, tmp_path, monkeypatch):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, attributes(4))
    data = bytearray((tmp_path / "a.shp").read_bytes())
    data[36:68] = np.array([-7, 2, 3, 8], "<f8").tobytes()
    (tmp_path / "a.shp").write_bytes(data)
    schema = shapes(spark, tmp_path).schema
    read, real = [], shapefile._read
    monkeypatch.setattr(shapefile, "_read", lambda path, *a: read.append(b := real(path, *a)) or b)

    def octets(box):
        read.clear()
        reader = shapereader.ShapefileReader({f"{tmp_path}/a.shp": (len(data), 4)}, schema, 4326, 10 ** 6, box)
        n = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
        return n, sum(map(len, read))
    near, apart = octets((0, 0, 2, 3)), octets((50, 50, 60, 60))
    assert near[0] == 1 and apart[0] == 0 and apart[1] < near[1]


def test_a_record_that_cannot_be_told_is_not_left_out(spark, tmp_path):
    write_shapefile(f"{tmp_path}/a.shp", POINTS, attributes(4))
    data = bytearray((tmp_path / "a.shp").read_bytes())
    data[108:112] = (77).to_bytes(4, "little")
    (tmp_path / "a.shp").write_bytes(data)
    schema = shapes(spark, tmp_path).schema
    reader = shapereader.ShapefileReader({f"{tmp_path}/a.shp": (len(data), 4)}, schema, 4326, 10 ** 6, (50, 50, 60, 60))
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.column("_error").to_pylist() for b in batches] == [["unknown_shape_type"]]
