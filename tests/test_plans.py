"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from samples.queries import QUERIES
from samples.views import features, table
from strandline.functions import geometry as geo
from strandline.operators import columns, geojoin, packing, sampling, skew, spatial
from strandline.session import scratch_path, scratch_root

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "geom_inner_join", "geom_left_anti", "geom_match_counts", "control_value_join", "geom_near_copies",
    "geom_lookup_status", "spatial_containment_join", "spatial_boxes_in_cells", "reconcile_sampled",
    "reconcile_chunks", "dictionary_encode", "membership_flag", "schema_gate", "geom_equals"])
def test_joins_have_keys(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_eq_project"](spark, SF))
    assert "EqualTo(l_suppkey,7)" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>", text)
    assert "StringContains(p_type,ECON)" in plan(QUERIES["filter_contains"](spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_size:int>" in plan(QUERIES["parquet_scan_pruned"](spark, SF))
    orders = table(spark, SF, "orders").withColumnRenamed("o_orderkey", "_fid")
    text = plan(columns.feature_slice(orders, 10, 20).select("_fid"))
    assert "GreaterThanOrEqual(o_orderkey,10)" in text and "LessThan(o_orderkey,20)" in text


def test_top_k_does_not_sort_everything(spark):
    text = plan(QUERIES["value_counts_topk"](spark, SF))
    assert "TakeOrderedAndProject" in text and "Sort [" not in text


def test_samples_shrink_before_the_shuffle(spark):
    rows = table(spark, SF, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("_fid"))
    text = plan(sampling.sample_rows_per_file(rows, "l_suppkey"))
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_hot_keys_are_split_at_run_time(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(200_000).selectExpr("id", "if(id % 3 = 0, null, if(id % 3 = 1, 7, id % 1000)) as k", "uuid() as t")
        right = spark.range(1000).selectExpr("id as k", "id as v").repartition(4)
        for how in ("inner", "left", "left_semi", "left_anti"):
            joined = skew.skew_join(left, right, ["k"], how)
            joined.write.format("noop").mode("overwrite").save()
            joined.collect()
            assert "skew=true" in plan(joined), how
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_building_a_join_starts_no_job(spark):
    left, right = features(spark, SF, "feat"), features(spark, SF, "feat_copy")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    for df in (geojoin.geom_inner_join(left, right), geojoin.geom_anti_join(left, right), geojoin.geom_match_counts(left, right),
               geojoin.control_value_join(left, right, "gui")):
        assert df.columns
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_box_of_a_containing_row_reaches_the_scan(spark):
    path = scratch_path(spark, "boxes")
    features(spark, SF, "boxes").withColumn("bbox", geo.geom_bbox("geometry")).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    found = spatial.containing_rows(spark.read.parquet(path), geo.wkb_from_wkt("POINT (1 1)"), ["box_id"], box="bbox")
    assert "LessThanOrEqual(bbox.xmin,1.0)" in plan(found) and "GreaterThanOrEqual(bbox.ymax,1.0)" in plan(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_chunk_numbers_need_no_exchange(spark):
    orders = table(spark, SF, "orders")
    text = plan(orders.select(packing.row_chunk(F.col("o_orderkey"), 1000)))
    assert "Exchange" not in text and "Window" not in text


def test_scratch_folder_is_in_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark).startswith(configured.rstrip("/") + "/")
    assert scratch_root(spark) == scratch_root(spark)
