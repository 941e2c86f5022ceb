import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import align, crs
from strandline.functions import geometry as geo
from strandline.operators import aggregates, columns, dictionary, gate, geojoin, ordering, packing, sampling, skew


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def geoms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "_fid long, wkt string")
    return df.withColumn("geometry", geo.wkt_to_geom("wkt"))


# ---------------------------------------------------------------- columns

def test_lowercase_rejects_collisions(spark):
    assert columns.lowercase_columns(spark.createDataFrame([(1, 2)], "A int, bB int")).columns == ["a", "bb"]
    with pytest.raises(ValueError):
        columns.lowercase_columns(spark.createDataFrame([(1, 2)], "A int, a int"))


def test_select_with_fill_compares_names_as_they_are(spark):
    df = spark.createDataFrame([("x", b"1")], "gui string, geometry binary")
    out = columns.select_with_fill(df, ["gui", "GUI2"])
    assert out.columns == ["gui", "GUI2", "geometry"] and rows(out.select("gui", "GUI2")) == [("x", None)]


def test_null_geometries_are_counted_in_the_same_pass(spark):
    seen = Observation("nulls")
    df = columns.drop_null_geometry(geoms(spark, ["POINT (1 1)", None, "POLYGON EMPTY", None]), report=seen)
    assert df.count() == 2 and seen.get["null_geometries"] == 2


def test_selectors(spark):
    names = spark.createDataFrame([("aIT.shp",), ("IT.shp",), ("GB.shp",)], "n string")

    def kept(*args):
        return [r[0] for r in rows(names.where(columns.any_match(F.col("n"), *args)))]
    assert kept(["IT"]) == ["IT.shp", "aIT.shp"] and kept(["IT"], "prefix") == ["IT.shp"]
    assert len(kept([])) == len(kept(None)) == len(kept(["shp"])) == 3 and kept(["it"]) == []


def test_membership_by_stem_and_exact(spark):
    names = spark.createDataFrame([("a.shp",), ("b.shp",)], "name string")
    values = spark.createDataFrame([("a",), ("b.shp",), (None,), ("a",)], "gui string")
    assert rows(columns.membership_flag(names, "name", values, "gui")) == [("a.shp", True), ("b.shp", False)]
    assert rows(columns.membership_flag(names, "name", values, "gui", exact=True)) == [("a.shp", False), ("b.shp", True)]


def test_contains_as_text_and_as_pattern(spark):
    df = spark.createDataFrame([("FR1",), ("xFRx",), ("fr",), (None,)], "gui string")
    assert columns.filter_contains(df, "gui", "FR").count() == 2
    assert columns.filter_contains(df, "gui", "^FR", pattern=True).count() == 1


# ---------------------------------------------------------------- alignment

def test_alignment_follows_the_type_table(spark):
    schema = ("i int, l long, s short, f float, d double, t string, day date, ts timestamp, b boolean, "
              "dec decimal(9,2), arr array<int>, v void, geometry binary")
    day, ts = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    df = spark.createDataFrame([(1, 16777217, 3, 0.5, 0.1, None, day, ts, True, None, [1], None, b"g")], schema)
    out = align.align_types(df)
    kinds = dict(out.dtypes)
    assert kinds == {"i": "float", "l": "float", "s": "smallint", "f": "float", "d": "float", "t": "string",
                     "day": "string", "ts": "timestamp_ntz", "b": "boolean", "dec": "string", "arr": "string",
                     "v": "string", "geometry": "binary"}
    row = out.first()
    assert row.l == 16777216.0 and row.t == row.dec == row.v == "None" and row.day == "2024-01-02"
    assert row.ts == dt.datetime(2024, 1, 2, 3, 4, 5)
    kept = align.align_types(df, null_text=None, lossless=True)
    assert kept.first().t is None and kept.first().l == 16777217 and dict(kept.dtypes)["d"] == "double"


def test_unparsable_times_become_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.9",), ("soon",)], "t string")
    assert rows(df.select(align.parse_timestamp(F.col("t")))) == [(None,), (dt.datetime(2024, 1, 2, 3, 4, 5),)]


def test_dictionary_codes_of_repeated_values(spark):
    values = ["b"] * 50 + ["a"] * 3 + [None] * 40 + ["c"]
    df = spark.createDataFrame(list(enumerate(values)), "_fid long, v string")
    out = {r["_fid"]: r["code"] for r in dictionary.dictionary_encode(df, "v").collect()}
    assert out == {i: {"a": 0, "b": 1, "c": 2, None: -1}[v] for i, v in enumerate(values)}


# ---------------------------------------------------------------- skew

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    rng = random.Random(1)
    left = spark.createDataFrame([(i, rng.choice([7, 7, 7, None, i % 40]), i % 2) for i in range(600)],
                                 "id long, k long, k2 long")
    right = spark.createDataFrame([(7, 0, "x"), (7, 1, "y"), (7, 1, "z"), (3, 1, "w"), (None, 0, "n")],
                                  "k long, k2 long, v string")
    assert rows(skew.skew_join(left, right, ["k", "k2"], how)) == rows(left.join(right, ["k", "k2"], how))


def test_skew_join_with_a_condition(spark):
    left = spark.createDataFrame([(i, 1 if i < 90 else 2, float(i)) for i in range(100)], "id long, k long, a double")
    right = spark.createDataFrame([(1, 10.5), (1, 70.5), (2, 500.0)], "k long, b double")
    out = skew.skew_join(left, right, ["k"], "left_semi", condition=F.abs(F.col("a") - F.col("b")) < 2)
    assert [r.id for r in out.orderBy("id").collect()] == [9, 10, 11, 12, 69, 70, 71, 72]


# ---------------------------------------------------------------- order and packing

def test_global_index_and_running_total(spark):
    values = list(range(1000))
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v long, n long").repartition(6)
    out = ordering.with_global_index(df, ["v"], "i", total_of="n").orderBy("v").collect()
    total = 0
    for i, r in enumerate(out):
        total += i % 7
        assert (r.v, r.i, r.running_total) == (i, i, total)
    assert ordering.with_global_index(df.limit(0), ["v"]).count() == 0


def test_global_index_keeps_columns_of_any_name(spark):
    private = ["_row", "_part", "_n", "_sum", "_start", "_base", "a.b", "__row"]
    df = spark.createDataFrame([(v, *[f"{c}{v}" for c in private]) for v in range(40)], ["v", *private]).repartition(4)
    out = ordering.with_global_index(df, [F.col("v").desc()], "i", total_of="v", total="t")
    assert out.columns == ["v", *private, "i", "t"]
    for row in out.collect():
        assert row.i == 39 - row.v and row.t == sum(range(row.v, 40))
        assert list(row)[1:-2] == [f"{c}{row.v}" for c in private]
    with pytest.raises(ValueError, match="already"):
        ordering.with_global_index(df.withColumn("_fid", F.lit(1)), ["v"])


def folded(sizes, limit, rule):
    ids, chunk, held, empty = [], 0, 0, True
    for n in sizes:
        if rule == "at_most" and not empty and held + n > limit:
            chunk, held = chunk + 1, 0
        ids.append(chunk)
        held, empty = held + n, False
        if rule == "at_least" and held >= limit:
            chunk, held = chunk + 1, 0
    return ids


@pytest.mark.parametrize("rule", ["at_least", "at_most"])
@pytest.mark.parametrize("sizes", [
    [100, 1, 1], [1, 100, 0, 0, 10, 0, 10, 0], [10, 10], [9],
    random.Random(5).choices(range(15), k=120)], ids=lambda v: str(v)[:12])
def test_packing_follows_the_rule(spark, rule, sizes):
    df = spark.createDataFrame([(f"f{i:04d}", n) for i, n in enumerate(sizes)], "path string, size_bytes long")
    out = packing.pack_files(df.repartition(3), 10, rule).orderBy("path").collect()
    assert [r.chunk_id for r in out] == folded(sizes, 10, rule)


@pytest.mark.parametrize("rule", ["at_least", "at_most"])
def test_packing_of_files_of_one_path_follows_their_size(spark, rule):
    rng = random.Random(7)
    files = [(f"f{i // 8}", rng.randrange(15), i) for i in range(160)]
    files.sort(key=lambda f: (f[0], -f[1]))
    df = spark.createDataFrame(files, "path string, size_bytes long, n_rows long")
    want = sorted(files, key=lambda f: f[:2])
    ids = folded([f[1] for f in want], 20, rule)
    for parts in (1, 5):
        out = packing.pack_files(df.repartition(parts), 20, rule).collect()
        assert sorted((r.path, r.size_bytes, r.chunk_id) for r in out) == sorted((f[0], f[1], c) for f, c in zip(want, ids, strict=True))


def test_packing_nothing(spark):
    empty = spark.createDataFrame([], "path string, size_bytes long")
    assert packing.pack_at_least(empty, 10).count() == 0
    assert packing.pack_count(empty, 10).first().n_chunks == 0
    assert packing.size_total(empty).first().total_bytes == 0


def test_row_chunks_are_one_based_and_partial_at_the_end(spark):
    df = spark.range(2500).select(packing.row_chunk(F.col("id"), 1000).alias("c")).groupBy("c").count()
    assert rows(df) == [(1, 1000), (2, 1000), (3, 500)]
    assert spark.range(2000).select(packing.row_chunk(F.col("id"), 1000).alias("c")).distinct().count() == 2


# ---------------------------------------------------------------- gate and quarantine

FILES = [("a", "x", "int"), ("a", "y", "string"), ("b", "y", "string"), ("b", "x", "int"),
         ("c", "x", "double"), ("c", "y", "string"), ("d", "x", "int"),
         ("e", "x", "int"), ("e", "y", "string"), ("e", "z", "int")]


def test_gate_compares_names_and_types_without_order(spark):
    df = spark.createDataFrame(FILES, "file_name string, column_name string, data_type string")
    assert rows(gate.schema_gate(df)) == [("a", True), ("b", True), ("c", False), ("d", False), ("e", False)]
    record = spark.createDataFrame([("x", "int")], "column_name string, data_type string")
    assert [n for n, ok in rows(gate.schema_gate(df, record)) if ok] == ["d"]
    assert rows(gate.common_columns(df)) == [("x", 5)]


def test_report_keeps_files_without_columns(spark):
    df = spark.createDataFrame(FILES, "file_name string, column_name string, data_type string")
    failed = spark.createDataFrame([("d", "schema_mismatch"), ("q", "not_a_shapefile")], "file_name string, reason string")
    assert rows(gate.quarantine_report(df, failed)) == [
        ("d", "schema_mismatch", "x", "int"), ("q", "not_a_shapefile", None, None)]


def test_one_bad_row_takes_its_file(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, "bad"), ("b", 0, None)],
                               "_source_file string, _fid long, _error string")
    good, failed = gate.isolate_failures(df)
    assert rows(good) == [("b", 0)] and rows(failed) == [("a", "bad")]


def test_concat_fills_and_records_drift(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 0.5)], "i int, d double")
    assert rows(gate.concat_by_name([a, b])[0]) == [(1, "x", None), (2, None, 0.5)]
    kept, left_out = gate.concat_by_name({"a": a, "drift": spark.createDataFrame([(1.0,)], "i double"), "b": b})
    assert rows(kept) == [(1, "x", None), (2, None, 0.5)]
    assert left_out == [("drift", "i is double, elsewhere int")]


def test_partition_numbers_reach_the_function(spark):
    out = gate.map_partitions(spark.range(100).repartition(4), lambda p, f: f.assign(p=p), "id long, p long")
    assert out.select("p").distinct().count() == 4 and out.count() == 100


def test_a_partition_reaches_the_function_whole(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        out = gate.map_partitions(spark.range(100).repartition(2), lambda p, f: f.head(1).assign(n=len(f)), "id long, n long")
        assert sum(r.n for r in out.collect()) == 100 and out.count() == 2
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# ---------------------------------------------------------------- aggregates and samples

def test_top_values_skip_nulls_and_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 3, 3, 9, 9, 1, None, None, None, None]], "k long")
    assert [tuple(r) for r in aggregates.value_counts_topk(df, "k", 3).collect()] == [(3, 2), (5, 2), (9, 2)]
    assert rows(aggregates.kth_most_common(df, "k", 3)) == [(9, 2)]
    assert rows(aggregates.kth_most_common(df, "k", 9)) == []
    assert aggregates.rows_of_kth_most_common(df, "k", 1).count() == 2
    assert aggregates.distinct_values(df, "k").count() == 5


def test_single_value_check_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "x"), ("b", 2, "z"), ("b", 1, None), ("b", 3, "y")],
                               "f string, _fid long, gui string")
    assert rows(aggregates.single_value_check(df, "f", "gui")) == [("a", 1, "x", True), ("b", 3, None, False)]


def test_dedupe_keeps_the_first_feature(spark):
    df = geoms(spark, ["POINT (1 1)", "POINT (2 2)", "POINT (1.0 1)", None, None, "POINT (-0.0 3)", "POINT (0 3)"])
    assert [r[0] for r in rows(aggregates.geom_dedupe(df).select("_fid"))] == [0, 1, 3, 5]


def test_samples_are_repeatable_and_take_what_is_there(spark):
    df = spark.createDataFrame([(f"f{i % 4}", i) for i in range(40)] + [("tiny", 99)], "f string, _fid long")
    one, two = (sampling.sample_rows_per_file(df.repartition(n), "f", n=5, seed=1) for n in (1, 7))
    assert rows(one) == rows(two) and one.where("f = 'tiny'").count() == 1 and one.count() == 21
    names = df.select("f").distinct()
    assert rows(sampling.sample_files(names, "f", 3, 1)) == rows(sampling.sample_files(names.repartition(3), "f", 3, 1))


# ---------------------------------------------------------------- geometry columns

def test_codecs_take_mixed_batches(spark):
    texts = ["POINT (1 2)", "POLYGON ((0 0, 1 0, 1 1, 0 0))", None, "POINT (oops)", "POINT EMPTY"]
    df = geoms(spark, texts).select("_fid", geo.geom_to_wkt("geometry").alias("t"), geo.geom_bbox("geometry").alias("b"))
    out = {r["_fid"]: (r.t, tuple(r.b) if r.b else None) for r in df.collect()}
    assert out == {0: (texts[0], (1, 2, 1, 2)), 1: (texts[1], (0, 0, 1, 1)), 2: (None, None), 3: (None, None),
                   4: ("POINT EMPTY", None)}


def test_keys_are_short_and_distinct(spark):
    long_line = "LINESTRING (" + ", ".join(f"{i} {i}" for i in range(50)) + ")"
    df = geoms(spark, ["POINT (1 2)", long_line, long_line, "POINT (2 1)", None])
    keys = [r[0] for r in df.orderBy("_fid").select(geo.geom_key(F.col("geometry"))).collect()]
    assert keys[1] == keys[2] and len({bytes(k) for k in keys[:4]}) == 3 and keys[4] is None
    assert len(keys[0]) == 21 and len(keys[1]) == 33 and keys[1][0] == 0xFF


def test_reprojection_round_trip_and_limits(spark):
    df = geoms(spark, ["LINESTRING (0 0, 170 80)", "POINT (10 90)", None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"])
    metres = df.withColumn("m", crs.reproject(F.col("geometry"), 4326, 3857))
    back = metres.withColumn("d", crs.reproject(F.col("m"), 3857, 4326)).orderBy("_fid").collect()
    from strandline.functions import codec
    assert back[1].m is None and back[2].m is None
    for i in (0, 3):
        for a, b in zip(codec.rings(codec.decode_wkb(bytes(back[i].geometry))), codec.rings(codec.decode_wkb(bytes(back[i].d)))):
            assert abs(a - b).max() < 1e-9
    with pytest.raises(ValueError):
        crs.reproject(F.col("geometry"), 2154, 4326)
    assert crs.reproject(F.col("geometry"), 4326, 4326)._jc.toString() == F.col("geometry")._jc.toString()
    x, y = crs.to_web_mercator(F.lit(180.0), F.lit(90.0))
    assert spark.range(1).select(x, y).first()[1] is None


def test_geometry_joins_ignore_nulls_and_flavours(spark):
    left = geoms(spark, ["POINT (1 1)", "POINT (1 1)", "POINT (2 2)", None])
    right = geoms(spark, ["POINT (1 1)", "POINT (1.0 1.0)", "POINT (3 3)", None])
    assert [r._fid for r in geojoin.geom_inner_join(left, right).orderBy("_fid").collect()] == [0, 1]
    assert [r._fid for r in geojoin.geom_anti_join(left, right).collect()] == [2]
    assert tuple(geojoin.geom_match_counts(left, right).first()) == (2, 1, 1, 2, 2)
    assert tuple(geojoin.geom_match_counts(left.limit(0), right.limit(0)).first()) == (0, 0, 0, 0, 0)
    assert geojoin.geom_equals(left, geo.wkb_from_wkt("POINT (2 2)")).count() == 1


def test_control_values_null_equals_null(spark):
    left = geoms(spark, ["POINT (1 1)", "POINT (2 2)", "POINT (3 3)", "POINT (4 4)", None])
    left = left.join(spark.createDataFrame([(0, "a"), (1, None), (2, None), (3, "a"), (4, "a")], "_fid long, gui string"), "_fid")
    right = geoms(spark, ["POINT (1 1)", "POINT (1 1)", "POINT (2 2)", "POINT (3 3)"])
    right = right.join(spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "null")], "_fid long, gui string"), "_fid")
    out = geojoin.control_value_join(left, right, "gui").orderBy("_fid").collect()
    assert [r.status for r in out] == ["match", "match", "control_mismatch", "not_found", "not_found"]


def test_schema_report(spark):
    report = columns.schema_report(spark.createDataFrame([(1, "a")], "i int, s string"), "t")
    assert rows(report) == [("t", "i", "int", 0), ("t", "s", "string", 1)]
    assert columns.columns_of_type(spark.createDataFrame([(1, "a")], "i int, s string"), T.StringType) == ["s"]


def test_partition_map_bounds_the_rows_of_a_partition(spark, tmp_path, monkeypatch):
    from samples import queries

    prices = [i * 7919 % 300 / 4 for i in range(4000)]  # one supplier has nearly all rows, with ties
    made = [(i, 1, 1 if i % 50 else 2, p) for i, p in enumerate(prices)]
    spark.createDataFrame(made, "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    whole, held = gate.map_partitions, []

    def watched(df, fn, schema):
        held.extend(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        return whole(df, fn, schema)
    monkeypatch.setattr(gate, "map_partitions", watched)
    monkeypatch.setattr(queries, "PARTITION_ROWS", 500, raising=False)
    out = {r[0]: (r[2], r[3]) for r in queries.partition_map(spark, str(tmp_path)).collect()}
    assert held and max(held) <= 600
    of = {s: [m[3] for m in made if m[2] == s] for s in (1, 2)}
    assert out == {m[0]: (1 + sum(p > m[3] for p in of[m[2]]), len(of[m[2]])) for m in made}


@pytest.mark.parametrize("rows_at_once", [1, 7, 10_000])
def test_streamed_partitions_carry_state(spark, rows_at_once):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def counted(part, frames):
        seen, total = 0, 0
        for frame in frames:
            assert len(frame) <= rows_at_once
            seen, total = seen + len(frame), total + int(frame["v"].sum())
        if seen:
            yield pd.DataFrame({"part": [part], "n": [seen], "total": [total]})
    try:
        spark.conf.set(name, rows_at_once)
        df = spark.range(100).select(F.col("id").alias("v"), (F.col("id") % 3).cast("int").alias("p"))
        found = gate.stream_partitions(df.repartitionById(5, "p"), counted, "part int, n long, total long").collect()
        assert sorted(map(tuple, found)) == [(p, len(range(p, 100, 3)), sum(range(p, 100, 3))) for p in range(3)]
        assert gate.stream_partitions(df.limit(0), counted, "part int, n long, total long").count() == 0
    finally:
        spark.conf.set(name, before)


def test_no_tables_to_concatenate():
    with pytest.raises(ValueError, match="no tables"):
        gate.concat_by_name([])
