import itertools
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.functions import codec, predicates
from strandline.functions import geometry as geo
from strandline.operators import geojoin, spatial


def frame(spark, texts, name):
    df = spark.createDataFrame(list(enumerate(texts)), f"{name} long, wkt string")
    return df.withColumn("geometry", geo.wkt_to_geom("wkt"))


def box(x, y, w, h):
    return f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"


def shapes(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randint(-40, 40) / 2, rng.randint(-40, 40) / 2
        out.append([
            f"POINT ({x} {y})", box(x, y, rng.choice([0.5, 3, 30]), rng.choice([0.5, 4, 20])),
            f"MULTIPOINT ({x} {y}, {x + 1} {y})", f"LINESTRING ({x} {y}, {x + 2} {y + 2})",
            f"POLYGON (({x} {y}, {x + 9} {y}, {x + 9} {y + 9}, {x} {y + 9}, {x} {y}), "
            f"({x + 2} {y + 2}, {x + 4} {y + 2}, {x + 4} {y + 4}, {x + 2} {y + 4}, {x + 2} {y + 2}))",
            "POLYGON EMPTY", None][i % 7])
    return out


def brute(outers, inners):
    found = set()
    for (i, a), (j, b) in itertools.product(enumerate(outers), enumerate(inners)):
        if a and b and predicates.contains(codec.decode_wkt(a), codec.decode_wkt(b)):
            found.add((i, j))
    return found


def test_containment_join_equals_brute_force(spark):
    outers = shapes(1, 120) + ["POINT (1 1)", "POINT (1 1)"]
    inners = shapes(2, 140) + ["POINT (1 1)"] * 60
    pairs = spatial.containment_join(frame(spark, outers, "o"), frame(spark, inners, "i"), ["o"], ["i"]).collect()
    assert {(r.o, r.i) for r in pairs} == brute(outers, inners)
    assert len(pairs) == len({(r.o, r.i) for r in pairs}) and {r.relation for r in pairs} == {"contains"}


def test_stored_boxes_and_few_probes_give_the_same(spark):
    outers, inners = shapes(3, 60), shapes(4, 15)
    held = frame(spark, outers, "o").withColumn("bbox", geo.geom_bbox("geometry"))
    sought = frame(spark, inners, "i").withColumn("bbox", geo.geom_bbox("geometry"))
    pairs = spatial.containment_join(held, sought, ["o"], ["i"], container_box="bbox", probe_box="bbox", few_probes=True)
    assert {(r.o, r.i) for r in pairs.collect()} == brute(outers, inners)


def test_copies_are_decided_once(spark, monkeypatch):
    asked = spark.sparkContext.accumulator(0)

    @F.arrow_udf("boolean")
    def counted(outer: pa.Array, inner: pa.Array) -> pa.Array:
        asked.add(len(outer) - outer.null_count)
        return geo.geom_contains.func(outer, inner)
    monkeypatch.setattr(spatial, "geom_contains", counted)
    outers = [box(0, 0, 9, 9)] * 30 + [box(20, 0, 9, 9)] + ["POINT (1 1)", None] * 2
    inners = [box(1, 1, 2, 2)] * 40 + ["POINT (1 1)"] * 20 + [box(21, 1, 2, 2), None, "POINT (1e999 1)", "POINT (1e999 1)"]
    held, sought = frame(spark, outers, "o"), frame(spark, inners, "i")
    for stored in (None, "bbox"):
        before = asked.value
        pairs = spatial.containment_join(held.withColumn("bbox", geo.geom_bbox("geometry")), sought, ["o"], ["i"], container_box=stored).collect()
        lost = [r for r in pairs if r.o is None]
        assert sorted(r.i for r in lost) == [62, 63] and {r.relation for r in lost} == {"unsupported"}
        known = [(r.o, r.i) for r in pairs if r.o is not None]
        assert len(known) == len(set(known)) and set(known) == brute(outers, inners[:62])
        assert asked.value - before == 2


def test_undecidable_pairs_are_reported(spark):
    outers = ["GEOMETRYCOLLECTION (POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0)))", box(0, 0, 9, 9)]
    inners = ["POINT (1 1)", "GEOMETRYCOLLECTION (POINT (2 2))", "POINT (50 50)"]
    pairs = spatial.containment_join(frame(spark, outers, "o"), frame(spark, inners, "i"), ["o"], ["i"])
    assert sorted(map(tuple, pairs.collect())) == [
        (0, 0, "unsupported"), (0, 1, "unsupported"), (1, 0, "contains"), (1, 1, "unsupported")]


def test_coordinates_without_end_are_reported(spark):
    held = frame(spark, [box(0, 0, 9, 9), "POINT (1 1)", box(-1e200, -1e200, 3e200, 3e200)], "o")
    wide = held.withColumn("bbox", F.when(F.col("o") == 1, F.struct(*[
        F.lit(float(v)).alias(n) for n, v in (("xmin", "-inf"), ("ymin", 0), ("xmax", "inf"), ("ymax", "nan"))]))
        .otherwise(geo.geom_bbox("geometry")))
    sought = frame(spark, ["POINT (1 1)", "POINT EMPTY", "POINT (1e999 1)", "LINESTRING (0 0, 1 -1e999)"], "i")
    pairs = spatial.containment_join(wide, sought, ["o"], ["i"], container_box="bbox")
    assert sorted(map(tuple, pairs.collect()), key=repr) == [
        (0, 0, "contains"), (1, None, "unsupported"), (2, 0, "contains"), (None, 2, "unsupported"), (None, 3, "unsupported")]
    few = spatial.containment_join(wide, sought.limit(2), ["o"], ["i"], container_box="bbox", few_probes=True)
    assert {(0, 0, "contains"), (2, 0, "contains")} <= set(map(tuple, few.collect()))
    found = spatial.contained(sought, wide, ["i"], container_box="bbox")
    assert sorted(map(tuple, found.collect())) == [(0, "contains"), (2, "unsupported"), (3, "unsupported")]


def test_contained_equals_brute_force(spark):
    outers = shapes(11, 90) + ["GEOMETRYCOLLECTION (POLYGON ((70 70, 90 70, 90 90, 70 70)))", "POINT (1 1)",
                               "POLYGON ((-9 0, 0 -9, 9 0, 0 9, -9 0))", "POLYGON ((-9 30, -9 39, 9 39, 0 35, 9 30, -9 30))"]
    inners = shapes(12, 150) + ["POINT (1 1)"] * 20 + ["POINT (75 72)", box(-2, -2, 3, 4), box(-8, 34, 3, 2), box(5, 31, 3, 7),
                                                       "POLYGON ((0 0, 1 1, 0 0))"]
    decided = [o for o in outers if not (o or "").startswith("GEOMETRYC")]
    want = {i: "contains" for _, i in brute(decided, inners)}
    want[len(inners) - 5] = "unsupported"
    for stored in (None, "bbox"):
        held = frame(spark, outers, "o")
        held = held.withColumn("bbox", geo.geom_bbox("geometry")) if stored else held
        found = spatial.contained(frame(spark, inners, "i"), held, ["i"], container_box=stored).collect()
        assert {r.i: r.relation for r in found} == want and len(found) == len(want)
    assert len(want) > 40
    assert spatial.contained(frame(spark, inners, "i").limit(0), frame(spark, outers, "o"), ["i"]).count() == 0
    assert spatial.contained(frame(spark, inners, "i"), frame(spark, outers, "o").limit(0), ["i"]).count() == 0


def rugged(seed, x, y, n, tall=False):
    """A polygon of many vertices around a place: rugged, or of tall narrow teeth."""
    rng = random.Random(seed)
    if tall:
        teeth = [p for i in range(n) for p in ((x + i / n * 8, y), (x + (i + 0.5) / n * 8, y + 6 + rng.random()))]
        return f"POLYGON (({x} {y - 1}, {x + 8} {y - 1}, " + ", ".join(f"{a} {b}" for a, b in reversed(teeth)) + f", {x} {y - 1}))"
    points = [(x + (4 + rng.random()) * math.cos(2 * math.pi * i / n), y + (4 + rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    hole = f", ({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y})"
    return "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in [*points, points[0]]) + f"){hole})"


def test_slabs_give_the_same_as_whole_boundaries(spark, monkeypatch):
    outers = shapes(21, 50) + [rugged(1, 0, 0, 700), rugged(2, 3, 3, 90, tall=True), rugged(3, -5, 2, 40), box(-3, 5, 6, 2),
                               "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((9 9, 12 9, 12 12, 9 9)))", "POLYGON ((0 0, 5 0, 0 0))"]
    rng = random.Random(5)
    inners = shapes(22, 80) + [f"POINT ({rng.uniform(-8, 12)} {rng.uniform(-8, 12)})" for _ in range(150)] + ["POINT (2 7)", "POINT (1 2)"]
    pairs, want = brute(outers, inners), {i for _, i in brute(outers, inners)}
    for bytes_, edges in ((100, 1), (100, 7), (3000, 48), (1 << 20, 48)):
        monkeypatch.setattr(spatial, "LARGE_BYTES", bytes_)
        monkeypatch.setattr(spatial, "SLAB_EDGES", edges)
        held, sought = frame(spark, outers, "o"), frame(spark, inners, "i")
        found = spatial.containment_join(held, sought, ["o"], ["i"], keep_geometry=edges == 7).collect()
        assert {(r.o, r.i) for r in found} == pairs and len(found) == len(pairs)
        assert {r.i for r in spatial.contained(sought, held, ["i"]).collect()} == want
    assert len(want) > 100


def test_near_containers_equal_brute_force(spark):
    rng = random.Random(9)

    def jittered(spread):
        x, y = rng.randint(0, 2), rng.randint(0, 2)
        return box(x + rng.uniform(0, spread), y + rng.uniform(0, spread), 1, 1) if rng.random() < 0.8 else f"POINT ({x} {y})"
    outers, inners = [jittered(0.0004) for _ in range(60)], [
        f"POLYGON (({x} {y}, {x + 1 - d} {y}, {x + 1 - d} {y + 1 - d}, {x} {y + 1 - d}, {x} {y}))"
        for x, y, d in ((rng.randint(0, 2) + 0.0005, rng.randint(0, 2) + 0.0005, rng.choice([0, 0.0002, 0.0008, 0.01])) for _ in range(60))]
    pairs = brute(outers, inners)
    want = {i for o, i in pairs if predicates.equals_within(codec.decode_wkt(outers[o]), codec.decode_wkt(inners[i]), 0.001)}
    found = spatial.near_containers(frame(spark, inners, "i"), frame(spark, outers, "o"), "i", 0.001)
    assert sorted(r.i for r in found.collect()) == sorted(want) and 0 < len(want) < 60


def test_convex_outlines(spark):
    texts = {box(0, 0, 2, 3): 1, "POLYGON ((0 0, 0 2, 2 2, 2 0, 0 0))": -1, "POLYGON ((0 0, 1 0, 2 0, 2 2, 0 0))": 1,
             "POLYGON ((0 0, 4 0, 4 4, 2 1, 0 0))": 0, "POLYGON ((0 0, 4 0, 1 3, 2 -2, 4 3, 0 0))": 0, "POLYGON ((0 0, 2 2, 0 0))": 0,
             "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)))": 0, "POLYGON ((0 0, 9 0, 9 9, 0 0), (5 1, 6 1, 6 2, 5 1))": 0, "POINT (1 1)": 0,
             "POLYGON ((0 0, 2 0, 3 0, 1 0, 1 2, 0 0))": 0}
    rows = frame(spark, list(texts), "i").select("wkt", geo.geom_frame("geometry").alias("f")).collect()
    assert {r.wkt: r.f.turn for r in rows} == texts


PRIVATE = ["_held", "_sought", "_outer", "_inner", "_stored", "_box", "_edges", "_turn", "_walls", "_frame", "_level", "_cx", "_cy",
           "_outer_box", "_decided", "_exact", "_id", "_geom_key", "_control", "_verdict", "key", "value", "ours", "found", "n", "relation_"]


def test_private_names_do_not_reach_the_users(spark):
    def odd(texts, number):
        df = frame(spark, texts, number)
        return df.select("*", *(F.concat(F.lit(f"{number}{c}"), number).alias(c) for c in PRIVATE))
    outers, inners = shapes(1, 30) + ["POINT (1 1)"], shapes(2, 40) + ["POINT (1 1)"]
    held = odd(outers, "o")
    renamed = odd(inners, "i").withColumnsRenamed({c: f"{c}2" for c in PRIVATE if c != "_id"}).withColumnRenamed("_id", "_ID2")
    pairs = spatial.containment_join(held, renamed, ["o", *PRIVATE], ["i", "_ID2"]).collect()
    assert {(r.o, r.i) for r in pairs} == brute(outers, inners)
    assert all(r[c] == f"o{c}{r.o}" for r in pairs for c in PRIVATE) and all(r._ID2 == f"i_id{r.i}" for r in pairs)
    found = spatial.contained(odd(inners, "i"), held, ["i", *PRIVATE]).collect()
    assert {r.i for r in found} == {i for _, i in brute(outers, inners)} and all(r[c] == f"i{c}{r.i}" for r in found for c in PRIVATE)
    left = odd(inners, "i")
    for out in (geojoin.geom_inner_join(left, held), geojoin.geom_anti_join(left, held), spatial.near_copies(left, held, 0.001),
                geojoin.control_value_join(left, held, "_control").drop("status")):
        assert out.columns == left.columns and out.count() > 0
        assert all(r[c] == f"i{c}{r.i}" for r in out.collect() for c in PRIVATE)
    rows = spatial.containing_rows(held, geo.wkb_from_wkt("POINT (1 1)"), ["o", *PRIVATE]).collect()
    assert rows and all(r[c] == f"o{c}{r.o}" for r in rows for c in PRIVATE)


def test_no_containers_or_probes(spark):
    held, sought = frame(spark, [box(0, 0, 9, 9)], "o"), frame(spark, ["POINT (1 1)"], "i")
    assert spatial.containment_join(held.limit(0), sought, ["o"], ["i"]).count() == 0
    assert spatial.containment_join(held, sought.limit(0), ["o"], ["i"]).count() == 0


def test_rows_that_contain_one_geometry(spark):
    outers = shapes(5, 70)
    df = frame(spark, outers, "o")
    for probe in ("POINT (3 3)", "POINT (0.25 0.25)", "LINESTRING (3 3, 3.5 3.5)"):
        found = spatial.containing_rows(df, geo.wkb_from_wkt(probe), ["o"]).collect()
        assert {r.o for r in found} == {o for o, _ in brute(outers, [probe])}
    assert spatial.containing_rows(df, geo.wkb_from_wkt("POINT EMPTY"), ["o"]).count() == 0


def test_a_container_fills_few_cells_at_any_size(spark):
    sizes = [1e-7, 0.001, 0.3, 7, 90, 5000, 4e7, 1e200]
    df = frame(spark, [box(12.3, 45.6, s, s * 0.7) for s in sizes], "o")
    cells = spatial.container_cells(spatial._framed(df, "geometry", None, edges=False)).groupBy("o").count()
    assert cells.agg(F.max("count")).first()[0] <= 4


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(6)

    def jitter(n, spread):
        out = []
        for i in range(n):
            x, y = (rng.randint(0, 3) + rng.uniform(-spread, spread) for _ in range(2))
            out.append(f"POINT ({x!r} {y!r})" if i % 3 else
                       f"LINESTRING ({x!r} {y!r}, {x + rng.uniform(0, spread)!r} {y + 1!r})")
        return out
    left = jitter(150, 0.002) + ["POINT (1 1)"] * 50 + [None, "POINT EMPTY", "POINT (0 0)"]
    right = jitter(150, 0.002) + ["POINT (1.0009 1)"] * 50 + [None, "POINT EMPTY", "POINT (-0.0004 0.0004)"]
    near = {i for i, a in enumerate(left) if a and any(
        b and predicates.equals_within(codec.decode_wkt(a), codec.decode_wkt(b), 0.001) for b in right)}
    out = spatial.near_copies(frame(spark, left, "i"), frame(spark, right, "j"), 0.001).collect()
    assert sorted(r.i for r in out) == sorted(near) and 0 < len(near) < len(left)
