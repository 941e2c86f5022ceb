"""Containment and tolerance joins through a grid of equal keys.

Every container is filed under the cells its bounding box covers on a grid about
as coarse as the box, so never more than a handful. A probe's box must lie inside
the container's, hence so does its lower-left corner: the probe is looked up under
that corner's cell once per grid size in use. Each pair therefore meets exactly
once, at any size of container, and needs no dedupe afterwards.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.geometry import (
    EDGES_TYPE, bbox_batch, double_area, geom_bbox, geom_contains, geom_frame, geom_key, once, point_in_edges, snap_frame,
    vertices_in_convex)
from strandline.operators.geojoin import KEY, keyed, with_key
from strandline.operators.naming import quoted
from strandline.operators.skew import skew_join
from strandline.session import write_through

# Grid sizes are powers of two, exact in binary; neighbouring grids differ by this power.
LEVEL_STEP = 2
FINEST_LEVEL = -20
# Levels, below all others, of rows that have no place.
LOST_PROBES, LOST_CONTAINERS = -5000, -5001
# Areas of more bytes are met slab by slab: about 2,000 vertices.
LARGE_BYTES = 32 * 1024
# Boundary segments of a slab, on average, if they are short.
SLAB_EDGES = 48
# An area of less than this share of its box may be rounding.
SOLID = 1e-6
# Probes up to this many rows and bytes are broadcast where the caller promises few.
FEW_PROBES, FEW_BYTES = 1_000, 8 * 1024 * 1024
# The WKB head of a plain little-endian point.
_POINT_HEAD = "0101000000"


def grid_level(box: Column) -> Column:
    """Exponent of the finest grid whose cells are at least as wide as the box."""
    extent = F.greatest(box.xmax - box.xmin, box.ymax - box.ymin)
    level = F.ceil(F.log2(extent) / LEVEL_STEP) * LEVEL_STEP
    return F.when(extent > 0, F.greatest(level, F.lit(FINEST_LEVEL))).otherwise(FINEST_LEVEL).cast("int")


def cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def is_point(geom: Column) -> Column:
    return (F.octet_length(geom) == 21) & (F.substring(geom, 1, 5) == F.unhex(F.lit(_POINT_HEAD)))


def _packed(columns: list[str], name: str) -> Column:
    """Columns of any name as one struct, so that none meets a private one."""
    return F.struct(F.lit(1).alias("n"), *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns))).alias(name)


def _unpacked(columns: list[str], name: str) -> list[Column]:
    return [F.col(f"{name}.c{i}").alias(c) for i, c in enumerate(columns)]


def endless(box: Column) -> Column:
    """Whether a box has no end on some side."""
    limit = F.lit(float("inf"))
    return (box.xmin == -limit) | (box.ymin == -limit) | (box.xmax == limit) | (box.ymax == limit)


def _framed(df: DataFrame, geometry: str, box: str | None, edges: bool) -> DataFrame:
    """Rows with a bounding box ``_box`` and, if wanted, boundary segments ``_edges`` and their ``_turn``.

    A box without end is no place: such rows stay, and meet a placeholder. Others without a box go.
    """
    if edges:
        df = df.withColumn("_frame", once(geom_frame)(geometry))
        df = (df.withColumn("_edges", F.col("_frame.edges")).withColumn("_turn", F.col("_frame.turn"))
              .withColumn("_box", F.col(box) if box else F.col("_frame.box")).drop("_frame"))
    else:
        df = df.withColumn("_box", F.col(box) if box else once(geom_bbox)(geometry))
    box, limit = F.col("_box"), F.lit(float("inf"))
    finite = (box.xmin > -limit) & (box.ymin > -limit) & (box.xmax < limit) & (box.ymax < limit)
    return df.where(F.coalesce(finite | endless(box), F.lit(False)))


def container_cells(df: DataFrame) -> DataFrame:
    """One row per container and covered cell; expects ``_box``."""
    box, level = F.col("_box"), F.col("_level")
    lost, nowhere = endless(box), F.array(F.lit(0).cast("long"))
    df = df.withColumn("_level", F.when(lost, F.lit(LOST_CONTAINERS)).otherwise(grid_level(box)))
    df = df.withColumn("_cx", F.explode(F.when(lost, nowhere).otherwise(F.sequence(cell(box.xmin, level), cell(box.xmax, level)))))
    return df.withColumn("_cy", F.explode(F.when(lost, nowhere).otherwise(F.sequence(cell(box.ymin, level), cell(box.ymax, level)))))


def probe_cells(df: DataFrame, levels: list[int]) -> DataFrame:
    """One row per probe and grid size in use; expects ``_box``."""
    box, level = F.col("_box"), F.col("_level")
    lost, nowhere = endless(box), F.lit(0).cast("long")
    df = df.withColumn("_level", F.explode(F.when(lost, F.array(F.lit(LOST_PROBES))).otherwise(F.array(*[F.lit(x) for x in levels]))))
    return (df.withColumn("_cx", F.when(lost, nowhere).otherwise(cell(box.xmin, level)))
            .withColumn("_cy", F.when(lost, nowhere).otherwise(cell(box.ymin, level))))


def _with_placeholder(cells: DataFrame, level: int) -> DataFrame:
    """Cells with one more row, all null, at which rows of the other side that have no place are found."""
    place = {"_level": F.lit(level), "_cx": F.lit(0).cast("long"), "_cy": F.lit(0).cast("long")}
    return cells.unionByName(cells.sparkSession.range(1).select(*(
        place.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in cells.schema)))


_KEYS = ["_level", "_cx", "_cy"]


def _levels(held: DataFrame) -> tuple[list[int], bool]:
    """The grid sizes in use of ``_stored`` boxes, one number per size, and whether any container is large."""
    box, large = F.col("_stored"), F.octet_length("_outer") > LARGE_BYTES
    used = held.where(box.isNotNull() & ~F.coalesce(endless(box), F.lit(True))).groupBy(grid_level(box).alias("level")).agg(
        F.max(large).alias("large")).collect()
    return sorted(r.level for r in used if r.level is not None) or [FINEST_LEVEL], any(r.large for r in used)


def _is_large() -> Column:
    """Whether a container with ``_edges`` is an area that is met slab by slab."""
    return F.col("_edges").isNotNull() & (F.octet_length("_outer") > LARGE_BYTES)


def points_in_slabs(points: DataFrame, areas: DataFrame, levels: list[int]) -> DataFrame:
    """``_point, _area``: points (``_point``, ``_box``) strictly inside areas (``_area``, ``_box``, ``_edges``).

    The boundary of an area is dealt to slabs of its height, about as many as it has segments over SLAB_EDGES, fewer if
    the segments are tall, so that a segment lies in few of them. A point whose box fits meets the segments of its slab only;
    how often they cross the line to its right, and whether it lies on one, is summed by pair. So no boundary travels whole.
    """
    box = F.col("_box")
    height = box.ymax - box.ymin
    reach = F.aggregate("_edges", F.lit(0.0), lambda total, e: total + F.abs(e.y2 - e.y1))
    slabs = F.when(height > 0, F.least(F.size("_edges") / SLAB_EDGES, F.size("_edges") / (reach / height))).otherwise(1.0)
    areas = areas.withColumn("_slabs", F.greatest(F.floor(slabs), F.lit(1)).cast("long"))

    def slab(y: Column, low: Column, tall: Column, number: Column) -> Column:
        return F.when(tall > 0, F.least(F.floor((y - low) / tall * number), number - 1)).otherwise(0).cast("long")

    segments = areas.select("_area", "_slabs", box.ymin.alias("_low"), height.alias("_tall"), F.explode("_edges").alias("e"))
    bounds = [slab(f("e.y1", "e.y2"), F.col("_low"), F.col("_tall"), F.col("_slabs")) for f in (F.least, F.greatest)]
    segments = segments.select("_area", F.explode(F.sequence(*bounds)).alias("_slab"), "e.x1", "e.y1", "e.x2", "e.y2")
    places = container_cells(areas.drop("_edges")).withColumnRenamed("_box", "_outer_box")
    near = skew_join(probe_cells(points.select("_point", "_box"), levels), places, _KEYS, "inner")
    outer = F.col("_outer_box")
    near = near.where(_fits(outer, box)).select(
        "_point", "_area", box.xmin.alias("x"), box.ymin.alias("y"),
        slab(box.ymin, outer.ymin, outer.ymax - outer.ymin, F.col("_slabs")).alias("_slab"))
    met = skew_join(near, segments, ["_area", "_slab"], "inner")
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    on = (((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1) == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2))
          & y.between(F.least(y1, y2), F.greatest(y1, y2)))
    crossing = F.when((y1 > y) != (y2 > y), x < (x2 - x1) * (y - y1) / F.when(y1 != y2, y2 - y1) + x1).otherwise(False)
    sums = met.select("_point", "_area", on.alias("on"), crossing.cast("int").alias("crosses")).groupBy("_point", "_area").agg(
        F.max("on").alias("on"), F.sum("crosses").alias("crosses"))
    return sums.where(~F.col("on") & (F.col("crosses") % 2 == 1)).select("_point", "_area")


def _fits(outer: Column, box: Column) -> Column:
    return (outer.xmin <= box.xmin) & (outer.ymin <= box.ymin) & (outer.xmax >= box.xmax) & (outer.ymax >= box.ymax)


def containment_join(containers: DataFrame, probes: DataFrame, container_cols: list[str], probe_cols: list[str],
                     geometry: str = "geometry", container_box: str | None = None, probe_box: str | None = None,
                     few_probes: bool = False, keep_geometry: bool = False) -> DataFrame:
    """Pairs where the container's geometry contains the probe's, with ``relation``.

    ``relation`` is ``contains``, or ``unsupported`` where the boxes allow
    containment but the pair of types cannot be decided; it is never silently
    dropped. Points in polygons are decided natively, against the segments of their slab
    where the polygon is large; other pairs in Arrow batches. Copies of a geometry are decided once: the pairs of
    distinct ones are joined to the rows that have them. A container or a probe with a coordinate without end comes out once, alone (the other side null), as
    ``unsupported``; one without any box is in no pair. ``few_probes`` promises a probe
    table of bounded size (a sample): if it is, it is broadcast, which spares the
    containers their shuffle, and with ``container_box`` its extent reaches their scan. ``container_cols``
    and ``probe_cols`` must not overlap, and may have any names; ``probe_cols`` must identify a probe.
    """
    if few_probes:
        return _containment_pairs(containers, probes, container_cols, probe_cols, geometry, container_box, probe_box,
                                  True, keep_geometry)
    held = _by_shape(containers, container_cols, "_held", "_outer_key", geometry, container_box)
    sought = _by_shape(probes, probe_cols, "_sought", "_inner_key", geometry, probe_box)
    pairs = _containment_pairs(_shapes(held, "_held", "_outer_key"), _shapes(sought, "_sought", "_inner_key"), ["_outer_key"], ["_inner_key"],
                               "_geometry", "_place" if container_box else None, "_place" if probe_box else None,
                               False, keep_geometry)
    pairs = _with_rows(_with_rows(pairs, sought, "_sought", "_inner_key"), held, "_held", "_outer_key")
    return pairs.select(*_unpacked(container_cols, "_held"), *_unpacked(probe_cols, "_sought"), "relation",
                        *(["container_geometry", "probe_geometry"] if keep_geometry else []))


def _by_shape(df: DataFrame, columns: list[str], name: str, key: str, geometry: str, box: str | None) -> DataFrame:
    """Rows packed as ``name``, with ``_geometry``, the stored box ``_place`` if there is one, and a ``key`` of both."""
    shape = geom_key(F.col(geometry))
    return df.select(_packed(columns, name), F.col(geometry).alias("_geometry"), *([F.col(box).alias("_place")] if box else []),
                     (F.struct(shape.alias("shape"), F.col(box).alias("box")) if box else shape).alias(key))


def _shapes(df: DataFrame, name: str, key: str) -> DataFrame:
    """The distinct geometries of a table ``_by_shape``."""
    return df.drop(name).where(F.col(key).isNotNull()).dropDuplicates([key])


def _with_rows(pairs: DataFrame, df: DataFrame, name: str, key: str) -> DataFrame:
    """Pairs of shapes with the rows that have them; a null side stays null, as one row has the null key.

    Few pairs may grow to very many here, so neither side is broadcast: the tasks that scan a small table would do all of it.
    """
    rows = df.select(name, F.col(key).alias("_shape")).where("_shape is not null")
    nothing = df.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema))
    return pairs.join(rows.unionByName(nothing).hint("merge"), F.col(key).eqNullSafe(F.col("_shape"))).drop(key, "_shape")


def _containment_pairs(containers: DataFrame, probes: DataFrame, container_cols: list[str], probe_cols: list[str],
                       geometry: str, container_box: str | None, probe_box: str | None,
                       few_probes: bool, keep_geometry: bool) -> DataFrame:
    """``containment_join`` row by row, every pair for itself."""
    held = containers.select(_packed(container_cols, "_held"), F.col(geometry).alias("_outer"),
                             *([F.col(container_box).alias("_stored")] if container_box else []))
    sought = probes.select(_packed(probe_cols, "_sought"), F.col(geometry).alias("_inner"),
                           *([F.col(probe_box).alias("_stored")] if probe_box else []))
    sought = _framed(sought, "_inner", "_stored" if probe_box else None, edges=False).drop("_stored")
    if few_probes:  # a promise that is checked
        sought = write_through(sought, "probes")
        reach = sought.agg(F.count("*").alias("n"), *(f("_box." + c).alias(c) for f, c in (
            (F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))), F.coalesce(F.sum(F.octet_length("_inner")), F.lit(0)).alias("bytes")).first()
        few_probes = reach["n"] <= FEW_PROBES and reach["bytes"] <= FEW_BYTES
        if container_box and reach["n"]:  # literals over the stored box reach the row groups
            stored = F.col("_stored")
            held = held.where((stored.xmin <= reach["xmax"]) & (stored.xmax >= reach["xmin"])
                              & (stored.ymin <= reach["ymax"]) & (stored.ymax >= reach["ymin"]))
    if not container_box:  # both the levels and the join need the boxes
        held = _framed(held, "_outer", None, edges=False).withColumnRenamed("_box", "_stored")
        held = held if few_probes else write_through(held, "boxes")  # few probes are not worth a copy of the containers
    levels, large = _levels(held)
    held = _framed(held, "_outer", "_stored", edges=not few_probes)
    in_large = None
    if large and not few_probes:
        areas = write_through(held.where(_is_large()).select(
            "_held", "_outer", "_box", "_edges", F.monotonically_increasing_id().alias("_area")), "large")
        points = write_through(sought.where(is_point(F.col("_inner"))).select(
            "_sought", "_inner", "_box", F.monotonically_increasing_id().alias("_point")), "points")
        in_large = skew_join(skew_join(points_in_slabs(points, areas, levels), points.drop("_box"), ["_point"], "inner"),
                             areas.select("_held", *(["_outer"] if keep_geometry else []), "_area"), ["_area"], "inner")
        held = held.withColumn("_large", _is_large()).withColumn("_edges", F.when(~F.col("_large"), F.col("_edges")))
    else:
        held = held.withColumn("_large", F.lit(False))
    if few_probes:  # few candidates remain, so decoding every container would cost more than it saves
        held = held.withColumn("_edges", F.lit(None).cast(EDGES_TYPE))
    held = held.drop("_stored", "_turn")
    held = _with_placeholder(container_cells(held), LOST_PROBES).withColumnRenamed("_box", "_outer_box")
    sought = _with_placeholder(probe_cells(sought, levels), LOST_CONTAINERS)
    if few_probes:
        pairs = held.join(F.broadcast(sought), _KEYS)
    else:
        pairs = skew_join(sought, held, _KEYS, "inner")
    box, edges, lost = F.col("_box"), F.col("_edges"), F.col("_level") <= LOST_PROBES
    point, outer_point = is_point(F.col("_inner")), is_point(F.col("_outer"))
    decided = point & (outer_point | edges.isNotNull())
    native = F.when(outer_point, F.col("_outer") == F.col("_inner")).otherwise(
        point_in_edges(box.xmin, box.ymin, edges))
    # One condition of the join, cheapest test first; pairs it decides need no second look.
    test = F.when(decided, native).otherwise(~(point & F.coalesce("_large", F.lit(False))))  # large ones meet points elsewhere
    pairs = pairs.where(F.when(lost, F.lit(True)).when(_fits(F.col("_outer_box"), box), test).otherwise(F.lit(False)))
    pairs = pairs.withColumn("_decided", F.coalesce(decided, F.lit(False)))
    # Decided pairs travel to Python as nulls.
    pairs = pairs.withColumn("_exact", once(geom_contains)(
        F.when(~F.col("_decided"), F.col("_outer")), F.when(~F.col("_decided"), F.col("_inner"))))
    relation = (F.when(F.col("_decided") | F.col("_exact"), "contains")
                .when(F.col("_exact").isNull(), "unsupported"))
    kept = [F.col("_outer").alias("container_geometry"), F.col("_inner").alias("probe_geometry")]
    pairs = pairs.withColumn("_relation", relation).where(F.col("_relation").isNotNull())
    shown = [*_unpacked(container_cols, "_held"), *_unpacked(probe_cols, "_sought"), F.col("_relation").alias("relation"),
             *(kept if keep_geometry else [])]
    if in_large is None:
        return pairs.select(*shown)
    return pairs.select(*shown).unionAll(in_large.withColumn("_relation", F.lit("contains")).select(*shown))


def contained(probes: DataFrame, containers: DataFrame, probe_cols: list[str], geometry: str = "geometry",
              container_box: str | None = None) -> DataFrame:
    """``probe_cols, relation`` of the probes that some container contains, or of which that cannot be decided.

    A semi join that stops at a probe's first container settles points and, in convex containers without holes, areas,
    without leaving the JVM; so it makes no pairs, however many containers a probe has. Only the probes left meet the
    containers whose boxes fit, whose pairs are decided in Arrow batches. One without end, or in reach of nothing but
    types that cannot be decided, is ``unsupported``; a probe without a box is in no container.
    """
    held = containers.select(F.col(geometry).alias("_outer"), *([F.col(container_box).alias("_stored")] if container_box else []))
    if not container_box:
        held = write_through(_framed(held, "_outer", None, edges=False).withColumnRenamed("_box", "_stored"), "boxes")
    levels, large = _levels(held)
    held = _framed(held.where(~F.coalesce(endless(F.col("_stored")), F.lit(False))), "_outer", "_stored", edges=True).drop("_stored")
    areas = None
    if large:
        areas = write_through(held.where(_is_large()).select(
            "_box", "_edges", F.monotonically_increasing_id().alias("_area")), "large")
        held = held.withColumn("_large", _is_large()).withColumn("_edges", F.when(~F.col("_large"), F.col("_edges")))
        held = held.withColumn("_turn", F.when(F.col("_large"), 0).otherwise(F.col("_turn")))
    else:
        held = held.withColumn("_large", F.lit(False))
    held = container_cells(held).withColumnRenamed("_box", "_outer_box")
    sought = probes.select(_packed(probe_cols, "_sought"), F.col(geometry).alias("_inner"), F.monotonically_increasing_id().alias("_id"))
    sought = _framed(sought, "_inner", None, edges=True).withColumnRenamed("_edges", "_walls").drop("_turn")
    sought = write_through(sought, "probes")  # read three times

    box, edges, walls, turn = F.col("_box"), F.col("_edges"), F.col("_walls"), F.col("_turn")
    point, outer_point = is_point(F.col("_inner")), is_point(F.col("_outer"))
    settled = point & (outer_point | edges.isNotNull())
    in_point = F.when(outer_point, F.col("_outer") == F.col("_inner")).otherwise(point_in_edges(box.xmin, box.ymin, edges))
    solid = double_area(walls, box) > SOLID * (box.xmax - box.xmin) * (box.ymax - box.ymin)
    in_convex = (turn != 0) & (F.size(walls) > 0) & solid & vertices_in_convex("_walls", "_edges", turn)
    native = F.when(_fits(F.col("_outer_box"), box), F.when(settled, in_point).otherwise(F.coalesce(in_convex, F.lit(False)))).otherwise(F.lit(False))
    found = skew_join(probe_cells(sought, levels), held, _KEYS, "left_semi", condition=native).select("_id")
    if areas is not None:
        points = sought.where(point).select(F.col("_id").alias("_point"), "_box")
        found = found.unionAll(points_in_slabs(points, areas, levels).select("_point"))
    found = write_through(found.distinct(), "contained")
    rest = skew_join(sought, found, ["_id"], "left_anti")
    pairs = skew_join(probe_cells(rest.drop("_walls"), levels), held.drop("_turn"), _KEYS, "inner")
    pairs = pairs.where(_fits(F.col("_outer_box"), box) & ~F.coalesce(settled | (point & F.col("_large")), F.lit(False)))
    pairs = pairs.select("_id", once(geom_contains)("_outer", "_inner").alias("_exact"))
    lost = rest.where(endless(F.col("_box"))).select("_id", F.lit(None).cast("boolean").alias("_exact"))
    best = pairs.where("_exact or _exact is null").unionByName(lost).groupBy("_id").agg(F.max("_exact").alias("_exact"))
    best = best.unionByName(found.withColumn("_exact", F.lit(True)))
    relation = F.when(F.col("_exact"), "contains").otherwise("unsupported")
    return skew_join(sought.select("_id", "_sought"), best, ["_id"], "inner").select(
        *_unpacked(probe_cols, "_sought"), relation.alias("relation"))


def containing_rows(df: DataFrame, probe: bytes, columns: list[str], geometry: str = "geometry",
                    box: str | None = None) -> DataFrame:
    """Rows whose geometry contains one given geometry; a stored box prunes row groups first.

    Where a box without end, or a collection, leaves it open, ``relation`` is ``unsupported``.
    """
    corner = bbox_batch(pa.array([probe], pa.binary()))[0].as_py()
    if corner is None:
        return df.select(*columns, F.lit("contains").alias("relation")).where(F.lit(False))
    rows = df.select(_packed(columns, "_held"), F.col(geometry).alias("_outer"), (F.col(box) if box else once(geom_bbox)(geometry)).alias("_box"))
    outer = F.col("_box")
    rows = rows.where((outer.xmin <= corner["xmin"]) & (outer.ymin <= corner["ymin"])
                      & (outer.xmax >= corner["xmax"]) & (outer.ymax >= corner["ymax"]))
    rows = rows.withColumn("_exact", F.when(~endless(outer), once(geom_contains)("_outer", F.lit(probe))))
    relation = F.when(F.col("_exact"), "contains").when(F.col("_exact").isNull(), "unsupported")
    rows = rows.withColumn("_relation", relation).where(F.col("_relation").isNotNull())
    return rows.select(*_unpacked(columns, "_held"), F.col("_relation").alias("relation"))


def _traced(df: DataFrame, geometry: str, tolerance: float) -> DataFrame:
    """Distinct geometries: key, structure, snapped vertices, vertices."""
    df = with_key(df.select(geometry).where(F.col(geometry).isNotNull()).distinct(), geometry)
    df = df.withColumn("_snap", snap_frame(geometry, tolerance)).where(F.col("_snap").isNotNull())
    return df.select(KEY, F.col("_snap.structure").alias("_structure"), F.col("_snap.snapped").alias("_snapped"),
                     F.col("_snap.xy").alias("_xy"))


def near_containers(probes: DataFrame, containers: DataFrame, key: str, tolerance: float, geometry: str = "geometry") -> DataFrame:
    """``key`` of the probes that a container contains which is equal within ``tolerance``, vertex by vertex.

    Candidates have the same structure and first vertices in reach, as in ``near_copies``; only pairs that are close in all
    vertices are tested for containment. Plain points are left out: they contain only equal ones. Copies of a geometry on
    one side should be one row.
    """
    reach, size = 1.001 * tolerance, 4 * tolerance

    def at(value: Column) -> Column:
        return F.floor(value / size)

    def traced(df: DataFrame, *columns: Column) -> DataFrame:
        df = df.where(~is_point(F.col(geometry))).select(*columns, F.col(geometry).alias("_geometry"))
        df = df.withColumn("_snap", snap_frame("_geometry", tolerance)).where("size(_snap.xy) > 0")
        return df.select("*", F.col("_snap.structure").alias("_structure"), F.col("_snap.xy").alias("_xy"),
                         F.get("_snap.xy", F.lit(0)).alias("_start")).drop("_snap")

    start = F.col("_start")
    ours = traced(probes, F.col(key).alias("_key")).withColumn("_cx", at(start.x)).withColumn("_cy", at(start.y)).drop("_start")
    theirs = (traced(containers).withColumn("_cx", F.explode(F.sequence(at(start.x - reach), at(start.x + reach))))
              .withColumn("_cy", F.explode(F.sequence(at(start.y - reach), at(start.y + reach))))
              .select("_structure", "_cx", "_cy", F.col("_xy").alias("_other"), F.col("_geometry").alias("_outer")))
    close = F.forall(F.zip_with("_xy", "_other", lambda a, b: F.hypot(a.x - b.x, a.y - b.y) <= tolerance), lambda near: near)
    pairs = skew_join(ours, theirs, ["_structure", "_cx", "_cy"], "inner", condition=close)
    pairs = pairs.select("_key", once(geom_contains)("_outer", "_geometry").alias("_exact")).where("_exact")
    return pairs.select(F.col("_key").alias(key)).distinct()


def near_copies(left: DataFrame, right: DataFrame, tolerance: float, geometry: str = "geometry") -> DataFrame:
    """Left rows for which the right holds a geometry equal within ``tolerance``, vertex by vertex.

    Both sides shrink to distinct geometries first. Geometries with the same
    snapped vertices match without a comparison, which settles dense groups. For
    the rest, first vertices of near copies differ by at most the tolerance: each
    right one is filed under the cells within that distance, each left one is
    looked up once, and a semi join stops at its first partner.
    """
    reach, size = 1.001 * tolerance, 4 * tolerance

    def at(value: Column) -> Column:
        return F.floor(value / size)

    # Each is read more than once below.
    ours = write_through(_traced(left, geometry, tolerance), "traced")
    theirs = write_through(_traced(right, geometry, tolerance), "traced")
    snapped = theirs.select("_structure", "_snapped").distinct().withColumn("_sure", F.lit(True))
    ours = skew_join(ours, snapped, ["_structure", "_snapped"], "left")
    ours = write_through(ours.drop("_snapped"), "settled")
    sure = ours.where("_sure").select(KEY)
    start = F.get("_xy", F.lit(0))
    open_ones = (ours.where("_sure is null and size(_xy) > 0")
                 .withColumn("_cx", at(start.x)).withColumn("_cy", at(start.y))
                 .select(KEY, "_structure", "_cx", "_cy", "_xy"))
    filed = (theirs.where("size(_xy) > 0")
             .withColumn("_cx", F.explode(F.sequence(at(start.x - reach), at(start.x + reach))))
             .withColumn("_cy", F.explode(F.sequence(at(start.y - reach), at(start.y + reach))))
             .select("_structure", "_cx", "_cy", F.col("_xy").alias("_other")))
    close = F.forall(F.zip_with("_xy", "_other", lambda a, b: F.hypot(a.x - b.x, a.y - b.y) <= tolerance),
                     lambda near: near)
    compared = skew_join(open_ones, filed, ["_structure", "_cx", "_cy"], "left_semi", condition=close)
    found = sure.unionByName(compared.select(KEY))
    left, key = keyed(left, geometry)
    return skew_join(left, found.withColumnRenamed(KEY, key), [key], "left_semi").drop(key)
