"""Geometry columns: Arrow-batched codecs and native expressions over them.

The stored form is little-endian ISO WKB with -0.0 written as 0.0, so equal
geometries have equal bytes and joins, grouping and dedupe stay in the JVM.
Batches made of plain points take a path of their own, and lines, polygons and
multi types of two dimensions are worked on as arrays (``strandline.functions.arrays``);
what is left, collections and other flavours, goes through ``codec`` value by value.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import arrays, codec, contain, predicates



def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


# Types are objects, not DDL text: executors import this module, and text needs a session to parse.
BBOX_TYPE = _doubles("xmin", "ymin", "xmax", "ymax")
EDGE_NAMES = ("x1", "y1", "x2", "y2")
EDGES_TYPE = T.ArrayType(_doubles(*EDGE_NAMES))
SNAP_TYPE = T.StructType([
    T.StructField("structure", T.BinaryType()), T.StructField("snapped", T.BinaryType()),
    T.StructField("xy", T.ArrayType(_doubles("x", "y")))])
FRAME_TYPE = T.StructType([
    T.StructField("box", BBOX_TYPE), T.StructField("edges", EDGES_TYPE), T.StructField("turn", T.IntegerType())])
PARTS_TYPE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("rings", T.ArrayType(T.ArrayType(_doubles("x", "y"))))])
# A WKB point is byte order, type number and two doubles.
_POINT_DTYPE = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
_POINT_TEXT = r"^\s*POINT\s*\(\s*(?P<x>[-+0-9.eE]+)\s+(?P<y>[-+0-9.eE]+)\s*\)\s*$"
# Geometries up to this many bytes are their own join key; longer ones use a digest.
KEY_BYTES = 64


# ---------------------------------------------------------------- batch helpers

def _points(wkb: pa.Array):
    """Coordinates of a batch of plain little-endian points, or None for any other batch."""
    if isinstance(wkb, pa.ChunkedArray):
        wkb = wkb.combine_chunks()
    if wkb.null_count or not len(wkb):
        return None
    size = _POINT_DTYPE.itemsize
    spread = pc.min_max(pc.binary_length(wkb)).as_py()
    if spread["min"] != size or spread["max"] != size:
        return None
    fixed = wkb.cast(pa.binary(size))
    raw = np.frombuffer(fixed.buffers()[1], _POINT_DTYPE, len(fixed), fixed.offset * size)
    plain = (raw["order"] == 1).all() and (raw["kind"] == codec.POINT).all()
    return raw if plain and not np.isnan(raw["x"]).any() else None


def _point_column(x: np.ndarray, y: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    raw = np.empty(len(x), _POINT_DTYPE)
    raw["order"], raw["kind"] = 1, codec.POINT
    raw["x"], raw["y"] = x + 0.0, y + 0.0
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(_POINT_DTYPE.itemsize), len(x), [None, pa.py_buffer(raw.tobytes())])
    out = fixed.cast(pa.binary())
    return out if valid is None else pc.if_else(pa.array(valid), out, pa.scalar(None, pa.binary()))


def wkb_from_wkt(text: str) -> bytes:
    """Stored form of one geometry, for literals."""
    return codec.encode_wkb(codec.decode_wkt(text))


def _try(fn, value):
    """``fn(value)``, or None for a null or malformed value."""
    if value is None:
        return None
    try:
        return fn(value)
    except ValueError:
        return None


def _map_geoms(wkb: pa.Array, fn, arrow_type: pa.DataType) -> pa.Array:
    return pa.array([_try(lambda b: fn(codec.decode_wkb(b)), b) for b in wkb.to_pylist()], arrow_type)


def wkb_batch_from_wkt(text: pa.Array) -> pa.Array:
    """WKB of a batch of WKT texts; null where a text is null or malformed."""
    point = pc.extract_regex(text, _POINT_TEXT)
    if point.null_count == text.null_count and len(text):
        try:
            x, y = (pc.cast(pc.struct_field(point, i), pa.float64()).fill_null(0.0).to_numpy() for i in (0, 1))
            return _point_column(x, y, point.is_valid().to_numpy(zero_copy_only=False))
        except pa.ArrowInvalid:
            pass  # some text only looks like a number
    made, done = arrays.from_texts(text)
    return arrays.with_others(made, done, text, lambda rest: pa.array(
        [_try(lambda t: codec.encode_wkb(codec.decode_wkt(t)), t) for t in rest.to_pylist()], pa.binary()))


# ---------------------------------------------------------------- codecs

@F.arrow_udf(T.StringType())
def geom_to_wkt(wkb: pa.Array) -> pa.Array:
    """Geometry as WKT text; null for null or malformed input."""
    points = _points(wkb)
    if points is not None:
        return pa.array([f"POINT ({codec.number(x)} {codec.number(y)})"
                         for x, y in zip(points["x"].tolist(), points["y"].tolist())], pa.string())
    fast = arrays.texts(arrays.layout(wkb))
    return arrays.with_others(fast, fast.is_valid().to_numpy(zero_copy_only=False), wkb,
                              lambda rest: _map_geoms(rest, codec.encode_wkt, pa.string()))


@F.arrow_udf(T.BinaryType())
def wkt_to_geom(text: pa.Array) -> pa.Array:
    """WKT text as geometry; null for null or malformed input."""
    return wkb_batch_from_wkt(text)


@F.arrow_udf(T.BinaryType())
def canonical_wkb(wkb: pa.Array) -> pa.Array:
    """Any WKB flavour in the stored form; null for null or malformed input."""
    points = _points(wkb)
    if points is not None:
        return _point_column(points["x"], points["y"])
    found = arrays.layout(wkb)
    return arrays.with_others(found.with_coordinates(found.coordinates()), found.ok, wkb,
                              lambda rest: _map_geoms(rest, codec.encode_wkb, pa.binary()))


def _decoded(wkb: pa.Array) -> list:
    """Geometry per value, None for null or malformed."""
    return [_try(codec.decode_wkb, b) for b in wkb.to_pylist()]


def _nested(lengths: list[int | None], values: pa.Array) -> pa.Array:
    """List array over flat values; a length of None is a null list."""
    ends = np.cumsum([0] + [n or 0 for n in lengths])
    nulls = pa.array([n is None for n in lengths], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=nulls)


def _structs(rows: np.ndarray, names: tuple[str, ...]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names)


def _stack(parts: list[np.ndarray], width: int) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty((0, width))


@F.arrow_udf(PARTS_TYPE)
def geom_parts(wkb: pa.Array) -> pa.Array:
    """Type name and coordinate arrays of a geometry."""
    return parts_batch(wkb)


def parts_batch(wkb: pa.Array) -> pa.Array:
    found = arrays.layout(wkb)
    whole = found.ok & (found.per_row() > 0)
    # a multipoint is one array, though its points are runs of their own
    alone = found.kind[found.row] != codec.MULTIPOINT
    heads = np.flatnonzero(alone | (np.diff(found.row, prepend=-1) != 0))
    counts = np.add.reduceat(found.count, heads) if len(heads) else np.zeros(0, np.int64)
    rings = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), _structs(found.coordinates(), ("x", "y")))
    per_row = np.bincount(found.row[heads], minlength=len(whole))
    per_geom = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_row)], pa.int32()), rings)
    kinds = pa.array([codec.TYPE_NAMES.get(int(k), "") for k in found.kind], pa.string())
    fast = pa.StructArray.from_arrays([kinds, per_geom], ["kind", "rings"], mask=pa.array(~whole))
    return arrays.with_others(fast, whole, wkb, _parts)


def _parts(wkb: pa.Array) -> pa.Array:
    geoms = _decoded(wkb)
    paths = [None if g is None else codec.rings(g) for g in geoms]
    flat = [r[:, :2] for rings in paths if rings for r in rings]
    rings = _nested([len(r) for r in flat], _structs(_stack(flat, 2), ("x", "y")))
    per_geom = _nested([None if r is None else len(r) for r in paths], rings)
    kinds = pa.array([None if g is None else codec.TYPE_NAMES[g[0]] for g in geoms], pa.string())
    return pa.StructArray.from_arrays([kinds, per_geom], ["kind", "rings"], mask=kinds.is_null())


@F.arrow_udf(BBOX_TYPE)
def geom_bbox(wkb: pa.Array) -> pa.Array:
    """Bounding box; null for null, malformed or empty geometry."""
    return bbox_batch(wkb)


def bbox_batch(wkb: pa.Array) -> pa.Array:
    points = _points(wkb)
    if points is not None:
        return _structs(np.column_stack([points["x"], points["y"]] * 2), BBOX_TYPE.names)
    found = arrays.layout(wkb)
    return arrays.with_others(_box_column(found.boxes()), found.ok, wkb, lambda rest: _boxes(_decoded(rest)))


def _box_column(rows: np.ndarray) -> pa.Array:
    columns = [pa.array(np.ascontiguousarray(c)) for c in rows.T]
    return pa.StructArray.from_arrays(columns, BBOX_TYPE.names, mask=pa.array(np.isnan(rows[:, 0])))


def _boxes(geoms: list) -> pa.Array:
    rows = np.full((len(geoms), 4), np.nan)
    for i, geom in enumerate(geoms):
        xy = [r[:, :2] for r in codec.rings(geom) if len(r)] if geom is not None else []
        if xy:
            xy = np.concatenate(xy) if len(xy) > 1 else xy[0]
            rows[i, :2], rows[i, 2:] = xy.min(axis=0), xy.max(axis=0)
    return _box_column(rows)


@F.arrow_udf(FRAME_TYPE)
def geom_frame(wkb: pa.Array) -> pa.Array:
    """Bounding box, the boundary segments of a polygon or multipolygon (null for other types), and 1 or -1 for a convex
    polygon without holes whose boundary runs left or right (0 for all others)."""
    points = _points(wkb)
    if points is not None:
        edges = _nested([None] * len(wkb), _structs(np.empty((0, 4)), EDGE_NAMES))
        return pa.StructArray.from_arrays([bbox_batch(wkb), edges, _turns(np.zeros(len(wkb)))], FRAME_TYPE.names)
    found = arrays.layout(wkb)
    if found.ok.all():
        segments, counts = found.edges()
        area = np.isin(found.kind, predicates.AREAS)
        keep = np.repeat(area, counts)
        edges = _nested([int(n) if a else None for n, a in zip(counts, area, strict=True)], _structs(segments[keep], EDGE_NAMES))
        turn = _turns(arrays.turns(found, segments, counts))
        return pa.StructArray.from_arrays([_box_column(found.boxes()), edges, turn], FRAME_TYPE.names)
    geoms = _decoded(wkb)
    walls = [predicates.edges(g) if g is not None and g[0] in predicates.AREAS else None for g in geoms]
    flat = _structs(_stack([w for w in walls if w is not None], 4), EDGE_NAMES)
    edges = _nested([None if w is None else len(w) for w in walls], flat)
    return pa.StructArray.from_arrays([_boxes(geoms), edges, _turns(np.zeros(len(geoms)))], FRAME_TYPE.names)


def _turns(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _pairwise(left: pa.Array, right: pa.Array, fn, arrow_type) -> pa.Array:
    known: dict = {}

    def geom(data):
        if data not in known:
            known[data] = codec.decode_wkb(data)
        return known[data]
    out = [None if a is None or b is None else _try(lambda p: fn(geom(p[0]), geom(p[1])), (a, b))
           for a, b in zip(left.to_pylist(), right.to_pylist())]
    return pa.array(out, arrow_type)


@F.arrow_udf(T.BooleanType())
def geom_contains(outer: pa.Array, inner: pa.Array) -> pa.Array:
    """Whether ``outer`` contains ``inner``; null where the types are not supported."""
    held, done = contain.contains_batch(outer, inner)
    if done.all():
        return pa.array(held, pa.bool_())
    rest = pa.array(~done)
    slow = _pairwise(outer.filter(rest), inner.filter(rest), predicates.contains, pa.bool_())
    return pc.replace_with_mask(pa.array(held, pa.bool_()), rest, slow)


def geom_equals_within(left, right, tolerance: float) -> Column:
    """Whether two geometries agree vertex by vertex within ``tolerance``."""
    @F.arrow_udf(T.BooleanType())
    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        p, q = _points(a), _points(b)
        if p is not None and q is not None:
            return pa.array(np.hypot(p["x"] - q["x"], p["y"] - q["y"]) <= tolerance)
        return _pairwise(a, b, lambda g, h: predicates.equals_within(g, h, tolerance), pa.bool_())
    return compare(left, right)


def snap_frame(geom, tolerance: float) -> Column:
    """Structure, snapped vertices and vertices of a geometry, for finding near copies.

    Vertices are snapped to squares of half the tolerance, so two vertices in the
    same square lie within it. ``structure`` and ``snapped`` are short binaries that
    agree exactly where the type with its path lengths, or all squares, agree: the
    values themselves up to KEY_BYTES, a SHA-256 beyond.
    """
    @F.arrow_udf(SNAP_TYPE)
    def frame(wkb: pa.Array) -> pa.Array:
        points = _points(wkb)
        if points is not None:
            xy = np.column_stack([points["x"], points["y"]])
            squares = np.floor(xy * (2 / tolerance)).astype("<f8") + 0.0
            snapped = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(16), len(xy), [None, pa.py_buffer(squares.tobytes())]).cast(pa.binary())
            same = pa.array([_short(_structure((codec.POINT, "", xy[:1])))] * len(xy), pa.binary())
            return pa.StructArray.from_arrays(
                [same, snapped, _nested([1] * len(xy), _structs(xy, ("x", "y")))], SNAP_TYPE.names)
        structures, snapped, paths = [], [], []
        for geom in _decoded(wkb):
            if geom is None:
                structures.append(None), snapped.append(None), paths.append(None)
                continue
            xy = [r[:, :2] for r in codec.rings(geom)]
            flat = _stack(xy, 2)
            structures.append(_short(_structure(geom)))
            snapped.append(_short((np.floor(flat * (2 / tolerance)).astype("<f8") + 0.0).tobytes()))
            paths.append(flat)
        vertices = _nested([None if p is None else len(p) for p in paths],
                           _structs(_stack([p for p in paths if p is not None], 2), ("x", "y")))
        return pa.StructArray.from_arrays(
            [pa.array(structures, pa.binary()), pa.array(snapped, pa.binary()), vertices], SNAP_TYPE.names,
            mask=pa.array([p is None for p in paths], pa.bool_()))
    return once(frame)(geom)


def _structure(geom) -> bytes:
    """Type, dimensions and lengths of all parts of a geometry."""
    kind, dims, body = geom
    head = bytes([kind, codec.DIM_SUFFIXES.index(dims)])
    if kind == codec.COLLECTION:
        return head + b"(" + b"".join(_structure(g) for g in body) + b")"
    if kind == codec.MULTIPOLYGON:
        return head + repr([[len(r) for r in polygon] for polygon in body]).encode()
    return head + repr([len(r) for r in codec.rings(geom)]).encode()


def _short(data: bytes) -> bytes:
    return data if len(data) <= KEY_BYTES else b"#" + hashlib.sha256(data).digest()


def once(udf):
    """A codec for use inside an operator that filters on its result.

    Declared nondeterministic, so the optimizer neither repeats the call in a
    filter below it nor merges it into several expressions.
    """
    return udf.asNondeterministic()


# ---------------------------------------------------------------- native expressions

def geom_to_wkb(geom: Column) -> Column:
    """The stored form already is WKB, and null stays null."""
    return geom


def geom_key(geom: Column) -> Column:
    """Join key of a stored geometry: its bytes, or a marked SHA-256 when longer than KEY_BYTES.

    Stored WKB starts with 01, so a digest marked FF never meets plain bytes, and
    no key is longer than KEY_BYTES.
    """
    digest = F.concat(F.unhex(F.lit("FF")), F.unhex(F.sha2(geom, 256)))
    return F.when(F.octet_length(geom) <= KEY_BYTES, geom).otherwise(digest)


def normalise_mixed(binary: Column, text: Column) -> tuple[Column, Column]:
    """One geometry from a WKB and a WKT column, and why a value was rejected."""
    geom = F.coalesce(canonical_wkb(binary), wkt_to_geom(text))
    reason = F.when(geom.isNull() & (binary.isNotNull() | text.isNotNull()), F.lit("invalid_geometry"))
    return geom, reason


def point_in_edges(x: Column, y: Column, edges: Column) -> Column:
    """Whether a point lies strictly inside the area bounded by ``edges``."""
    def on_edge(e):
        cross = (x - e.x1) * (e.y2 - e.y1) - (y - e.y1) * (e.x2 - e.x1)
        return ((cross == 0) & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
                & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)))

    def crosses(e):
        slope = F.when(e.y1 != e.y2, (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1)
        return ((e.y1 > y) != (e.y2 > y)) & (x < slope)

    odd = F.size(F.filter(edges, crosses)) % 2 == 1
    return ~F.exists(edges, on_edge) & odd


def vertices_in_convex(vertices, edges, turn: Column) -> Column:
    """Whether the starts of all segments ``vertices`` lie in the closed convex area bounded by ``edges``."""
    def holds(v):
        return F.forall(edges, lambda w: turn * ((w.x2 - w.x1) * (v.y1 - w.y1) - (w.y2 - w.y1) * (v.x1 - w.x1)) >= 0)
    return F.forall(vertices, holds)


def double_area(edges, box: Column) -> Column:
    """Twice the area between boundary segments, parts against each other taken off; measured from the box's corner."""
    x, y = box.xmin, box.ymin
    return F.abs(F.aggregate(edges, F.lit(0.0), lambda total, e: total + (e.x1 - x) * (e.y2 - y) - (e.x2 - x) * (e.y1 - y)))


def is_collection(geom: Column) -> Column:
    """Whether a stored geometry is a collection, by its type number."""
    return F.hex(F.substring(geom, 2, 2)).isin(*(format(codec.COLLECTION + d, "04X")[2:] + format(codec.COLLECTION + d, "04X")[:2]
                                                 for d in (0, 1000, 2000, 3000)))


def set_crs(df: DataFrame, srid: int, column: str = "geometry") -> DataFrame:
    """Declare the CRS of a geometry column; coordinates stay as they are."""
    return df.withMetadata(column, {"srid": srid})


def crs_of(df: DataFrame, column: str = "geometry") -> int | None:
    return df.schema[column].metadata.get("srid")
