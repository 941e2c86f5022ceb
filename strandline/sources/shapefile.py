"""Distributed shapefile ingest.

A manifest of files becomes a manifest of record ranges; each task opens its
ranges and yields Arrow batches. ``.shx`` entries and ``.dbf`` records have a fixed
length, so a range is found by arithmetic and one large file feeds many tasks.
Bad files and records become rows with ``_error`` instead of a failed job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import codec, crs, predicates
from strandline.functions.align import aligned_type
from strandline.functions.geometry import BBOX_TYPE, _point_column, bbox_batch
from strandline.session import write_through
from strandline.sources.datasets import spread
from strandline.sources.files import resolve

# Fixed values of the public shapefile and dBASE descriptions.
HEADER_BYTES, INDEX_BYTES, FILE_CODE = 100, 8, 9994
BOX_IN_HEADER = (36, 32)  # place and bytes of xmin, ymin, xmax, ymax
NULL_SHAPE = 0
POINT_SHAPES, MULTIPOINT_SHAPES = (1, 11, 21), (8, 18, 28)
LINE_SHAPES, AREA_SHAPES = (3, 13, 23), (5, 15, 25)
Z_SHAPES = (11, 13, 15, 18)
DBF_FIELD_BYTES, DBF_END = 32, 0x0D
INT_DIGITS, LONG_DIGITS = 9, 18

# Arrow types of the column types an attribute can be read as.
ARROW_TYPES = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(),
    "double": pa.float64(), "date": pa.date32(), "boolean": pa.bool_(),
}
RECORDS_PER_BATCH = 4096
BYTES_PER_BATCH = 16 * 1024 * 1024
RANGE_BYTES = 64 * 1024 * 1024
HEADER_SCHEMA = ("path string, file_name string, n_records bigint, shp_bytes bigint, srid int, reason string, "
                 "ordinal int, column_name string, data_type string")


class BadFile(ValueError):
    """A file that cannot be read; the message is the quarantine reason."""


# ---------------------------------------------------------------- one file

def _sibling(path: str, suffix: str) -> str:
    return path[:-4] + suffix


def _size(path: str) -> int | None:
    fs, local = resolve(path)
    info = fs.get_file_info(local)
    return info.size if info.is_file else None


def _read(path: str, start: int = 0, length: int | None = None) -> bytes:
    fs, local = resolve(path)
    with fs.open_input_file(local) as handle:
        handle.seek(start)
        return handle.read() if length is None else handle.read(length)


def _dbf_type(kind: str, length: int, decimals: int) -> str:
    if kind == "N" and not decimals:
        return "int" if length <= INT_DIGITS else "bigint" if length <= LONG_DIGITS else "double"
    return {"N": "double", "F": "double", "D": "date", "L": "boolean"}.get(kind, "string")


def dbf_layout(path: str):
    """(n_records, header bytes, record bytes, [(name, type, offset, length)]) of a .dbf file."""
    head = _read(path, 0, DBF_FIELD_BYTES)
    if len(head) < DBF_FIELD_BYTES:
        raise BadFile("truncated_dbf")
    n, header, record = (int.from_bytes(head[a:b], "little") for a, b in ((4, 8), (8, 10), (10, 12)))
    raw = _read(path, DBF_FIELD_BYTES, header - DBF_FIELD_BYTES)
    fields, offset = [], 1
    for at in range(0, len(raw) - DBF_FIELD_BYTES + 1, DBF_FIELD_BYTES):
        if raw[at] == DBF_END:
            break
        name = raw[at:at + 11].split(b"\0")[0].decode("latin-1")
        length = raw[at + 16]
        fields.append((name, _dbf_type(chr(raw[at + 11]), length, raw[at + 17]), offset, length))
        offset += length
    if offset > record or (_size(path) or 0) < header + n * record:
        raise BadFile("truncated_dbf")
    return n, header, record, fields


def file_header(path: str) -> dict:
    """Record count, size, CRS and columns of one shapefile; BadFile if its parts do not fit together."""
    sizes = {s: _size(_sibling(path, s)) for s in (".shp", ".shx", ".dbf", ".prj")}
    for suffix in (".shp", ".shx", ".dbf"):
        if sizes[suffix] is None:
            raise BadFile(f"missing_{suffix[1:]}")
    head = _read(path, 0, HEADER_BYTES)
    if len(head) < HEADER_BYTES or int.from_bytes(head[:4], "big") != FILE_CODE:
        raise BadFile("not_a_shapefile")
    if 2 * int.from_bytes(head[24:28], "big") > sizes[".shp"]:
        raise BadFile("truncated_shp")
    n, _, _, fields = dbf_layout(_sibling(path, ".dbf"))
    if n != (sizes[".shx"] - HEADER_BYTES) // INDEX_BYTES:
        raise BadFile("record_counts_differ")
    if sizes[".prj"] is None:
        srid = None
    else:
        srid = crs.srid_of_prj(_read(_sibling(path, ".prj")).decode("utf-8", "replace"))
    return {"n_records": n, "shp_bytes": sizes[".shp"], "srid": srid,
            "reason": None if srid else "no_crs" if sizes[".prj"] is None else "unsupported_crs",
            "fields": [(name, kind) for name, kind, _, _ in fields]}


def _signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2


def _holds(outer: np.ndarray, ring: np.ndarray) -> bool:
    """Whether ``ring`` lies in ``outer``, judged by its first vertex off the boundary."""
    if (ring[:, :2].min(axis=0) < outer[:, :2].min(axis=0)).any() \
            or (ring[:, :2].max(axis=0) > outer[:, :2].max(axis=0)).any():
        return False
    walls = np.hstack([outer[:-1, :2], outer[1:, :2]])
    for vertex in ring[:, :2]:
        side = predicates.locate(vertex[None, :], walls)[0]
        if side != predicates.BOUNDARY:
            return side == predicates.INSIDE
    return True


def _polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Clockwise rings open polygons; other rings are holes of the smallest ring around them."""
    areas = [_signed_area(r) for r in rings]
    outers = [i for i, a in enumerate(areas) if a <= 0] or [0]
    polygons = {i: [rings[i]] for i in outers}
    for i, ring in enumerate(rings):
        if i in polygons:
            continue
        around = [o for o in outers if _holds(rings[o], ring)]
        if around:
            polygons[min(around, key=lambda o: abs(areas[o]))].append(ring)
        else:
            polygons[i] = [ring]
    return list(polygons.values())


def shape_geometry(body: bytes):
    """Geometry of one record's content, None for a null shape; BadFile if it is malformed."""
    try:
        kind = int.from_bytes(body[:4], "little")
        if kind == NULL_SHAPE:
            return None
        dims = "Z" if kind in Z_SHAPES else ""
        if kind in POINT_SHAPES:
            return codec.POINT, dims, np.frombuffer(body, "<f8", 2 + len(dims), 4).reshape(1, -1)
        if kind in MULTIPOINT_SHAPES:
            n_parts, starts, at = 1, [0], 40
            n = int.from_bytes(body[36:40], "little")
        elif kind in LINE_SHAPES + AREA_SHAPES:
            n_parts, n = (int(v) for v in np.frombuffer(body, "<i4", 2, 36))
            starts, at = np.frombuffer(body, "<i4", n_parts, 44).tolist(), 44 + 4 * n_parts
        else:
            raise BadFile("unknown_shape_type")
        xy = np.frombuffer(body, "<f8", 2 * n, at).reshape(n, 2)
        if dims:
            xy = np.column_stack([xy, np.frombuffer(body, "<f8", n, at + 16 * n + 16)])
    except (ValueError, IndexError) as err:
        raise err if isinstance(err, BadFile) else BadFile("bad_record") from err
    if kind in MULTIPOINT_SHAPES:
        return codec.MULTIPOINT, dims, xy
    if sorted(starts) != starts or (starts and (starts[0] != 0 or starts[-1] > n)):
        raise BadFile("bad_record")
    paths = np.split(xy, starts[1:]) if starts else []
    if kind in LINE_SHAPES:
        return (codec.LINESTRING, dims, paths[0]) if len(paths) == 1 else (codec.MULTILINESTRING, dims, paths)
    if any(len(p) < 4 for p in paths):
        raise BadFile("bad_record")
    polygons = _polygons(paths) if paths else []
    return (codec.POLYGON, dims, polygons[0]) if len(polygons) == 1 else (codec.MULTIPOLYGON, dims, polygons)


def _geometries(data: bytes, index: np.ndarray, base: int, from_srid: int, to_srid: int) -> pa.Array:
    """Stored geometries of consecutive records, reprojected."""
    point_bytes, n = 28, len(index)
    if n and len(data) == point_bytes * n:
        raw = np.frombuffer(data, np.dtype([("head", ">i4", 2), ("kind", "<i4"), ("xy", "<f8", 2)]), n)
        if (raw["kind"] == 1).all() and (np.diff(index[:, 0]) == point_bytes).all():
            xy = crs.project_array(raw["xy"], from_srid, to_srid)
            return _point_column(xy[:, 0], xy[:, 1])
    out = []
    for offset, length in index.tolist():
        start = offset - base + INDEX_BYTES
        body = data[start:start + length]
        if len(body) < length or length < 4:
            raise BadFile("truncated_shp")
        geom = shape_geometry(body)
        out.append(None if geom is None else codec.encode_wkb(crs.reproject_geom(geom, from_srid, to_srid)))
    return pa.array(out, pa.binary())


def _column(raw: np.ndarray, kind: str, target: pa.DataType, encoding: str) -> pa.Array:
    """One attribute column of a block of fixed-length records."""
    texts = [v.decode(encoding, "replace").rstrip(" \0") for v in raw.tolist()]
    text = pa.array(texts, pa.string())
    blank = pc.or_(pc.equal(text, ""), pc.starts_with(text, "*")) if kind != "string" else pc.equal(text, "")
    text = pc.if_else(blank, pa.scalar(None, pa.string()), text)
    if kind == "string":
        typed = text
    elif kind == "date":
        padded = pc.if_else(pc.match_substring_regex(text, r"^[0-9]{8}$"), text, pa.scalar(None, pa.string()))
        typed = pc.strptime(padded, "%Y%m%d", "s", error_is_null=True).cast(pa.date32())
    elif kind == "boolean":
        typed = pc.if_else(pc.is_in(text, pa.array(["Y", "y", "T", "t"])), True,
                           pc.if_else(pc.is_in(text, pa.array(["N", "n", "F", "f"])), False,
                                      pa.scalar(None, pa.bool_())))
    else:
        typed = pc.utf8_trim_whitespace(text).cast({"int": pa.int32(), "bigint": pa.int64()}.get(kind, pa.float64()))
    if typed.type == target:
        return typed
    return typed.cast(target, safe=False) if pa.types.is_floating(target) else typed.cast(target)


def _blocks(lengths: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of blocks of at most RECORDS_PER_BATCH records and about BYTES_PER_BATCH bytes."""
    place = np.arange(len(lengths)) // RECORDS_PER_BATCH
    size = np.cumsum(lengths) // BYTES_PER_BATCH
    cuts = np.flatnonzero(np.diff(place) | np.diff(size)) + 1
    edges = [0, *cuts.tolist(), len(lengths)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def header_box(path: str) -> tuple[float, float, float, float] | None:
    """The extent that a file's header names; None for one without numbers or with zeros only, as writers leave it unset."""
    box = np.frombuffer(_read(path, *BOX_IN_HEADER), "<f8")
    return tuple(box.tolist()) if len(box) == 4 and np.isfinite(box).all() and box.any() else None


def _meet(data: bytes, index: np.ndarray, base: int, window: tuple[float, float, float, float]) -> np.ndarray:
    """Which records have a stored box that meets the window; null shapes do not, what cannot be told does."""
    octets = np.frombuffer(data, "u1")
    at, lengths = index[:, 0] - base + INDEX_BYTES, index[:, 1]
    keep = np.ones(len(index), bool)

    def numbers(rows: np.ndarray, dtype: str, first: int, count: int) -> np.ndarray:
        size = np.dtype(dtype).itemsize * count
        return octets[at[rows, None] + first + np.arange(size)].view(dtype)

    rows = np.flatnonzero((lengths >= 4) & (at + 4 <= len(data)))
    kind = np.full(len(index), -1)
    kind[rows] = numbers(rows, "<i4", 0, 1)[:, 0]
    keep[kind == NULL_SHAPE] = False
    for kinds, count in ((POINT_SHAPES, 2), (MULTIPOINT_SHAPES + LINE_SHAPES + AREA_SHAPES, 4)):
        rows = np.flatnonzero(np.isin(kind, kinds) & (lengths >= 4 + 8 * count) & (at + 4 + 8 * count <= len(data)))
        box = numbers(rows, "<f8", 4, count)
        away = (box[:, 0] > window[2]) | (box[:, -2] < window[0]) | (box[:, 1] > window[3]) | (box[:, -1] < window[1])
        keep[rows] = ~away
    return keep


def read_range(path: str, start: int, end: int, srid: int, fields: dict[str, pa.DataType], to_srid: int,
               window: tuple[float, float, float, float] | None = None) -> Iterator[tuple[np.ndarray, pa.Array, dict[str, pa.Array]]]:
    """(record numbers, geometries, attributes) of records ``start`` to ``end - 1``, block by block.

    Of a window, in the file's reference system, only records whose stored box meets it are decoded.
    """
    index = np.frombuffer(_read(_sibling(path, ".shx"), HEADER_BYTES + start * INDEX_BYTES,
                                (end - start) * INDEX_BYTES), ">i4").reshape(-1, 2).astype("i8") * 2
    if len(index) != end - start:
        raise BadFile("truncated_shx")
    n, header, record, layout = dbf_layout(_sibling(path, ".dbf"))
    cpg = _sibling(path, ".cpg")
    encoding = _read(cpg).decode("ascii", "ignore").strip() if _size(cpg) else "latin-1"
    try:
        "".encode(encoding)
    except LookupError:
        encoding = "latin-1"
    by_name = {name.lower(): (kind, offset, length) for name, kind, offset, length in layout}
    for at, stop in _blocks(index[:, 1]):
        block, first = index[at:stop], start + at
        base = int(block[:, 0].min())
        last = int((block[:, 0] + INDEX_BYTES + block[:, 1]).max())
        data = _read(path, base, last - base)
        numbers = np.arange(first, first + len(block))
        met = None if window is None else _meet(data, block, base, window)
        if met is not None and not met.any():
            continue
        geoms = _geometries(data, block if met is None else block[met], base, srid, to_srid)
        rows = np.frombuffer(_read(_sibling(path, ".dbf"), header + first * record, len(block) * record),
                             f"S{record}")
        if len(rows) != len(block):
            raise BadFile("truncated_dbf")
        cells = rows.view("u1").reshape(len(block), record)
        if met is not None:
            cells, numbers = cells[met], numbers[met]
        columns = {}
        for name, target in fields.items():
            if name not in by_name:
                columns[name] = pa.nulls(len(cells), target)
                continue
            kind, offset, length = by_name[name]
            raw = np.ascontiguousarray(cells[:, offset:offset + length]).view(f"S{length}").ravel()
            columns[name] = _column(raw, kind, target, encoding)
        live = cells[:, 0] != ord("*")
        if not live.all():
            mask = pa.array(live)
            numbers, geoms = numbers[live], geoms.filter(mask)
            columns = {k: v.filter(mask) for k, v in columns.items()}
        yield numbers, geoms, columns


# ---------------------------------------------------------------- Spark jobs

def read_headers(files: DataFrame) -> DataFrame:
    """One row per column of each shapefile of a manifest (path), or one row with ``reason`` for a bad one.

    Only headers are read. Column names are lower-cased.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                name = path.rsplit("/", 1)[-1]
                try:
                    head = file_header(path)
                except (BadFile, OSError) as err:
                    reason = str(err) if isinstance(err, BadFile) else "unreadable"
                    rows.append((path, name, 0, 0, None, reason, None, None, None))
                    continue
                fact = (path, name, head["n_records"], head["shp_bytes"], head["srid"], head["reason"])
                rows += [(*fact, i, n.lower(), kind) for i, (n, kind) in enumerate(head["fields"])] \
                    or [(*fact, None, None, None)]
            if rows:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(),
                         pa.int32(), pa.string(), pa.string())
                names = ("path", "file_name", "n_records", "shp_bytes", "srid", "reason",
                         "ordinal", "column_name", "data_type")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return spread(files.select("path")).mapInArrow(run, HEADER_SCHEMA)


def record_ranges(headers: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, file_name, srid, start, end, bytes): ranges of about ``range_bytes`` of each readable file."""
    files = headers.where("reason is null").select("path", "file_name", "n_records", "shp_bytes", "srid").distinct()
    step = F.greatest(F.lit(1), F.floor(F.col("n_records") * F.lit(range_bytes) / F.greatest("shp_bytes", F.lit(1))))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_records") - 1, F.col("_step")))
    return (files.where("n_records > 0").withColumn("_step", step).withColumn("start", starts)
            .withColumn("end", F.least(F.col("start") + F.col("_step"), F.col("n_records")))
            .select("path", "file_name", "srid", "start", "end",
                    ((F.col("end") - F.col("start")) * F.col("shp_bytes") / F.col("n_records")).alias("bytes")))


def feature_schema(fields: T.StructType) -> T.StructType:
    """The columns of features with these attributes."""
    return T.StructType([
        T.StructField("_source_file", T.StringType()), T.StructField("_fid", T.LongType()), *fields.fields,
        T.StructField("geometry", T.BinaryType()), T.StructField("bbox", BBOX_TYPE),
        T.StructField("_error", T.StringType())])


def range_batches(row: dict, wanted: dict[str, pa.DataType], to_srid: int,
                  window: tuple[float, float, float, float] | None = None) -> Iterator[pa.RecordBatch]:
    """The features of a range (path, file_name, srid, start, end), or one row with ``_error`` from where it cannot be read."""
    box_type = pa.struct([(c, pa.float64()) for c in BBOX_TYPE.names])
    arrow = pa.schema([("_source_file", pa.string()), ("_fid", pa.int64()), *wanted.items(),
                       ("geometry", pa.binary()), ("bbox", box_type), ("_error", pa.string())])
    try:
        for numbers, geoms, columns in read_range(row["path"], row["start"], row["end"], row["srid"], wanted, to_srid, window):
            n = len(numbers)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["file_name"]] * n, pa.string()), pa.array(numbers, pa.int64()),
                *columns.values(), geoms, bbox_batch(geoms).cast(box_type), pa.nulls(n, pa.string()),
            ], schema=arrow)
    except (ValueError, OSError, pa.ArrowException) as err:
        reason = str(err) if isinstance(err, BadFile) else "bad_value" \
            if isinstance(err, (ValueError, pa.ArrowException)) else "unreadable"
        empty = {name: [None] for name in arrow.names}
        empty |= {"_source_file": [row["file_name"]], "_fid": [row["start"]], "_error": [reason]}
        yield pa.RecordBatch.from_pydict(empty, schema=arrow)


def read_features(ranges: DataFrame, fields: T.StructType, to_srid: int = crs.WGS84,
                  task_bytes: int = RANGE_BYTES) -> DataFrame:
    """Features of all ranges: _source_file, _fid, the attributes, geometry, bbox, _error.

    Small ranges share a task of about ``task_bytes``, as long as every core has one.

    ``fields`` are lower-case attribute names with the wanted types; a file that lacks one yields nulls.
    ``_fid`` is the record number in its file. A range that cannot be read yields one row with ``_error``.
    """
    wanted = {f.name: ARROW_TYPES[f.dataType.simpleString()] for f in fields.fields}

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from range_batches(row, wanted, to_srid)

    size = ranges.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    cores = ranges.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(size["n"], max(cores, int(size["bytes"] // task_bytes) + 1)))
    return ranges.repartition(tasks).mapInArrow(run, feature_schema(fields))


def shapefile_ingest(files: DataFrame, columns: list[str] | None = None, to_srid: int = crs.WGS84,
                     range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Features of all shapefiles of a manifest (path), reprojected; unreadable files yield a row with ``_error``.

    The attributes are those that any readable file has, null in files without them; ``columns`` narrows them. A
    column has the type it has in the first readable file, by name, that has it; a file that has it with another
    type yields a row with ``_error``.
    """
    headers = write_through(read_headers(files), "shapefile-headers")
    readable = headers.where("reason is null and column_name is not null")
    if columns is not None:
        readable = readable.where(F.col("column_name").isin(columns))
    record = write_through(readable.groupBy("column_name").agg(
        F.min(F.struct("file_name", "ordinal", "data_type")).alias("first")).select(
        "column_name", "first.*"), "shapefile-columns")
    # One row for each different column reaches the driver.
    fields = T.StructType([T.StructField(r.column_name, T.DataType.fromDDL(r.data_type))
                           for r in record.orderBy("file_name", "ordinal").collect()])
    other = readable.join(record.select("column_name", F.col("data_type").alias("_kept")), "column_name")
    rejected = (headers.where("reason is not null").select("file_name", "reason")
                .union(other.where("data_type <> _kept").select("file_name", F.lit("schema_mismatch"))).distinct())
    good = headers.join(rejected.select("file_name"), "file_name", "left_anti")
    features = read_features(record_ranges(good, range_bytes), fields, to_srid, range_bytes)
    rejected = rejected.select(F.col("file_name").alias("_source_file"), F.col("reason").alias("_error"))
    return features.unionByName(rejected, allowMissingColumns=True)

