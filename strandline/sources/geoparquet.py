"""GeoParquet: a batch sink with the ``geo`` footer, and the scan.

Spark's own Parquet writer cannot add footer keys, so each task writes its Arrow
batches through pyarrow. Files go to a staging folder beside the target, which in
``commit`` takes the target's place as a whole, or in an append gives it its
files; files of failed or repeated attempts never get there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from strandline.functions.curve import curve_key
from strandline.functions.geometry import BBOX_TYPE, bbox_batch, crs_of, geom_bbox, set_crs
from strandline.operators.columns import lowercase_columns
from strandline.operators.naming import unused
from strandline.sources.datasets import TARGET_FILE_BYTES, parquet_sizes, spread
from strandline.sources.files import object_store_options, resolve

FORMAT = "geoparquet"
ROW_GROUP_BYTES = 64 * 1024 * 1024
# Fixed values of the GeoParquet 1.1 specification.
GEO_VERSION = "1.1.0"
GEO_TYPE_NAMES = {
    1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint",
    5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection",
}
# PROJJSON of the two supported reference systems.
_WGS84_DATUM = {
    "type": "GeodeticReferenceFrame", "name": "World Geodetic System 1984",
    "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563},
}
_WGS84_AXES = {"subtype": "ellipsoidal", "axis": [
    {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
    {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"}]}
_WGS84 = {"type": "GeographicCRS", "name": "WGS 84", "datum": _WGS84_DATUM, "coordinate_system": _WGS84_AXES,
          "id": {"authority": "EPSG", "code": 4326}}
_WEB_MERCATOR = {
    "type": "ProjectedCRS", "name": "WGS 84 / Pseudo-Mercator", "base_crs": _WGS84,
    "conversion": {"name": "Popular Visualisation Pseudo-Mercator",
                   "method": {"name": "Popular Visualisation Pseudo Mercator",
                              "id": {"authority": "EPSG", "code": 1024}}},
    "coordinate_system": {"subtype": "Cartesian", "axis": [
        {"name": "Easting", "abbreviation": "X", "direction": "east", "unit": "metre"},
        {"name": "Northing", "abbreviation": "Y", "direction": "north", "unit": "metre"}]},
    "id": {"authority": "EPSG", "code": 3857}}
PROJJSON = {4326: _WGS84, 3857: _WEB_MERCATOR}


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoParquetSource)


class GeoParquetSource(DataSource):
    """``df.write.format("geoparquet").mode(…).options(path=…, srid=…, geometry=…).save()``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool):
        opts = self.options
        return GeoParquetWriter(
            opts["path"], overwrite, opts.get("geometry", "geometry"), int(opts.get("srid", "4326")),
            int(opts.get("maxFileBytes", str(TARGET_FILE_BYTES))), schema, opts.get("splitBy"))


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class GeoParquetWriter(DataSourceArrowWriter):
    """``split_by`` names a column that starts a new file whenever its value changes, and is not written."""

    def __init__(self, path, overwrite, geometry, srid, max_bytes, schema, split_by=None):
        self.path, self.overwrite, self.geometry, self.srid = path.rstrip("/"), overwrite, geometry, srid
        self.max_bytes, self.split_by, self.has_bbox = max_bytes, split_by, "bbox" in schema.names
        self.schema = to_arrow_schema(T.StructType([f for f in schema.fields if f.name != split_by]))
        self.job = uuid.uuid4().hex
        self.staging = f"{self.path}.staging-{self.job}"

    def write(self, iterator) -> WriterCommitMessage:
        fs, staging = resolve(self.staging)
        fs.create_dir(staging, recursive=True)
        done, out, last = _Written(), None, None
        for value, batch in self._parts(iterator):
            if out is not None and (out.bytes >= self.max_bytes or value != last):
                done.files.append(out.close())
                out = None
            if out is None:
                out = _OpenFile(fs, staging, self)
            out.add(batch)
            last = value
        if out is not None:
            done.files.append(out.close())
        return done

    def _parts(self, batches):
        """(value of the splitting column, rows without it) for each run of rows that go to one file."""
        for batch in batches:
            if not batch.num_rows:
                continue
            if self.split_by is None:
                yield None, batch
                continue
            values = batch.column(self.split_by).to_numpy(zero_copy_only=False)
            rest = batch.drop_columns([self.split_by])
            edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
            for a, b in zip(edges, edges[1:], strict=False):
                yield values[a], rest.slice(a, b - a)

    def commit(self, messages) -> None:
        """A full replacement is two renames of folders, and what was there goes last; an append moves its files."""
        fs, root = resolve(self.path)
        staging = resolve(self.staging)[1]
        fs.create_dir(staging, recursive=True)
        names = {n for m in messages if m is not None for n in m.files}
        for found in fs.get_file_info(pafs.FileSelector(staging)):
            if found.base_name not in names:  # of attempts that did not count
                fs.delete_file(found.path)
        there = fs.get_file_info(root).type == pafs.FileType.Directory
        if not names and (self.overwrite or not there):
            _OpenFile(fs, staging, self).close()  # a table without rows has a file with its columns
        if there and not self.overwrite:
            for name in sorted(names):
                fs.move(f"{staging}/{name}", f"{root}/{name}")
            self._drop_staging()
            return
        old = f"{root}.old-{self.job}"
        if there:
            fs.move(root, old)
        else:
            fs.create_dir(root.rsplit("/", 1)[0], recursive=True)
        fs.move(staging, root)
        if there:
            fs.delete_dir(old)

    def abort(self, messages) -> None:
        self._drop_staging()

    def _drop_staging(self) -> None:
        fs, staging = resolve(self.staging)
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


class _OpenFile:
    """One file being written: row groups of a set size and the running footer facts."""

    def __init__(self, fs, folder: str, job: GeoParquetWriter):
        self.job, self.name = job, f"part-{uuid.uuid4().hex}.parquet"
        self.sink = fs.open_output_stream(f"{folder}/{self.name}")
        self.writer = pq.ParquetWriter(self.sink, job.schema, compression="snappy")
        self.held: list[pa.RecordBatch] = []
        self.held_bytes = self.bytes = 0
        self.kinds: set[int] = set()
        self.box = np.array([np.inf, np.inf, -np.inf, -np.inf])

    def add(self, batch: pa.RecordBatch) -> None:
        geoms = batch.column(batch.schema.get_field_index(self.job.geometry))
        heads = pc.unique(pc.binary_slice(geoms, 1, 5)).drop_null()
        self.kinds.update(int.from_bytes(head, "little") for head in heads.to_pylist())
        boxes = batch.column(batch.schema.get_field_index("bbox")) if self.job.has_bbox else bbox_batch(geoms)
        flat = [np.asarray(c.drop_null()) for c in boxes.flatten()]
        if len(flat[0]):
            self.box[:2] = np.minimum(self.box[:2], [flat[0].min(), flat[1].min()])
            self.box[2:] = np.maximum(self.box[2:], [flat[2].max(), flat[3].max()])
        self.held.append(batch)
        self.held_bytes += batch.nbytes
        self.bytes += batch.nbytes
        if self.held_bytes >= ROW_GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            table = pa.Table.from_batches(self.held).cast(self.job.schema)
            self.writer.write_table(table, row_group_size=1 << 30)
            self.held, self.held_bytes = [], 0

    def close(self) -> str:
        self._flush()
        column = {
            "encoding": "WKB",
            "geometry_types": sorted(GEO_TYPE_NAMES[k % 1000] + (" Z" if k // 1000 in (1, 3) else "")
                                     for k in self.kinds),
            "crs": PROJJSON.get(self.job.srid),
        }
        if np.isfinite(self.box).all():
            column["bbox"] = self.box.tolist()
        if self.job.has_bbox:
            column["covering"] = {"bbox": {c: ["bbox", c] for c in ("xmin", "ymin", "xmax", "ymax")}}
        geo = {"version": GEO_VERSION, "primary_column": self.job.geometry, "columns": {self.job.geometry: column}}
        self.writer.add_key_value_metadata({"geo": json.dumps(geo)})
        self.writer.close()
        self.sink.close()
        return self.name


def geoparquet_write(df: DataFrame, path: str, srid: int = 4326, geometry: str = "geometry",
                     mode: str = "overwrite", max_file_bytes: int = TARGET_FILE_BYTES,
                     split_by: str | None = None) -> None:
    """One GeoParquet file or more per partition; a file holds one value of ``split_by`` only, which is not written."""
    register(df.sparkSession)
    if split_by:
        df = df.sortWithinPartitions(split_by)
    writer = (df.write.format(FORMAT).mode(mode).option("path", path).option("srid", str(srid))
              .option("geometry", geometry).option("maxFileBytes", str(max_file_bytes)))
    (writer.option("splitBy", split_by) if split_by else writer).save()


def geo_footers(spark: SparkSession, *paths: str, options: dict[str, str] | None = None) -> DataFrame:
    """(path, geo) per file: the footer's ``geo`` JSON, read on executors."""
    def read(batches):
        for batch in batches:
            paths, texts = batch.column("path").to_pylist(), []
            for p in paths:
                fs, local = resolve(p, options)
                with fs.open_input_file(local) as handle:
                    geo = (pq.read_metadata(handle).metadata or {}).get(b"geo")
                texts.append(geo.decode() if geo else None)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())],
                                             ["path", "geo"])
    found = reduce(DataFrame.union, [parquet_sizes(spark, p).select("path") for p in paths])
    return spread(found).mapInArrow(read, "path string, geo string")


def dataset_crs(spark: SparkSession, *paths: str, options: dict[str, str] | None = None) -> tuple[str, int | None] | None:
    """(geometry column, EPSG code) that all files name; None if no file has a ``geo`` footer.

    Files of different systems, or with and without a footer, are an error: as one table their coordinates would not
    fit together. One row for each different system reaches the driver.
    """
    column = F.get_json_object("geo", "$.primary_column")
    code = F.expr("get_json_object(geo, concat('$.columns.', get_json_object(geo, '$.primary_column'), '.crs.id.code'))")
    found = geo_footers(spark, *paths, options=options).select(column.alias("column"), code.cast("int").alias("code")).distinct()
    systems = found.collect()
    if len(systems) > 1:
        raise ValueError(f"files of different systems: {sorted(map(str, systems))}")
    return (systems[0].column, systems[0].code) if systems and systems[0].column else None


def box_index(spark: SparkSession, *paths: str, options: dict[str, str] | None = None) -> DataFrame:
    """``path, bbox`` per file: the extent its footer names, null where it names none of four numbers."""
    box = F.from_json(F.expr("get_json_object(geo, concat('$.columns.', get_json_object(geo, '$.primary_column'), '.bbox'))"), "array<double>")
    found = geo_footers(spark, *paths, options=options).select("path", box.alias("b"))
    sides = F.struct(*(F.col("b")[i].alias(name) for i, name in enumerate(BBOX_TYPE.names)))
    return found.select("path", F.when((F.size("b") == 4) & ~F.exists("b", lambda v: v.isNull()), sides).alias("bbox"))


def meets(box: Column, window: tuple[float, float, float, float]) -> Column:
    """Whether a box has a point of a window (xmin, ymin, xmax, ymax); boundaries count."""
    xmin, ymin, xmax, ymax = map(float, window)
    return (box.xmin <= xmax) & (box.xmax >= xmin) & (box.ymin <= ymax) & (box.ymax >= ymin)


def geoparquet_scan(spark: SparkSession, *paths: str, window: tuple[float, float, float, float] | None = None) -> DataFrame:
    """GeoParquet parts as one table with lower-case names and the CRS that all footers name.

    ``window`` (xmin, ymin, xmax, ymax) leaves the rows whose box meets it. Files whose footers name an extent away from it
    are not opened; in the others the stored ``bbox`` column, if there is one, prunes row groups, else boxes are found from
    the geometries. Rows without a box (null, empty) meet no window. The names of the files that are opened reach the driver,
    as those of any scan do. Paths may be those of an object store, as ``object_store_scan`` takes them.
    """
    resolved = [object_store_options(p) for p in paths]
    options = {k: v for _, o in resolved for k, v in o.items()}
    paths = [p for p, _ in resolved]
    crs = dataset_crs(spark, *paths, options=options)
    if window is None:
        df = lowercase_columns(spark.read.options(**options).parquet(*paths))
    else:
        index = box_index(spark, *paths, options=options)
        near = [r.path for r in index.where(F.col("bbox").isNull() | meets(F.col("bbox"), window)).select("path").collect()]
        whole = spark.read.options(**options).parquet(*paths)
        if len(paths) == 1 and len(near) != 1:  # folders named after values stay columns
            options["basePath"] = paths[0]
        df = lowercase_columns(spark.read.options(**options).schema(whole.schema).parquet(*near) if near else whole.where(F.lit(False)))
        geometry = crs[0].lower() if crs else "geometry"
        box = F.col("bbox") if "bbox" in df.columns else geom_bbox(geometry)
        df = df.where(meets(box, window))
    return set_crs(df, crs[1], crs[0].lower()) if crs and crs[1] else df


#: Bytes of the parts that consolidation sorts in one task; the sink cuts them into files.
RANGE_BYTES = 2 * 1024 ** 3


def _extent(spark: SparkSession, path: str) -> tuple[float, float, float, float]:
    """What the footers' extents cover together, those without end aside; of no size if there are none."""
    box = F.col("bbox")
    ends = F.greatest(*(F.abs(box[c]) for c in BBOX_TYPE.names)) < float("inf")  # NaN counts as the greatest
    found = box_index(spark, path).where(ends).agg(F.min(box.xmin), F.min(box.ymin), F.max(box.xmax), F.max(box.ymax)).first()
    return tuple(found) if found[0] is not None else (0.0, 0.0, 0.0, 0.0)


def consolidate(spark: SparkSession, parts: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite all parts as files of about ``file_bytes``, neighbours together; returns the number of files aimed at.

    Rows lie along a Hilbert curve through the centres of their boxes, over the extent that the parts' footers name, so a file's
    extent is small however full a place is, and windows open few files. A range has about ``RANGE_BYTES``, less if cores would be idle. Rows of the
    same place are told apart by a hash, so that no range must take them all; those without geometry come first.
    The reference system is that of the parts.
    """
    sizes = parquet_sizes(spark, parts).agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("n")).first()
    if not sizes.n:
        return 0
    n_files = -(-int(sizes.n) // file_bytes)
    df = geoparquet_scan(spark, parts)
    srid = crs_of(df) or 4326
    if "bbox" not in df.columns:
        df = df.withColumn("bbox", geom_bbox("geometry"))
    place = curve_key(F.col("bbox"), _extent(spark, parts))
    tie = F.xxhash64(*[c for c in df.columns if c not in ("geometry", "bbox")], "geometry")
    ranges = max(-(-int(sizes.n) // RANGE_BYTES), min(n_files, spark.sparkContext.defaultParallelism))
    keys = unused(df.columns, "_place", "_tie")  # columns: a sort computes an expression again for every comparison of equal prefixes
    df = df.withColumns(dict(zip(keys, (place, tie), strict=True))).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop(*keys)
    geoparquet_write(df, target, srid, max_file_bytes=file_bytes)
    return n_files
