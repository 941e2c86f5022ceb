"""Shapefiles as a source of Spark: ``spark.read.format("shapefile").load(folder or file)``.

Planning reads names and sizes only: an ``.shx`` entry has a fixed length, so sizes give every file's record ranges. Tasks
read headers and records. Filters on the sides of ``bbox`` and on ``_source_file`` reach the tasks: files and records whose
stored box lies outside are not decoded. Spark applies the filters again to what comes out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from strandline.functions import crs
from strandline.functions.geometry import BBOX_TYPE
from strandline.sources.files import SHAPE_SUFFIX, resolve
from strandline.sources.shapefile import (
    ARROW_TYPES,
    HEADER_BYTES,
    INDEX_BYTES,
    RANGE_BYTES,
    BadFile,
    feature_schema,
    file_header,
    header_box,
    range_batches,
)

FORMAT = "shapefile"
# Types of attributes by the name that a header's columns have.
ATTRIBUTES = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType,
              "date": T.DateType, "boolean": T.BooleanType}
UNLIMITED = (-math.inf, -math.inf, math.inf, math.inf)
#: What a stored box may differ by from one that was reprojected and back, as a share of its numbers.
MARGIN = 1e-9


def register(spark: SparkSession) -> None:
    """Make ``format("shapefile")`` known to a session; filters on sources in Python must be on for it, and are put on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ShapefileSource)


@dataclass(frozen=True)
class Range:
    path: str
    start: int
    end: int


class ShapefileSource(DataSource):
    """Columns as ``shapefile_ingest`` returns them: ``_source_file, _fid``, the attributes, ``geometry, bbox, _error``.

    Options: ``srid`` of the geometries that come out (4326), ``recursive`` (false), ``mergeSchema`` (false: the
    attributes are those of the first readable file by name; true: of all, at the cost of opening every header while
    planning; a schema that the user gives costs nothing), ``rangeBytes``. A column has the type of the first readable file
    that has it; attributes named like one of the fixed columns are left out. A file that cannot be read, or has a wanted
    column with another type, gives one row with ``_error``; a range that cannot be read likewise. Filters on ``bbox``
    leave such rows and those without geometry out, as any comparison with null does. A folder without files has no rows.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _files(self) -> dict[str, tuple[int, int]]:
        """Bytes and records by path, in the order of names, from listings alone."""
        path = self.options["path"]
        fs, local = resolve(path)
        root = path[:len(path) - len(local)] if path.endswith(local) else path[:path.find(":") + 1]
        if fs.get_file_info(local).type == pafs.FileType.File:
            listed = fs.get_file_info([local, local[:-4] + ".shx"])
        else:
            listed = fs.get_file_info(pafs.FileSelector(local, recursive=self.options.get("recursive", "false").lower() == "true"))
        sizes = {i.path: i.size for i in listed if i.type == pafs.FileType.File}
        shapes = sorted((p for p in sizes if p.endswith(SHAPE_SUFFIX)), key=lambda p: (p.rsplit("/", 1)[-1], p))
        return {root + p: (sizes[p], max(0, sizes.get(p[:-4] + ".shx", 0) - HEADER_BYTES) // INDEX_BYTES) for p in shapes}

    def schema(self) -> T.StructType:
        kinds: dict[str, str] = {}
        for path in self._files():
            try:
                head = file_header(path)
            except (BadFile, OSError):
                continue
            if head["reason"]:
                continue
            for name, kind in head["fields"]:
                kinds.setdefault(name.lower(), kind)
            if self.options.get("mergeSchema", "false").lower() != "true":
                break
        fixed = set(feature_schema(T.StructType()).names)
        return feature_schema(T.StructType([T.StructField(n, ATTRIBUTES[k]()) for n, k in kinds.items() if n not in fixed]))

    def reader(self, schema: T.StructType) -> ShapefileReader:
        return ShapefileReader(self._files(), schema, int(self.options.get("srid", str(crs.WGS84))),
                               int(self.options.get("rangeBytes", str(RANGE_BYTES))))


@dataclass
class ShapefileReader(DataSourceReader):
    files: dict[str, tuple[int, int]]
    wanted: T.StructType
    srid: int
    range_bytes: int
    box: tuple[float, float, float, float] = UNLIMITED
    names: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrow the box and the names; every filter goes back to Spark, which has the last word."""
        xmin, ymin, xmax, ymax = self.box
        for f in filters:
            match f:
                case GreaterThan(("bbox", "xmax"), v) | GreaterThanOrEqual(("bbox", "xmax"), v):
                    xmin = max(xmin, v)
                case GreaterThan(("bbox", "ymax"), v) | GreaterThanOrEqual(("bbox", "ymax"), v):
                    ymin = max(ymin, v)
                case LessThan(("bbox", "xmin"), v) | LessThanOrEqual(("bbox", "xmin"), v):
                    xmax = min(xmax, v)
                case LessThan(("bbox", "ymin"), v) | LessThanOrEqual(("bbox", "ymin"), v):
                    ymax = min(ymax, v)
                case EqualTo(("_source_file",), v):
                    self.names = {v} if self.names is None else self.names & {v}
                case In(("_source_file",), vs):
                    self.names = set(vs) if self.names is None else self.names & set(vs)
            yield f
        self.box = (xmin, ymin, xmax, ymax)

    def partitions(self) -> list[InputPartition]:
        """Ranges of about ``range_bytes``; small ones share a partition."""
        packed, room = [[]], self.range_bytes
        for path, (size, records) in self.files.items():
            if self.names is not None and path.rsplit("/", 1)[-1] not in self.names:
                continue
            step = max(1, records * self.range_bytes // max(size, 1))
            for start in range(0, max(records, 1), step):
                end = min(start + step, records)
                cost = size * (end - start) // max(records, 1)
                if packed[-1] and cost > room:
                    packed.append([])
                    room = self.range_bytes
                packed[-1].append(Range(path, start, end))
                room -= cost
        return [InputPartition(ranges) for ranges in packed]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fixed = set(feature_schema(T.StructType()).names)
        fields = {f.name: ARROW_TYPES[f.dataType.simpleString()] for f in self.wanted if f.name not in fixed}
        for part in partition.value:
            name, reason, head = part.path.rsplit("/", 1)[-1], None, None
            try:
                head = file_header(part.path)
                kinds = {n.lower(): ATTRIBUTES[k]() for n, k in head["fields"]}
                other = any(kinds.get(f.name, f.dataType) != f.dataType for f in self.wanted if f.name not in fixed)
                reason = head["reason"] or ("schema_mismatch" if other else None)
            except (BadFile, OSError) as err:
                reason = str(err) if isinstance(err, BadFile) else "unreadable"
            if reason:
                if not part.start:  # one row for each file
                    yield self._shaped(pa.RecordBatch.from_pydict({"_source_file": [name], "_error": [reason]}))
                continue
            box = stored_window(self.box, self.srid, head["srid"])
            if part.end > part.start and not _apart(header_box(part.path), box):
                row = {"path": part.path, "file_name": name, "start": part.start, "end": part.end, "srid": head["srid"]}
                for batch in range_batches(row, fields, self.srid, None if box == UNLIMITED else box):
                    yield self._shaped(batch)

    def _shaped(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The wanted columns in their order, null where the batch has none."""
        box = pa.struct([(n, pa.float64()) for n in BBOX_TYPE.names])
        kinds = {"_source_file": pa.string(), "_fid": pa.int64(), "geometry": pa.binary(), "bbox": box, "_error": pa.string()}
        held = dict(zip(batch.schema.names, batch.columns, strict=True))
        names = self.wanted.names
        types = [kinds.get(f.name) or ARROW_TYPES[f.dataType.simpleString()] for f in self.wanted]
        columns = [held[n].cast(t) if n in held else pa.nulls(batch.num_rows, t) for n, t in zip(names, types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)


def stored_window(box: tuple[float, float, float, float], srid: int, stored: int) -> tuple[float, float, float, float]:
    """A window of one reference system in that of the file, a little wider where it was reprojected.

    Both systems stretch each axis on its own and keep its order. Sides that have no place there are unlimited.
    """
    if srid == stored or box == UNLIMITED:
        return box
    sides = list(box)
    for i, v in enumerate(box):
        if math.isfinite(v):
            try:
                moved = float(crs.project_array(np.array([[v, 0.0] if i % 2 == 0 else [0.0, v]]), srid, stored)[0, i % 2])
            except ValueError:
                moved = math.nan
            outward = -1 if i < 2 else 1
            sides[i] = moved + outward * MARGIN * (1 + abs(moved)) if math.isfinite(moved) else outward * math.inf
    return tuple(sides)


def _apart(found: tuple[float, float, float, float] | None, box: tuple[float, float, float, float]) -> bool:
    """Whether a file's box, if it names one, has no point of the window."""
    if found is None:
        return False
    return found[0] > box[2] or found[2] < box[0] or found[1] > box[3] or found[3] < box[1]
