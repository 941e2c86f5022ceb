"""Writes sample shapefiles for tests and queries, following the public format description."""

from __future__ import annotations

import struct
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import codec
from strandline.session import scratch_path
from strandline.sources.files import resolve

PRJ = {
    4326: 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],'
          'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]',
    3857: 'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere",GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",'
          'SPHEROID["WGS_1984",6378137.0,298.257223563]]],PROJECTION["Mercator_Auxiliary_Sphere"],UNIT["Meter",1.0]]',
    2154: 'PROJCS["RGF93_Lambert_93",GEOGCS["GCS_RGF_1993",DATUM["D_RGF_1993"]],UNIT["Meter",1.0]]',
}


def _record(geom) -> bytes:
    if geom is None:
        return struct.pack("<i", 0)
    kind, dims, body = geom
    if kind == codec.POINT:
        return struct.pack("<i2d", 1, *body[0, :2])
    paths = codec.rings(geom)
    xy = np.concatenate(paths)[:, :2]
    box = struct.pack("<4d", *xy.min(axis=0), *xy.max(axis=0))
    if kind == codec.MULTIPOINT:
        return struct.pack("<i", 8) + box + struct.pack("<i", len(xy)) + xy.astype("<f8").tobytes()
    shape = 3 if kind in (codec.LINESTRING, codec.MULTILINESTRING) else 5
    starts = np.cumsum([0] + [len(p) for p in paths[:-1]])
    return (struct.pack("<i", shape) + box + struct.pack("<2i", len(paths), len(xy))
            + starts.astype("<i4").tobytes() + xy.astype("<f8").tobytes())


def write_shapefile(path: str, wkts: list[str | None], columns: dict[str, tuple[str, int, int, list]],
                    srid: int | None = 4326) -> None:
    """One shapefile. ``columns`` maps a name to (dBASE type, length, decimals, values).

    Polygon rings are written as given, so outer rings should run clockwise.
    """
    records = [_record(None if w is None else codec.decode_wkt(w)) for w in wkts]
    shp, shx, at = b"", b"", 50
    parts, index = [], []
    for i, body in enumerate(records):
        parts.append(struct.pack(">2i", i + 1, len(body) // 2) + body)
        index.append(struct.pack(">2i", at, len(body) // 2))
        at += 4 + len(body) // 2
    shp, shx = b"".join(parts), b"".join(index)
    shape = next((struct.unpack("<i", r[:4])[0] for r in records if len(r) > 4), 1)

    def head(size):
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50 + size // 2) + struct.pack("<2i8d", 1000, shape, *[0.0] * 8)
    fs, base = resolve(path)
    base = base.removesuffix(".shp")
    fs.create_dir(base.rsplit("/", 1)[0], recursive=True)

    def put(suffix: str, data: bytes) -> None:
        with fs.open_output_stream(base + suffix) as out:
            out.write(data)
    put(".shp", head(len(shp)) + shp)
    put(".shx", head(len(shx)) + shx)
    size = 1 + sum(c[1] for c in columns.values())
    header = 32 + 32 * len(columns) + 1
    dbf = [struct.pack("<4BIHH20x", 3, 124, 1, 1, len(wkts), header, size)]
    dbf += [struct.pack("<11sc4xBB14x", name.encode()[:10], kind.encode(), length, decimals)
            for name, (kind, length, decimals, _) in columns.items()]
    dbf.append(b"\r")
    for i in range(len(wkts)):
        row = b" "
        for kind, length, decimals, values in columns.values():
            value = values[i]
            text = "" if value is None else f"{value:.{decimals}f}" if kind in "NF" and decimals else str(value)
            row += (text.rjust(length) if kind in "NF" else text.ljust(length)).encode("latin-1")[:length]
        dbf.append(row)
    put(".dbf", b"".join(dbf) + b"\x1a")
    if srid is not None:
        put(".prj", PRJ[srid].encode())


def join_shapefiles(path: str, pieces: list[str]) -> int:
    """Shapefiles of the same columns as one, record after record; one piece at a time is in memory. Returns the features."""
    fs, base = resolve(path)
    base = base.removesuffix(".shp")
    sources = [resolve(p) for p in pieces]

    def name(i: int, suffix: str) -> str:
        return sources[i][1].removesuffix(".shp") + suffix

    def read(i: int, suffix: str, size: int | None = None) -> bytes:
        with sources[i][0].open_input_stream(name(i, suffix)) as data:
            return data.read(size)

    def bytes_of(suffix: str) -> list[int]:
        return [s[0].get_file_info(name(i, suffix)).size for i, s in enumerate(sources)]
    heads = [read(i, ".shp", 100) for i in range(len(pieces))]
    shape = max(struct.unpack("<i", h[32:36])[0] for h in heads)  # a piece of nulls only is written as points

    def head(suffix: str) -> bytes:
        words = 50 + sum(n - 100 for n in bytes_of(suffix)) // 2
        return heads[0][:24] + struct.pack(">i", words) + heads[0][28:32] + struct.pack("<i", shape) + heads[0][36:]
    fs.create_dir(base.rsplit("/", 1)[0], recursive=True)
    at, done = 50, 0
    with fs.open_output_stream(base + ".shp") as shp, fs.open_output_stream(base + ".shx") as shx:
        shp.write(head(".shp"))
        shx.write(head(".shx"))
        for i in range(len(pieces)):
            records = np.frombuffer(read(i, ".shp"), np.uint8)[100:].copy()
            index = np.frombuffer(read(i, ".shx")[100:], ">i4").reshape(-1, 2).copy()
            numbers = np.arange(done + 1, done + 1 + len(index)).astype(">i4").view(np.uint8).reshape(-1, 4)
            records[2 * index[:, :1].astype(np.int64) - 100 + np.arange(4)] = numbers
            index[:, 0] += at - 50
            shp.write(records.tobytes())
            shx.write(index.tobytes())
            at, done = at + len(records) // 2, done + len(index)
    fields = read(0, ".dbf")
    fields = fields[:struct.unpack("<H", fields[8:10])[0]]
    with fs.open_output_stream(base + ".dbf") as dbf:
        dbf.write(fields[:4] + struct.pack("<I", done) + fields[8:])
        for i in range(len(pieces)):
            dbf.write(read(i, ".dbf")[len(fields):-1])
        dbf.write(b"\x1a")
    with fs.open_output_stream(base + ".prj") as prj:
        prj.write(read(0, ".prj"))
    return done


def export_features(feat: DataFrame, directory: str, rows_per_piece: int = 5000) -> DataFrame:
    """``feat`` as shapefiles, one for each source and named as it, features in the order of ``_fid``.

    Tasks write pieces of at most ``rows_per_piece`` features; another joins those of a source. Returns the names
    with the number of features in them.
    """
    pieces = scratch_path(feat.sparkSession, "pieces")

    def export(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_fid")
        path = f"{pieces}/{key[0][:-4]}_{key[1]}.shp"
        pdf = pdf.astype(object).where(pdf.notna(), None)
        write_shapefile(path, pdf["wkt"].tolist(), {
            "FEATURE": ("N", 12, 0, pdf["_fid"].tolist()),
            "GUI": ("C", 16, 0, pdf["gui"].tolist()),
            "HAB_TYPE": ("C", 16, 0, pdf["hab_type"].tolist()),
            "ORIG_HAB": ("C", 32, 0, pdf["orig_hab"].tolist()),
            "SUM_CONF": ("N", 6, 0, pdf["sum_conf"].tolist()),
            "COMP": ("N", 18, 4, pdf["comp"].tolist()),
        })
        return pd.DataFrame({"file_name": [key[0]], "part": [key[1]], "path": [path]})

    def join(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        n = join_shapefiles(f"{directory}/{key[0]}", pdf.sort_values("part")["path"].tolist())
        return pd.DataFrame({"file_name": [key[0]], "n_rows": [n]})

    part = F.floor(F.col("_fid") / (rows_per_piece * 25)).alias("_part")
    written = feat.groupBy("_source_file", part).applyInPandas(export, "file_name string, part bigint, path string")
    return written.groupBy("file_name").applyInPandas(join, "file_name string, n_rows bigint")


def write_broken(directory: str) -> None:
    """Two files that do not fit: one cut off in its head, one with other types."""
    point = ["POINT (1 1)"]
    write_shapefile(f"{directory}/IT_cut.shp", point, {"GUI": ("C", 8, 0, ["x"])})
    fs, cut = resolve(f"{directory}/IT_cut.shp")
    with fs.open_output_stream(cut) as out:
        out.write(b"\0\0")
    write_shapefile(f"{directory}/IT_drift.shp", point, {"GUI": ("N", 8, 0, [1]), "SUM_CONF": ("C", 6, 0, ["1"])})
