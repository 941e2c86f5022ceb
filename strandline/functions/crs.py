"""Reprojection between EPSG:4326 and EPSG:3857 in closed form."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import arrays, codec, geometry

# Fixed values of EPSG:3857 (radius of the sphere in metres) and of the CRS names in .prj files.
RADIUS = 6378137.0
WGS84, WEB_MERCATOR = 4326, 3857
SUPPORTED = (WGS84, WEB_MERCATOR)
DATUM_NAMES = ("WGS84", "WGS1984", "DWGS1984", "WORLDGEODETICSYSTEM1984")
MERCATOR_NAMES = ("WGS84PSEUDOMERCATOR", "WGS1984WEBMERCATOR", "WGS1984WEBMERCATORAUXILIARYSPHERE",
                  "WGS84WEBMERCATOR", "WEBMERCATOR")


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres of a degree pair; null at and beyond the poles, where the projection has no value."""
    y = RADIUS * F.log(F.tan(F.lit(np.pi / 4) + F.radians(lat) / 2))
    return RADIUS * F.radians(lon), F.when(F.abs(lat) < 90, y)


def to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees of a Web Mercator pair."""
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - F.lit(np.pi / 2))


def project_array(xy: np.ndarray, from_srid: int, to_srid: int) -> np.ndarray:
    """The two projections over a coordinate array; any further dimensions are kept."""
    if from_srid == to_srid or not len(xy):
        return xy
    out = np.array(xy, "f8")
    if to_srid == WEB_MERCATOR:
        if (np.abs(out[:, 1]) >= 90).any():
            raise ValueError("latitude beyond the projection")
        out[:, 0] = RADIUS * np.radians(out[:, 0])
        out[:, 1] = RADIUS * np.log(np.tan(np.pi / 4 + np.radians(out[:, 1]) / 2))
    else:
        out[:, 0] = np.degrees(out[:, 0] / RADIUS)
        out[:, 1] = np.degrees(2 * np.arctan(np.exp(out[:, 1] / RADIUS)) - np.pi / 2)
    return out


def reproject_geom(geom, from_srid: int, to_srid: int):
    return codec.with_rings(geom, lambda xy: project_array(xy, from_srid, to_srid))


def reproject(geom: Column, from_srid: int, to_srid: int) -> Column:
    """Geometry column in another CRS; null where a vertex has no image there."""
    if from_srid not in SUPPORTED or to_srid not in SUPPORTED:
        raise ValueError(f"unsupported_crs: {from_srid} to {to_srid}")
    if from_srid == to_srid:
        return geom

    @F.arrow_udf(T.BinaryType())
    def convert(wkb: pa.Array) -> pa.Array:
        points = geometry._points(wkb)
        if points is not None and (to_srid != WEB_MERCATOR or (np.abs(points["y"]) < 90).all()):
            xy = project_array(np.column_stack([points["x"], points["y"]]), from_srid, to_srid)
            return geometry._point_column(xy[:, 0], xy[:, 1])
        found = arrays.layout(wkb)
        xy = found.coordinates()
        if to_srid != WEB_MERCATOR or (np.abs(xy[:, 1]) < 90).all():
            fast, done = found.with_coordinates(project_array(xy, from_srid, to_srid)), found.ok
        else:  # some vertex has no image
            fast, done = pa.nulls(len(wkb), pa.binary()), np.zeros(len(wkb), bool)
        return arrays.with_others(fast, done, wkb, lambda rest: geometry._map_geoms(
            rest, lambda g: codec.encode_wkb(reproject_geom(g, from_srid, to_srid)), pa.binary()))
    return convert(geom)


def _clauses(text: str) -> tuple[str, list[str], list[tuple]]:
    """Keyword, quoted or plain values and inner clauses of a bracketed text such as ``GEOGCS["name",DATUM[…],…]``."""
    tokens = re.findall(r'"[^"]*"|[\[\]()]|[^\s\[\](),"]+', text)
    root: tuple[str, list[str], list[tuple]] = ("", [], [])
    open_clauses = [root]
    for i, token in enumerate(tokens):
        if token in "[(":
            continue
        if token in "])":
            if len(open_clauses) == 1:
                break
            open_clauses.pop()
        elif i + 1 < len(tokens) and tokens[i + 1] in "[(":
            clause = (token.upper(), [], [])
            open_clauses[-1][2].append(clause)
            open_clauses.append(clause)
        else:
            open_clauses[-1][1].append(token.strip('"'))
    return root[2][0] if root[2] else root


def srid_of_prj(text: str) -> int | None:
    """SRID of a .prj text: 4326 or 3857 where its outermost system is one of them, else None.

    The authority code of that system decides, or else the name of its datum (degrees) or its own name
    (metres). What inner clauses say of other systems, such as the shift to WGS 84, is not looked at.
    """
    keyword, values, inner = _clauses(text)
    codes = [c[1] for c in inner if c[0] in ("AUTHORITY", "ID")]
    if codes:
        code = codes[0][-1] if len(codes[0]) == 2 and codes[0][0].upper() == "EPSG" else ""
        return int(code) if code in ("4326", "3857") else None
    names = [v[1][0] for v in inner if v[0] == "DATUM" and v[1]] if keyword == "GEOGCS" else values[:1]
    name = re.sub(r"[\s_/.-]+", "", names[0]).upper() if names else ""
    if keyword == "GEOGCS" and name in DATUM_NAMES:
        return WGS84
    if keyword == "PROJCS" and name in MERCATOR_NAMES:
        return WEB_MERCATOR
    return None
