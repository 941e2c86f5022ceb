"""WKT and WKB encodings of one geometry, as small numpy helpers.

A geometry is ``(kind, dims, body)``. ``kind`` is the WKB type number, ``dims``
the suffix ``""``, ``"Z"``, ``"M"`` or ``"ZM"``. ``body`` is one ``(n, d)`` array
for points, lines and multipoints, a list of such arrays for polygons and
multilines, a list of ring lists for multipolygons, and a list of geometries for
collections.
"""

from __future__ import annotations

import re
import struct

import numpy as np

# Fixed values of the WKB and WKT formats.
POINT, LINESTRING, POLYGON, MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = range(1, 8)
TYPE_NAMES = {
    POINT: "POINT",
    LINESTRING: "LINESTRING",
    POLYGON: "POLYGON",
    MULTIPOINT: "MULTIPOINT",
    MULTILINESTRING: "MULTILINESTRING",
    MULTIPOLYGON: "MULTIPOLYGON",
    COLLECTION: "GEOMETRYCOLLECTION",
}
DIM_SUFFIXES = ("", "Z", "M", "ZM")
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000

_TYPE_CODES = {name: code for code, name in TYPE_NAMES.items()}
_TAGGED = re.compile(r"\s*(?:SRID=\d+;)?\s*([A-Z]+)\s*(ZM|Z|M)?\s*(EMPTY|\(.*\))\s*", re.I | re.S)
_FLAT_GROUP = re.compile(r"\(([^()]*)\)")
_NESTED_GROUP = re.compile(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)")
_SEPARATORS = re.compile(r"[\s,]*")


def width(dims: str) -> int:
    return 2 + len(dims)


# ---------------------------------------------------------------- WKB

def decode_wkb(data: bytes):
    """Geometry of ISO or extended WKB in either byte order; ValueError if malformed."""
    try:
        geom, end = _take(data, 0)
    except (struct.error, IndexError) as err:
        raise ValueError("truncated WKB") from err
    if end != len(data):
        raise ValueError("trailing bytes after WKB")
    return geom


def _take(data: bytes, at: int):
    if data[at] not in (0, 1):
        raise ValueError("bad byte order mark")
    order = "<" if data[at] else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & EWKB_SRID:
        at += 4
    has_z, has_m = bool(code & EWKB_Z), bool(code & EWKB_M)
    code &= 0x0FFFFFFF
    family, kind = divmod(code, 1000)
    if kind not in TYPE_NAMES or family > 3:
        raise ValueError(f"unknown WKB type {code}")
    dims = DIM_SUFFIXES[family] or ("Z" if has_z else "") + ("M" if has_m else "")

    def count():
        nonlocal at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def coords(n):
        nonlocal at
        size = 8 * n * width(dims)
        if at + size > len(data):
            raise ValueError("truncated WKB")
        out = np.frombuffer(data, order + "f8", n * width(dims), at).astype("<f8").reshape(n, width(dims))
        at += size
        return out

    if kind == POINT:
        xy = coords(1)
        return (kind, dims, xy[:0] if np.isnan(xy[0, :2]).all() else xy), at
    if kind == LINESTRING:
        return (kind, dims, coords(count())), at
    if kind == POLYGON:
        return (kind, dims, [coords(count()) for _ in range(count())]), at
    parts = []
    for _ in range(count()):
        part, at = _take(data, at)
        parts.append(part)
    if kind == COLLECTION:
        return (kind, dims, parts), at
    if any(p[0] != kind - 3 for p in parts):
        raise ValueError("mixed parts in a multi geometry")
    bodies = [p[2] for p in parts]
    if kind == MULTIPOINT:
        bodies = np.concatenate(bodies) if bodies else np.empty((0, width(dims)))
    return (kind, dims, bodies), at


def encode_wkb(geom) -> bytes:
    """ISO little-endian WKB with -0.0 written as 0.0, so equal geometries have equal bytes."""
    kind, dims, body = geom
    head = struct.pack("<BI", 1, kind + 1000 * DIM_SUFFIXES.index(dims))
    if kind == POINT:
        return head + _raw(body if len(body) else np.full((1, width(dims)), np.nan))
    if kind == LINESTRING:
        return head + struct.pack("<I", len(body)) + _raw(body)
    if kind == POLYGON:
        return head + struct.pack("<I", len(body)) + b"".join(struct.pack("<I", len(r)) + _raw(r) for r in body)
    if kind == COLLECTION:
        parts = body
    elif kind == MULTIPOINT:
        parts = [(POINT, dims, body[i:i + 1]) for i in range(len(body))]
    else:
        parts = [(kind - 3, dims, b) for b in body]
    return head + struct.pack("<I", len(parts)) + b"".join(encode_wkb(p) for p in parts)


def _raw(xy) -> bytes:
    return (np.asarray(xy, "<f8") + 0.0).tobytes()


# ---------------------------------------------------------------- WKT

def number(value: float) -> str:
    """Shortest text that reads back as the same double, without a trailing ``.0``."""
    text = repr(float(value))
    return text[:-2] if text.endswith(".0") else text


def encode_wkt(geom) -> str:
    kind, dims, body = geom
    name = TYPE_NAMES[kind] + (f" {dims}" if dims else "")
    if len(body) == 0:
        return f"{name} EMPTY"
    if kind == COLLECTION:
        return f"{name} ({', '.join(encode_wkt(g) for g in body)})"
    if kind in (POINT, LINESTRING, MULTIPOINT):
        return f"{name} {_path(body)}"
    if kind in (POLYGON, MULTILINESTRING):
        return f"{name} ({', '.join(_path(r) for r in body)})"
    polygons = ("(" + ", ".join(_path(r) for r in rings) + ")" for rings in body)
    return f"{name} ({', '.join(polygons)})"


def _path(xy) -> str:
    return "(" + ", ".join(" ".join(number(v) for v in row) for row in xy.tolist()) + ")"


def decode_wkt(text: str):
    """Geometry of a WKT text; ValueError if malformed."""
    match = _TAGGED.fullmatch(text)
    if not match or match[1].upper() not in _TYPE_CODES:
        raise ValueError(f"not WKT: {text[:40]!r}")
    kind, dims = _TYPE_CODES[match[1].upper()], (match[2] or "").upper()
    if match[3].upper() == "EMPTY":
        flat = kind in (POINT, LINESTRING, MULTIPOINT)
        return kind, dims, np.empty((0, width(dims))) if flat else []
    inner = match[3][1:-1]
    if kind == COLLECTION:
        return kind, dims, [decode_wkt(t) for t in _top_level(inner)]
    if kind == MULTIPOINT:
        inner = _FLAT_GROUP.sub(r"\1", inner)
    if kind in (POINT, LINESTRING, MULTIPOINT):
        body, dims = _numbers(inner, dims)
        if kind == POINT and len(body) != 1:
            raise ValueError("a point has one vertex")
        return kind, dims, body
    if kind in (POLYGON, MULTILINESTRING):
        groups = [_FLAT_GROUP.findall(_only_groups(_FLAT_GROUP, inner))]
    else:
        groups = [_FLAT_GROUP.findall(g) for g in _NESTED_GROUP.findall(_only_groups(_NESTED_GROUP, inner))]
    paths = []
    for group in groups:
        paths.append([])
        for path in group:
            xy, dims = _numbers(path, dims)
            paths[-1].append(xy)
    return kind, dims, paths if kind == MULTIPOLYGON else paths[0]


def _only_groups(pattern, text: str) -> str:
    if not _SEPARATORS.fullmatch(pattern.sub("", text)):
        raise ValueError("unbalanced parentheses in WKT")
    return text


def _numbers(text: str, dims: str):
    rows = [row.split() for row in text.split(",")]
    size = len(rows[0])
    if any(len(row) != size for row in rows) or size not in ((width(dims),) if dims else (2, 3, 4)):
        raise ValueError("vertices of unequal length in WKT")
    return np.array(rows, dtype="f8"), dims or ("", "Z", "ZM")[size - 2]


def _top_level(text: str):
    depth, start = 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            yield text[start:i]
            start = i + 1
    yield text[start:]


# ---------------------------------------------------------------- shape of a geometry

def rings(geom) -> list:
    """All coordinate arrays of a geometry, part by part."""
    kind, _, body = geom
    if kind == COLLECTION:
        return [r for g in body for r in rings(g)]
    if kind in (POINT, LINESTRING, MULTIPOINT):
        return [body]
    if kind in (POLYGON, MULTILINESTRING):
        return list(body)
    return [r for polygon in body for r in polygon]


def with_rings(geom, change):
    """The same geometry with ``change`` applied to every coordinate array."""
    kind, dims, body = geom
    if kind == COLLECTION:
        return kind, dims, [with_rings(g, change) for g in body]
    if kind in (POINT, LINESTRING, MULTIPOINT):
        return kind, dims, change(body)
    if kind in (POLYGON, MULTILINESTRING):
        return kind, dims, [change(r) for r in body]
    return kind, dims, [[change(r) for r in polygon] for polygon in body]
