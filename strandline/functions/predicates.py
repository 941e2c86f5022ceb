"""Exact relations between two geometries, as small numpy helpers.

``contains`` follows the usual simple-features reading: every point of the inner
geometry lies in the outer one and their interiors meet, so a point on the
boundary of a polygon is not contained while a polygon contains itself.
"""

from __future__ import annotations

import numpy as np

from strandline.functions import codec

OUTSIDE, BOUNDARY, INSIDE = -1, 0, 1
AREAS = (codec.POLYGON, codec.MULTIPOLYGON)
LINES = (codec.LINESTRING, codec.MULTILINESTRING)
POINTS = (codec.POINT, codec.MULTIPOINT)
# Midpoints of split segments are rounded; they count as lying on an edge within this share of the coordinate size.
ROUNDING = 1e-12
CUT_MARGIN = 1e-9
# Point and segment pairs compared in one numpy operation.
COMPARISONS = 1_000_000


def edges(geom) -> np.ndarray:
    """``(n, 4)`` array of x1, y1, x2, y2 over all rings or lines."""
    parts = [np.hstack([r[:-1, :2], r[1:, :2]]) for r in codec.rings(geom) if len(r) > 1]
    return np.concatenate(parts) if parts else np.empty((0, 4))


def _blocks(xy: np.ndarray, lines: np.ndarray):
    """Slices of ``xy`` small enough to be compared with all ``lines`` at once."""
    step = max(1, COMPARISONS // max(1, len(lines)))
    return [xy[i:i + step] for i in range(0, len(xy), step)]


def locate(xy: np.ndarray, area_edges: np.ndarray, slack: float = 0.0) -> np.ndarray:
    """INSIDE, BOUNDARY or OUTSIDE for each row of ``xy`` against a polygon's edges."""
    x1, y1, x2, y2 = area_edges.T
    run = (x2 - x1) / np.where(y2 == y1, 1.0, y2 - y1)
    sides = []
    for block in _blocks(xy, area_edges):
        x, y = block[:, :1], block[:, 1:2]
        crossing = ((y1 > y) != (y2 > y)) & (x < run * (y - y1) + x1)
        side = np.where(crossing.sum(axis=1) % 2 == 1, INSIDE, OUTSIDE)
        side[on_edges(block, area_edges, slack)] = BOUNDARY
        sides.append(side)
    return np.concatenate(sides) if sides else np.empty(0, int)


def on_edges(xy: np.ndarray, lines: np.ndarray, slack: float = 0.0) -> np.ndarray:
    """Whether each row of ``xy`` lies on one of the segments."""
    x1, y1, x2, y2 = lines.T
    margin = slack * np.hypot(x2 - x1, y2 - y1)
    hits = []
    for block in _blocks(xy, lines):
        x, y = block[:, :1], block[:, 1:2]
        near = np.abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) <= margin
        near &= (x >= np.minimum(x1, x2) - slack) & (x <= np.maximum(x1, x2) + slack)
        near &= (y >= np.minimum(y1, y2) - slack) & (y <= np.maximum(y1, y2) + slack)
        hits.append(near.any(axis=1))
    return np.concatenate(hits) if hits else np.empty(0, bool)


def pieces(lines: np.ndarray, cutters: np.ndarray) -> np.ndarray:
    """Midpoints of ``lines`` after cutting them wherever they meet ``cutters``."""
    mids = []
    cx, cy = cutters[:, 0], cutters[:, 1]
    sx, sy = cutters[:, 2] - cx, cutters[:, 3] - cy
    for x1, y1, x2, y2 in lines:
        rx, ry = x2 - x1, y2 - y1
        norm = rx * rx + ry * ry
        if norm == 0:
            mids.append([[x1, y1]])
            continue
        qx, qy = cx - x1, cy - y1
        det = rx * sy - ry * sx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (qx * sy - qy * sx) / det
            u = (qx * ry - qy * rx) / det
        proper = (det != 0) & (u >= -CUT_MARGIN) & (u <= 1 + CUT_MARGIN)  # a spare cut does no harm, a missed one does
        flat = det == 0
        ends = np.concatenate([qx[flat] * rx + qy[flat] * ry, (qx + sx)[flat] * rx + (qy + sy)[flat] * ry]) / norm
        cuts = np.concatenate([[0.0, 1.0], t[proper], ends])
        cuts = np.unique(cuts[(cuts >= 0) & (cuts <= 1)])
        middle = (cuts[1:] + cuts[:-1]) / 2
        mids.append(np.column_stack([x1 + middle * rx, y1 + middle * ry]))
    return np.concatenate(mids) if mids else np.empty((0, 2))


def interior_point(polygon) -> np.ndarray:
    """A point strictly inside one polygon, given as its list of rings."""
    lines = edges((codec.POLYGON, "", polygon))
    heights = np.unique(lines[:, 1])
    best, gap = None, 0.0
    for y in (heights[1:] + heights[:-1]) / 2:
        cut = lines[(lines[:, 1] > y) != (lines[:, 3] > y)]
        xs = np.sort(cut[:, 0] + (y - cut[:, 1]) * (cut[:, 2] - cut[:, 0]) / (cut[:, 3] - cut[:, 1]))
        spans = xs[1::2] - xs[0::2]
        if len(spans) and spans.max() > gap:
            gap = spans.max()
            best = (xs[0::2][spans.argmax()] + gap / 2, y)
    return np.array([best]) if best else np.empty((0, 2))


def contains(outer, inner):
    """True, False, or None where the pair of types is not supported."""
    if codec.COLLECTION in (outer[0], inner[0]):
        return None
    if not sum(map(len, codec.rings(outer))) or not sum(map(len, codec.rings(inner))):
        return False
    if outer[0] in AREAS:
        return _in_area(outer, inner)
    if outer[0] in POINTS:
        if inner[0] not in POINTS:
            return False
        held = set(map(tuple, outer[2][:, :2].tolist()))
        return all(tuple(p) in held for p in inner[2][:, :2].tolist())
    return _in_lines(outer, inner)


def _slack(*geoms) -> float:
    return ROUNDING * max(1.0, *(np.abs(r[:, :2]).max() for g in geoms for r in codec.rings(g) if len(r)))


def _in_area(outer, inner):
    walls = edges(outer)
    if inner[0] in POINTS:
        sides = locate(inner[2], walls)
        return bool((sides != OUTSIDE).all() and (sides == INSIDE).any())
    slack, lines = _slack(outer, inner), edges(inner)
    sides = locate(pieces(lines, walls), walls, slack)
    if (sides == OUTSIDE).any():
        return False
    if inner[0] in LINES:
        return bool((sides == INSIDE).any())
    if (locate(pieces(walls, lines), lines, slack) == INSIDE).any():
        return False
    polygons = [inner[2]] if inner[0] == codec.POLYGON else inner[2]
    witnesses = np.concatenate([interior_point(p) for p in polygons])
    return bool(len(witnesses) and (locate(witnesses, walls) == INSIDE).all())


def _in_lines(outer, inner):
    if inner[0] in AREAS:
        return False
    lines = edges(outer)
    if inner[0] in LINES:
        return bool(on_edges(pieces(edges(inner), lines), lines, _slack(outer, inner)).all())
    xy = inner[2][:, :2]
    ends = {}
    for path in codec.rings(outer):
        for tip in (tuple(path[0, :2]), tuple(path[-1, :2])) if len(path) else ():
            ends[tip] = ends.get(tip, 0) + 1
    inside = on_edges(xy, lines)
    tips = np.array([ends.get(tuple(p), 0) % 2 == 1 for p in xy.tolist()])
    return bool(inside.all() and (~tips).any())


def equals_within(left, right, tolerance: float) -> bool:
    """Same type and structure, and every vertex at most ``tolerance`` from its twin."""
    if left[0] != right[0] or left[1] != right[1]:
        return False
    if left[0] == codec.COLLECTION:
        return len(left[2]) == len(right[2]) and all(
            equals_within(a, b, tolerance) for a, b in zip(left[2], right[2]))
    if left[0] == codec.MULTIPOLYGON and [len(p) for p in left[2]] != [len(p) for p in right[2]]:
        return False
    a, b = codec.rings(left), codec.rings(right)
    return len(a) == len(b) and all(
        p.shape == q.shape and bool((np.hypot(*(p[:, :2] - q[:, :2]).T) <= tolerance).all()) for p, q in zip(a, b))
