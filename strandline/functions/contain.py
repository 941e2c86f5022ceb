"""Containment of whole batches of pairs, as arrays of segments and points of all pairs at once.

The rules are those of ``predicates.contains``: the inner lines, cut where they meet the outer walls, must lie in the
outer area and reach its inside; for areas no wall may run inside the inner one, and a point inside it must lie inside the
outer one. Every step compares the points or segments of a pair with the segments of its partner, for as many pairs at
once as have a bounded number of comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from strandline.functions import arrays, codec
from strandline.functions.predicates import AREAS, BOUNDARY, CUT_MARGIN, INSIDE, LINES, OUTSIDE, POINTS, ROUNDING

# Comparisons of one numpy operation; one point or segment with all walls of its pair at least.
AT_ONCE = 400_000
# Heights at which a point inside a polygon is looked for first.
HEIGHTS = 16


@dataclass
class Walls:
    """Segments x1, y1, x2, y2, of each pair in a row: its first one and their number."""

    xy: np.ndarray
    first: np.ndarray
    number: np.ndarray


def _blocks(cost: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of elements with about AT_ONCE comparisons."""
    ends, at = np.cumsum(cost), 0
    while at < len(cost):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, side="right"))
        stop = max(stop, at + 1)
        yield at, stop
        at = stop


def _against(walls: Walls, pair: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of elements, each with all walls of its pair: first and end element, element and wall of each comparison."""
    number = walls.number[pair]
    for a, b in _blocks(number):
        n = number[a:b]
        element = np.repeat(np.arange(a, b), n)
        wall = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - walls.first[pair[a:b]], n)
        yield a, b, element, wall


def _on(x: np.ndarray, y: np.ndarray, wall: np.ndarray, slack: np.ndarray) -> np.ndarray:
    x1, y1, x2, y2 = wall.T
    near = np.abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) <= slack * np.hypot(x2 - x1, y2 - y1)
    near &= (x >= np.minimum(x1, x2) - slack) & (x <= np.maximum(x1, x2) + slack)
    return near & (y >= np.minimum(y1, y2) - slack) & (y <= np.maximum(y1, y2) + slack)


def located(xy: np.ndarray, pair: np.ndarray, walls: Walls, slack: np.ndarray) -> np.ndarray:
    """INSIDE, BOUNDARY or OUTSIDE of each point against the walls of its pair."""
    sides = np.full(len(xy), OUTSIDE)
    for a, b, point, at in _against(walls, pair):
        wall = walls.xy[at]
        x, y = xy[point].T
        x1, y1, x2, y2 = wall.T
        run = (x2 - x1) / np.where(y2 == y1, 1.0, y2 - y1)
        crossing = ((y1 > y) != (y2 > y)) & (x < run * (y - y1) + x1)
        sides[a:b][np.bincount(point[crossing] - a, minlength=b - a) % 2 == 1] = INSIDE
        sides[a:b][np.bincount(point[_on(x, y, wall, slack[pair[point]])] - a, minlength=b - a) > 0] = BOUNDARY
    return sides


def lying_on(xy: np.ndarray, pair: np.ndarray, walls: Walls, slack: np.ndarray) -> np.ndarray:
    """Whether each point lies on a wall of its pair."""
    out = np.zeros(len(xy), bool)
    for a, b, point, at in _against(walls, pair):
        x, y = xy[point].T
        out[a:b] = np.bincount(point[_on(x, y, walls.xy[at], slack[pair[point]])] - a, minlength=b - a) > 0
    return out


def cut(lines: np.ndarray, pair: np.ndarray, walls: Walls) -> tuple[np.ndarray, np.ndarray]:
    """Midpoints of the lines cut wherever they meet walls of their pair, and the pair of each."""
    mids, owners = [], []
    for a, b, line, at in _against(walls, pair):
        x1, y1, x2, y2 = lines[line].T
        cx, cy, ex, ey = walls.xy[at].T
        rx, ry, sx, sy, qx, qy = x2 - x1, y2 - y1, ex - cx, ey - cy, cx - x1, cy - y1
        norm, det = rx * rx + ry * ry, rx * sy - ry * sx
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (qx * sy - qy * sx) / det, (qx * ry - qy * rx) / det
            near, far = (qx * rx + qy * ry) / norm, ((qx + sx) * rx + (qy + sy) * ry) / norm
        proper = (det != 0) & (u >= -CUT_MARGIN) & (u <= 1 + CUT_MARGIN)  # a spare cut does no harm, a missed one does
        flat = (det == 0) & (norm > 0)
        own = np.arange(a, b)
        number = np.concatenate([own, own, line[proper], line[flat], line[flat]])
        where = np.concatenate([np.zeros(b - a), np.ones(b - a), t[proper], near[flat], far[flat]])
        inside = (where >= 0) & (where <= 1)
        number, where = number[inside], where[inside]
        order = np.lexsort((where, number))
        number, where = number[order], where[order]
        piece = (number[1:] == number[:-1]) & (where[1:] > where[:-1])
        number, middle = number[1:][piece], ((where[1:] + where[:-1]) / 2)[piece]
        start, end = lines[number, :2], lines[number, 2:]
        found = start + middle[:, None] * (end - start)
        mids.append(found)
        owners.append(pair[number])
    if not mids:
        return np.empty((0, 2)), np.empty(0, np.int64)
    return np.concatenate(mids), np.concatenate(owners)


def inner_points(polygons: Walls, few: int = HEIGHTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A point inside each polygon that has one: the points, their polygons, and polygons whose rings do not close.

    It is the middle of the widest stretch inside, at a few heights between vertices; at all of them if those have none.
    """
    n = len(polygons.number)
    of = np.repeat(np.arange(n), polygons.number)
    y = polygons.xy[:, 1]
    order = np.lexsort((y, of))
    of, y = of[order], y[order]
    new = (of[1:] == of[:-1]) & (y[1:] > y[:-1])
    height, owner = ((y[1:] + y[:-1]) / 2)[new], of[1:][new]
    if few:
        start = np.searchsorted(owner, np.arange(n))
        total = np.bincount(owner, minlength=n)
        place = np.arange(len(owner)) - start[owner]
        step = np.maximum(total // few, 1)[owner]
        height, owner = height[place % step == step // 2], owner[place % step == step // 2]
    xs, at = [], []
    for _, _, element, wall in _against(polygons, owner):
        x1, y1, x2, y2 = polygons.xy[wall].T
        h = height[element]
        crosses = (y1 > h) != (y2 > h)
        x1, y1, x2, y2, h = (v[crosses] for v in (x1, y1, x2, y2, h))
        xs.append(x1 + (h - y1) * (x2 - x1) / (y2 - y1))
        at.append(element[crosses])
    xs, at = (np.concatenate(v) if v else np.empty(0, t) for v, t in ((xs, float), (at, np.int64)))
    odd = np.bincount(at, minlength=len(owner)) % 2 == 1
    open_ones = np.unique(owner[odd])
    closed = ~np.isin(owner[at], open_ones)
    xs, at = xs[closed], at[closed]
    order = np.lexsort((xs, at))
    xs, at = xs[order].reshape(-1, 2), at[order][::2]
    gap = xs[:, 1] - xs[:, 0]
    order = np.lexsort((-gap, owner[at]))
    order = order[gap[order] > 0]
    _, heads = np.unique(owner[at[order]], return_index=True)
    best = order[heads]
    points, owners = np.column_stack([xs[best, 0] + gap[best] / 2, height[at[best]]]), owner[at[best]]
    missing = np.setdiff1d(np.flatnonzero(polygons.number), np.concatenate([owners, open_ones]))
    if few and len(missing):
        rest = Walls(polygons.xy, polygons.first, np.where(np.isin(np.arange(n), missing), polygons.number, 0))
        keep = np.repeat(np.isin(np.arange(n), missing), polygons.number)
        rest = Walls(polygons.xy[keep], np.cumsum(rest.number) - rest.number, rest.number)
        more, of_more, opened = inner_points(rest, 0)
        points, owners = np.concatenate([points, more]), np.concatenate([owners, of_more])
        open_ones = np.union1d(open_ones, opened)
    return points, owners, open_ones


def contains_batch(outer: pa.Array, inner: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each outer geometry contains the inner one, and which pairs were decided here: those of plain
    two-dimensional values but points in points or lines, and rings that do not close."""
    a, b = arrays.layout(outer), arrays.layout(inner)
    n = len(a.ok)
    out, done = np.zeros(n, bool), a.ok & b.ok
    filled = done & (a.per_row() > 0) & (b.per_row() > 0)
    out_area, out_line = np.isin(a.kind, AREAS), np.isin(a.kind, LINES)
    in_area, in_line, in_point = (np.isin(b.kind, k) for k in (AREAS, LINES, POINTS))
    done &= ~(filled & ~out_area & in_point)  # sets of points, ends of lines
    filled &= done
    (wall_xy, wall_n), (line_xy, line_n) = a.edges(), b.edges()
    walls = Walls(wall_xy, np.cumsum(wall_n) - wall_n, wall_n)
    lines = Walls(line_xy, np.cumsum(line_n) - line_n, line_n)
    wall_pair, line_pair = (np.repeat(np.arange(n), w.number) for w in (walls, lines))
    reach = np.ones(n)
    for found in (a, b):
        np.maximum.at(reach, np.repeat(found.row, found.count), np.abs(found.coordinates()).max(axis=1, initial=0))
    slack = ROUNDING * reach

    def any_of(pair: np.ndarray, true: np.ndarray) -> np.ndarray:
        return np.bincount(pair[true], minlength=n) > 0

    points = filled & out_area & in_point
    xy, pair = b.coordinates(), np.repeat(b.row, b.count)
    own = points[pair]
    sides = located(xy[own], pair[own], walls, np.zeros(n))
    out |= points & ~any_of(pair[own], sides == OUTSIDE) & any_of(pair[own], sides == INSIDE)

    rows = filled & out_area & (in_line | in_area)
    own = rows[line_pair]
    xy, pair = cut(line_xy[own], line_pair[own], walls)
    sides = located(xy, pair, walls, slack)
    rows &= ~any_of(pair, sides == OUTSIDE)
    out |= rows & in_line & any_of(pair, sides == INSIDE)

    rows &= in_area
    own = rows[wall_pair]
    xy, pair = cut(wall_xy[own], wall_pair[own], lines)
    rows &= ~any_of(pair, located(xy, pair, lines, slack) == INSIDE)
    runs = rows[b.row] & (b.count > 1)
    part = np.cumsum((np.diff(b.row, prepend=-1) != 0) | (np.diff(b.part, prepend=-1) != 0)) - 1
    pair_of_part = np.zeros(int(part.max(initial=-1)) + 1, np.int64)
    pair_of_part[part] = b.row
    number = np.bincount(part[runs], b.count[runs] - 1, len(pair_of_part)).astype(np.int64)
    polygons = Walls(line_xy[np.repeat(rows[b.row], np.maximum(b.count - 1, 0))], np.cumsum(number) - number, number)
    xy, polygon, unclosed = inner_points(polygons)
    pair = pair_of_part[polygon]
    sides = located(xy, pair, walls, np.zeros(n))
    out |= rows & any_of(pair, sides == INSIDE) & ~any_of(pair, sides != INSIDE)
    done[pair_of_part[unclosed]] = False

    rows = filled & out_line & in_line
    own = rows[line_pair]
    xy, pair = cut(line_xy[own], line_pair[own], walls)
    out |= rows & ~any_of(pair, ~lying_on(xy, pair, walls, slack))
    return out, done
