"""Where the coordinates of a batch of geometries lie in their bytes, found for all of them at once.

A batch of little-endian two-dimensional WKB of any type but collections is walked structure by structure: every
step reads the next count of all geometries that have one. What comes out are runs of coordinates, so boxes,
projections and texts of lines and polygons are array operations. Other geometries are marked as left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strandline.functions import codec


@dataclass
class Layout:
    """``ok`` and ``kind`` by row; by run its row, the number of its part in the row, first byte and coordinates."""

    data: np.ndarray
    offsets: np.ndarray
    ok: np.ndarray
    kind: np.ndarray
    row: np.ndarray
    part: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def places(self) -> np.ndarray:
        """The first byte of every coordinate pair, in order."""
        begin = np.cumsum(self.count) - self.count
        return np.repeat(self.start - 16 * begin, self.count) + 16 * np.arange(self.count.sum())

    def coordinates(self) -> np.ndarray:
        """All coordinate pairs, in order."""
        cells = self.data[self.places()[:, None] + np.arange(16)]
        return np.ascontiguousarray(cells).view("<f8").reshape(-1, 2)

    def with_coordinates(self, xy: np.ndarray) -> pa.Array:
        """The geometries with other coordinates; rows that are not ``ok`` are null."""
        data = self.data.copy()
        data[self.places()[:, None] + np.arange(16)] = (
            np.ascontiguousarray(xy + 0.0, "<f8").view(np.uint8).reshape(-1, 16))
        out = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.ok), [None, pa.py_buffer(self.offsets.tobytes()), pa.py_buffer(data.tobytes())])
        return pc.if_else(pa.array(self.ok), out.cast(pa.binary()), pa.scalar(None, pa.binary()))

    def per_row(self) -> np.ndarray:
        """How many coordinate pairs each row has."""
        return np.bincount(self.row, self.count, len(self.ok)).astype(np.int64)

    def boxes(self) -> np.ndarray:
        """xmin, ymin, xmax, ymax by row; NaN where there is no coordinate."""
        xy, n = self.coordinates(), self.per_row()
        out = np.full((len(n), 4), np.nan)
        filled = np.flatnonzero(n)
        if len(filled):
            heads = (np.cumsum(n) - n)[filled]
            out[filled, :2] = np.minimum.reduceat(xy, heads)
            out[filled, 2:] = np.maximum.reduceat(xy, heads)
        return out

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Segments of all runs (x1, y1, x2, y2), and how many each row has."""
        xy, ends = self.coordinates(), np.cumsum(self.count)[self.count > 0]
        first = np.ones(len(xy), bool)
        first[ends - 1] = False
        at = np.flatnonzero(first)
        segments = np.maximum(self.count - 1, 0)
        return np.column_stack([xy[at], xy[at + 1]]), np.bincount(self.row, segments, len(self.ok)).astype(np.int64)


def turns(found: Layout, segments: np.ndarray, number: np.ndarray) -> np.ndarray:
    """By row, of its ``edges()``: 1 or -1 for a convex polygon without holes, as it runs left or right, 0 for all others."""
    n = len(found.ok)
    row = np.repeat(np.arange(n), number)
    first = np.cumsum(number) - number
    follow = np.arange(len(segments)) + 1
    ends = (first + number - 1)[number > 0]
    follow[ends] = first[number > 0]
    step = segments[:, 2:] - segments[:, :2]
    after = step[follow]
    with np.errstate(over="ignore", invalid="ignore"):  # too large to tell: not convex
        cross = step[:, 0] * after[:, 1] - step[:, 1] * after[:, 0]
        ahead = (step * after).sum(axis=1)
    left, right, bent = (np.bincount(row[c], minlength=n) for c in (
        cross > 0, cross < 0, ((cross == 0) & (ahead <= 0)) | ~np.isfinite(cross) | (segments[:, 2:] != segments[follow, :2]).any(axis=1)))
    around = np.abs(np.bincount(row, np.nan_to_num(np.arctan2(cross, ahead)), n))  # once, and not like a star
    convex = (found.kind == codec.POLYGON) & (np.bincount(found.row, minlength=n) == 1) & (bent == 0) & (around < 6.5)
    return np.where(convex & (right == 0) & (left > 0), 1, np.where(convex & (left == 0) & (right > 0), -1, 0))


def layout(wkb: pa.Array) -> Layout:
    """The layout of a batch."""
    if isinstance(wkb, pa.ChunkedArray):
        wkb = wkb.combine_chunks()
    wide = wkb.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = wide.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[:offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    ends = offsets[1:]
    ok = wide.is_valid().to_numpy(zero_copy_only=False) & (ends - offsets[:-1] >= 9)
    kind = np.zeros(len(wide), np.int64)
    at = offsets[:-1].copy()
    found: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]] = []

    def number(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next unsigned integer of each row, and the rows that have one; moves behind it."""
        fits = at[rows] + 4 <= ends[rows]
        ok[rows[~fits]] = False
        rows = rows[fits]
        cells = data[at[rows][:, None] + np.arange(4)] if len(rows) else np.zeros((0, 4), np.uint8)
        at[rows] += 4
        return np.ascontiguousarray(cells).view("<u4").ravel().astype(np.int64), rows

    def head(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The type number behind the byte order mark."""
        fits = at[rows] < ends[rows]
        fits[fits] = data[at[rows[fits]]] == 1
        ok[rows[~fits]] = False
        rows = rows[fits]
        at[rows] += 1
        return number(rows)

    def run(rows: np.ndarray, part: int, count: np.ndarray) -> None:
        fits = at[rows] + 16 * count <= ends[rows]
        ok[rows[~fits]] = False
        rows, count = rows[fits], count[fits]
        found.append((rows, part, at[rows].copy(), count))
        at[rows] += 16 * count

    def simple(rows: np.ndarray, types: np.ndarray, part: int) -> None:
        points = rows[types == codec.POINT]
        run(points, part, np.ones(len(points), np.int64))
        count, lines = number(rows[types == codec.LINESTRING])
        run(lines, part, count)
        rings, polygons = number(rows[types == codec.POLYGON])
        for k in range(int(rings.max(initial=0))):
            more = (rings > k) & ok[polygons]
            rings, polygons = rings[more], polygons[more]
            count, those = number(polygons)
            run(those, part, count)

    types, rows = head(np.flatnonzero(ok))
    known = (types >= codec.POINT) & (types <= codec.MULTIPOLYGON)
    ok[rows[~known]] = False
    rows, types = rows[known], types[known]
    kind[rows] = types
    simple(rows[types <= codec.POLYGON], types[types <= codec.POLYGON], 0)
    parts, many = number(rows[types > codec.POLYGON])
    for k in range(int(parts.max(initial=0))):
        more = (parts > k) & ok[many]
        parts, many = parts[more], many[more]
        types, those = head(many)
        right = types == kind[those] - 3
        ok[those[~right]] = False
        simple(those[right], types[right], k)
    ok &= at == ends
    if found:
        row = np.concatenate([f[0] for f in found])
        part = np.concatenate([np.full(len(f[0]), f[1]) for f in found])
        start, count = (np.concatenate([f[i] for f in found]) for i in (2, 3))
        order = np.argsort(row, kind="stable")  # runs of a row were found in their order
        order = order[ok[row[order]]]
        row, part, start, count = row[order], part[order], start[order], count[order]
    else:
        row = part = start = count = np.zeros(0, np.int64)
    out = Layout(data, offsets, ok, kind, row, part, start, count)
    lone = np.flatnonzero(kind[row] == codec.POINT)  # an empty point is written as NaN
    if len(lone):
        cells = np.ascontiguousarray(data[start[lone][:, None] + np.arange(8)]).view("<f8").ravel()
        if np.isnan(cells).any():
            ok[row[lone[np.isnan(cells)]]] = False
            stay = ok[row]
            out = Layout(data, offsets, ok, kind, row[stay], part[stay], start[stay], count[stay])
    return out


def texts(found: Layout) -> pa.Array:
    """WKT of the rows that are ``ok`` and not empty in any part, null for the others."""
    n = len(found.ok)
    whole = found.ok & (found.per_row() > 0)
    if (found.count == 0).any():
        whole[found.row[found.count == 0]] = False
    pairs = found.coordinates()
    numbers = list(map(codec.number, pairs.ravel().tolist()))
    pair = pa.array([f"{x} {y}" for x, y in zip(numbers[::2], numbers[1::2], strict=True)], pa.string())

    def joined(values: pa.Array, counts: np.ndarray) -> pa.Array:
        offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values), ", ")

    def wrapped(values: pa.Array, where: np.ndarray) -> pa.Array:
        return pc.if_else(pa.array(where, pa.bool_()), pc.binary_join_element_wise("(", values, ")", ""), values)

    kind = found.kind[found.row]
    runs = joined(pair, found.count)
    runs = wrapped(runs, np.isin(kind, (codec.POLYGON, codec.MULTILINESTRING, codec.MULTIPOLYGON)))
    if len(found.row):
        heads = np.flatnonzero(np.r_[True, (np.diff(found.row) != 0) | (np.diff(found.part) != 0)])
        parts = joined(runs, np.diff(np.r_[heads, len(found.row)]))
        parts = wrapped(parts, kind[heads] == codec.MULTIPOLYGON)
        rows = joined(parts, np.bincount(found.row[heads], minlength=n))
    else:
        rows = pa.array([""] * n, pa.string())
    names = pa.array([codec.TYPE_NAMES.get(int(k), "") for k in found.kind], pa.string())
    return pc.if_else(pa.array(whole), pc.binary_join_element_wise(names, " (", rows, ")", ""),
                      pa.scalar(None, pa.string()))


def with_others(fast: pa.Array, done: np.ndarray, wkb: pa.Array, slow: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``fast`` where ``done``; ``slow`` of the other values in their places."""
    if done.all():
        return fast
    others = np.flatnonzero(~done)
    rest = slow(wkb.take(pa.array(others)))
    at = np.arange(len(done))
    at[others] = len(done) + np.arange(len(others))
    return pa.concat_arrays([fast, rest.cast(fast.type)]).take(pa.array(at))


# ---------------------------------------------------------------- from texts

_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
_PAIR = rf"\s*{_NUMBER}\s+{_NUMBER}\s*"
_RUN = rf"\s*\({_PAIR}(?:,{_PAIR})*\)\s*"
_RUNS = rf"\s*\({_RUN}(?:,{_RUN})*\)\s*"
# The text of each type that is read as arrays: plain, two-dimensional and not empty.
_TEXTS = {
    codec.POINT: rf"\s*\({_PAIR}\)\s*", codec.LINESTRING: _RUN, codec.POLYGON: _RUNS, codec.MULTIPOINT: _RUN,
    codec.MULTILINESTRING: _RUNS, codec.MULTIPOLYGON: rf"\s*\({_RUNS}(?:,{_RUNS})*\)\s*",
}
# How deep in brackets the runs of coordinates of each type lie.
_DEPTH = np.array([0, 1, 1, 2, 1, 2, 3])


def from_texts(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(WKB by row, which rows were read); null where the text is not of the plain forms."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    kind = np.zeros(len(text), np.int64)
    for code, body in _TEXTS.items():
        found = pc.match_substring_regex(text, rf"(?i)^\s*{codec.TYPE_NAMES[code]}{body}$")
        kind[pc.fill_null(found, False).to_numpy(zero_copy_only=False)] = code
    rows = np.flatnonzero(kind)
    done = kind > 0
    if not len(rows):
        return pa.nulls(len(text), pa.binary()), done
    kind = kind[rows]
    chosen = text.take(pa.array(rows)).cast(pa.large_string())
    ends = np.frombuffer(chosen.buffers()[1], np.int64)[chosen.offset + 1:chosen.offset + len(chosen) + 1]
    data = np.frombuffer(chosen.buffers()[2], np.uint8)[:ends[-1]]
    opens, closes = data == ord("("), data == ord(")")
    depth = np.cumsum(opens.astype(np.int64) - closes)
    row = np.searchsorted(ends, np.arange(len(data)), side="right")
    level = _DEPTH[kind][row]
    # runs, their rows and coordinates; a multipoint has a run for each
    begin = np.flatnonzero(opens & (depth == level))
    commas = np.flatnonzero((data == ord(",")) & (depth == level))
    count = 1 + np.bincount(np.searchsorted(begin, commas) - 1, minlength=len(begin))
    owner = row[begin]
    part = np.searchsorted(np.flatnonzero(opens & (depth == 2) & (level == 3)), begin)
    lone = kind[owner] == codec.MULTIPOINT
    repeat = np.where(lone, count, 1)
    owner, part = np.repeat(owner, repeat), np.repeat(part, repeat)
    count = np.where(np.repeat(lone, repeat), 1, np.repeat(count, repeat))
    inside = np.where((depth > 0) & ~opens & ~closes & (data != ord(",")), data, ord(" ")).astype(np.uint8)
    xy = np.array(inside.tobytes().split(), dtype="S").astype(np.float64).reshape(-1, 2) + 0.0

    types = kind[owner]
    first = np.r_[True, np.diff(owner) != 0]
    opening = first | np.r_[True, np.diff(part) != 0]
    own = np.choose(types, [0, 0, 4, 4, 5, 9, 4])  # bytes before a run's coordinates that are its own
    lead = own + first * np.choose(types, [0, 5, 5, 9, 9, 9, 9]) + 9 * (opening & (types == codec.MULTIPOLYGON))
    size = lead + 16 * count
    at = np.cumsum(size) - size
    out = np.zeros(size.sum(), np.uint8)
    coordinates = at + lead

    def put(places: np.ndarray, values: np.ndarray) -> None:
        out[places[:, None] + np.arange(4)] = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)

    def head(places: np.ndarray, code: np.ndarray) -> None:
        out[places] = 1
        put(places + 1, code)
    spots = np.repeat(coordinates - 16 * (np.cumsum(count) - count), count) + 16 * np.arange(count.sum())
    out[spots[:, None] + np.arange(16)] = np.ascontiguousarray(xy, "<f8").view(np.uint8).reshape(-1, 16)
    heads = np.flatnonzero(first)
    head(at[heads], kind)
    counted = np.isin(types, (codec.LINESTRING, codec.POLYGON, codec.MULTILINESTRING, codec.MULTIPOLYGON))
    put(coordinates[counted] - 4, count[counted])
    several = kind > codec.LINESTRING
    number = np.bincount(owner, opening if (kind == codec.MULTIPOLYGON).all() else np.where(
        types == codec.MULTIPOLYGON, opening, True), len(rows)).astype(np.int64)
    put(at[heads[several]] + 5, number[several])
    for code, child, before in ((codec.MULTIPOINT, codec.POINT, 5), (codec.MULTILINESTRING, codec.LINESTRING, 9)):
        inner = np.flatnonzero(types == code)
        head(coordinates[inner] - before, np.full(len(inner), child))
    polygons = np.flatnonzero(opening & (types == codec.MULTIPOLYGON))
    if len(polygons):
        head(coordinates[polygons] - 13, np.full(len(polygons), codec.POLYGON))
        flat = np.flatnonzero(types == codec.MULTIPOLYGON)
        group = np.cumsum(opening[flat]) - 1
        put(coordinates[polygons] - 8, np.bincount(group))
    offsets = np.r_[at[heads], len(out)]
    made = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])
    back = np.full(len(text), len(rows))
    back[rows] = np.arange(len(rows))
    return pa.concat_arrays([made.cast(pa.binary()), pa.nulls(1, pa.binary())]).take(pa.array(back)), done
