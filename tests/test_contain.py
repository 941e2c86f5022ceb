"""Containment of batches against the rules pair by pair."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from strandline.functions import codec, contain, predicates
from strandline.functions.geometry import _parts, parts_batch, wkb_from_wkt


def ring(points):
    return "(" + ", ".join(f"{x} {y}" for x, y in [*points, points[0]]) + ")"


def shape(rng, sizes=(0.5, 1, 3, 6)):
    def near():
        return rng.randint(0, 12) / 2, rng.randint(0, 12) / 2
    x, y = near()
    w, h = rng.choice(sizes), rng.choice(sizes)
    box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    hole = [(x + w / 4, y + h / 4), (x + w / 4, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h / 4)]
    bent = [(x, y), (x + 4, y), (x + 4, y + 4), (x + 2, y + 4), (x + 2, y + 2), (x, y + 2)]
    star = [(x + 3 * np.cos(t) * s, y + 3 * np.sin(t) * s) for t, s in zip(np.arange(10) * np.pi / 5, itertools.cycle([1, 0.4]))]
    return rng.choice([
        f"POINT ({x} {y})", f"MULTIPOINT ({x} {y}, {x + 1} {y + 0.5})", f"LINESTRING ({x} {y}, {x + w} {y + h})",
        f"LINESTRING ({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y})", f"LINESTRING ({x} {y}, {x} {y})",
        f"MULTILINESTRING (({x} {y}, {x + w} {y}), ({x + w / 2} {y}, {x + w} {y}))",
        f"POLYGON ({ring(box)})", f"POLYGON ({ring(box)})", f"POLYGON ({ring(box)}, {ring(hole)})", f"POLYGON ({ring(bent)})",
        f"POLYGON ({ring(star)})", f"POLYGON (({x} {y}, {x + 1} {y + 1}, {x} {y}))",
        f"MULTIPOLYGON (({ring(box)}), ({ring([(a + 7, b) for a, b in hole])}))",
        f"MULTIPOLYGON (({ring(hole)}), ({ring([(a + w / 4, b) for a, b in hole])}))", "POLYGON EMPTY", "MULTIPOLYGON EMPTY",
        "LINESTRING EMPTY"])


@pytest.mark.parametrize("at_once", [1, 50, 400_000])
def test_batches_agree_with_single_pairs(monkeypatch, at_once):
    monkeypatch.setattr(contain, "AT_ONCE", at_once)
    rng = random.Random(4)
    n = 3000 if at_once > 50 else 700
    pairs = [(wkb_from_wkt(shape(rng, (3, 6, 12))), wkb_from_wkt(shape(rng))) for _ in range(n)]
    pairs += [(a, a) for a, _ in pairs[:200]]
    held, done = contain.contains_batch(*(pa.array(x, pa.binary()) for x in zip(*pairs)))
    want = [predicates.contains(*map(codec.decode_wkb, p)) for p in pairs]
    kinds = [(codec.decode_wkb(a)[0], codec.decode_wkb(b)[0]) for a, b in pairs]
    wrong = [(codec.encode_wkt(codec.decode_wkb(a)), codec.encode_wkt(codec.decode_wkb(b)), w, bool(h))
             for (a, b), w, h, d in zip(pairs, want, held, done) if d and bool(h) != w]
    assert wrong == []
    assert all(d or (a not in predicates.AREAS and b in predicates.POINTS) for (a, b), d in zip(kinds, done))
    assert sum(want[:n]) > 10


def test_values_left_to_the_slow_path():
    texts = [None, "GEOMETRYCOLLECTION (POINT (1 1))", "POINT Z (1 1 1)", "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0))"]
    wkb = [None if t is None else wkb_from_wkt(t) for t in texts]
    held, done = contain.contains_batch(pa.array([wkb[3]] * 4, pa.binary()), pa.array(wkb, pa.binary()))
    assert done.tolist() == [False, False, False, True] and held.tolist() == [False, False, False, True]
    held, done = contain.contains_batch(pa.array([], pa.binary()), pa.array([], pa.binary()))
    assert len(held) == len(done) == 0


def test_inner_points_of_polygons_with_many_flat_steps():
    steps = [(i // 2, (i + 1) // 2) for i in range(80)]
    body = wkb_from_wkt(f"POLYGON ({ring([*steps, (0, 40)])})")
    lid = wkb_from_wkt("POLYGON ((-1 -1, 99 -1, 99 99, -1 99, -1 -1))")
    held, done = contain.contains_batch(pa.array([lid, body], pa.binary()), pa.array([body, lid], pa.binary()))
    assert done.all() and held.tolist() == [True, False]


def test_parts_of_batches_equal_those_of_single_values():
    rng = random.Random(8)
    texts = [shape(rng) for _ in range(400)] + [
        None, "GEOMETRYCOLLECTION (POINT (1 1), LINESTRING (0 0, 1 1))", "POINT Z (1 1 1)", "POINT EMPTY", "MULTIPOINT EMPTY", "MULTIPOINT (1 2)"]
    for some in (texts, texts[:400], [None, None], []):
        wkb = pa.array([None if t is None else wkb_from_wkt(t) for t in some], pa.binary())
        assert parts_batch(wkb).to_pylist() == _parts(wkb).to_pylist()
