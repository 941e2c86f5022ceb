import random
import struct

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.functions import codec, predicates
from strandline.functions import geometry as geo

SHAPES = [
    "POINT (3 1.5)", "POINT EMPTY", "LINESTRING (0 0, 1 1, 5 2.5)", "LINESTRING EMPTY",
    "POLYGON ((0 0, 1 0, 1 1.5, 0 0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))", "POLYGON EMPTY",
    "MULTIPOINT (1 2, 3 4)", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.5 5.2, 5.6 5.2, 5.6 5.3, 5.5 5.2)))",
    "MULTIPOLYGON EMPTY", "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (1 2, 3 4.25))",
    "GEOMETRYCOLLECTION (GEOMETRYCOLLECTION (POINT (1 2)), POLYGON ((0 0, 1 0, 1 1, 0 0)))",
    "POINT Z (1 2 3)", "LINESTRING ZM (1 2 3 4, 5 6 7 8)", "POINT M (1 2 9)",
    "POINT (1e+20 1e-07)", "LINESTRING (0.1 0.30000000000000004, 1000000000000000 1e+16)",
]


@pytest.mark.parametrize("wkt", SHAPES)
def test_codec_agrees_with_duckdb(wkt):
    text, wkb = duckdb.execute("SELECT ST_AsText(CAST(? AS GEOMETRY)), ST_AsWKB(CAST(? AS GEOMETRY))", [wkt, wkt]).fetchone()
    geom = codec.decode_wkt(wkt)
    assert codec.encode_wkt(geom) == text
    assert codec.encode_wkb(geom) == bytes(wkb)
    assert codec.encode_wkb(codec.decode_wkb(bytes(wkb))) == bytes(wkb)
    assert codec.encode_wkt(codec.decode_wkb(bytes(wkb))) == text


finite = st.floats(allow_nan=False, allow_infinity=False, width=64)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(finite, finite), min_size=2, max_size=8))
def test_text_and_bytes_keep_every_double(points):
    geom = (codec.LINESTRING, "", np.array(points))
    back = codec.decode_wkt(codec.encode_wkt(codec.decode_wkb(codec.encode_wkb(geom))))
    assert np.array_equal(back[2], geom[2])


def test_equal_geometries_have_equal_bytes():
    assert codec.encode_wkb(codec.decode_wkt("POINT (-0.0 1)")) == codec.encode_wkb(codec.decode_wkt("POINT(0 1.0)"))
    big = struct.pack(">BIdd", 0, 1, 1.0, 2.0)
    extended = struct.pack("<BIIdd", 1, 1 | codec.EWKB_SRID, 4326, 1.0, 2.0)
    plain = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    assert {codec.encode_wkb(codec.decode_wkb(b)) for b in (big, extended, plain)} == {plain}
    z = struct.pack("<BIddd", 1, 1 | codec.EWKB_Z, 1.0, 2.0, 3.0)
    assert codec.encode_wkt(codec.decode_wkb(z)) == "POINT Z (1 2 3)"


@pytest.mark.parametrize("text", [
    "", "POINT", "POINT (1)", "POINT (1 2", "POINT (1 2, 3 4)", "CIRCLE (1 2)", "POLYGON ((0 0, 1 x, 1 1, 0 0))",
    "LINESTRING (1 2, 3)", "POLYGON ((0 0, 1 1, 0 1, 0 0)) tail", "MULTIPOLYGON ((0 0, 1 1, 0 1, 0 0))"])
def test_malformed_text_is_rejected(text):
    with pytest.raises(ValueError):
        codec.decode_wkt(text)


@pytest.mark.parametrize("data", [b"", b"\x01", b"\x07\x01\0\0\0", b"\x01\x63\0\0\0", b"\x01\x02\0\0\0\xff\xff\xff\xff",
                                  struct.pack("<BIdd", 1, 1, 1.0, 2.0) + b"x"])
def test_malformed_bytes_are_rejected(data):
    with pytest.raises(ValueError):
        codec.decode_wkb(data)


SQUARE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
HOLED = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
TWO = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))"


@pytest.mark.parametrize("outer,inner,expected", [
    (SQUARE, "POINT (5 5)", True), (SQUARE, "POINT (0 5)", False), (SQUARE, "POINT (0 0)", False),
    (SQUARE, "POINT (11 5)", False), (HOLED, "POINT (5 5)", False), (HOLED, "POINT (4 5)", False),
    (SQUARE, "MULTIPOINT (0 0, 5 5)", True), (SQUARE, "MULTIPOINT (0 0, 0 5)", False),
    (TWO, "MULTIPOINT (0.5 0.5, 5.5 5.5)", True), (TWO, "MULTIPOINT (0.5 0.5, 3 3)", False),
    (SQUARE, SQUARE, True), (HOLED, HOLED, True), (HOLED, SQUARE, False), (SQUARE, HOLED, True), (TWO, TWO, True),
    (HOLED, "POLYGON ((4 4, 6 4, 6 6, 4 6, 4 4))", False), (HOLED, "POLYGON ((1 1, 9 1, 9 9, 1 9, 1 1))", False),
    (HOLED, "POLYGON ((1 1, 3 1, 3 3, 1 3, 1 1))", True),
    (HOLED, "POLYGON ((1 1, 9 1, 9 9, 1 9, 1 1), (3 3, 7 3, 7 7, 3 7, 3 3))", True),
    (SQUARE, "POLYGON ((5 5, 15 5, 15 8, 5 8, 5 5))", False),
    ("POLYGON ((0 0, 10 0, 10 10, 5 5, 0 10, 0 0))", "POLYGON ((1 1, 9 1, 9 8, 1 8, 1 1))", False),
    (SQUARE, "LINESTRING (0 0, 10 0)", False), (SQUARE, "LINESTRING (0 0, 5 5)", True),
    (SQUARE, "LINESTRING (5 5, 15 5)", False), (HOLED, "LINESTRING (0 5, 10 5)", False),
    (HOLED, "LINESTRING (1 4, 9 4)", True), (SQUARE, "MULTILINESTRING ((1 1, 2 2), (0 0, 0 5))", True),
    ("LINESTRING (0 0, 2 2)", "POINT (1 1)", True), ("LINESTRING (0 0, 2 2)", "POINT (0 0)", False),
    ("LINESTRING (0 0, 2 0, 2 2, 0 0)", "POINT (0 0)", True), ("LINESTRING (0 0, 3 3)", "LINESTRING (1 1, 2 2)", True),
    ("LINESTRING (0 0, 3 3)", "LINESTRING (1 1, 4 4)", False), ("LINESTRING (0 0, 1 1)", SQUARE, False),
    ("POINT (1 1)", "POINT (1 1)", True), ("POINT (1 1)", "POINT (1 2)", False),
    ("MULTIPOINT (1 1, 2 2)", "POINT (2 2)", True), ("POINT (1 1)", "LINESTRING (1 1, 2 2)", False),
    (SQUARE, "POLYGON EMPTY", False), ("POLYGON EMPTY", "POINT (1 1)", False),
    (SQUARE, "GEOMETRYCOLLECTION (POINT (1 1))", None),
])
def test_contains(outer, inner, expected):
    assert predicates.contains(codec.decode_wkt(outer), codec.decode_wkt(inner)) is expected


def test_contains_itself_at_any_angle():
    rng = np.random.default_rng(3)
    for _ in range(50):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 9))
        ring = np.column_stack([np.cos(turn), np.sin(turn)]) * rng.uniform(0.5, 80, (9, 1)) + rng.uniform(-90, 90, 2)
        polygon = (codec.POLYGON, "", [np.vstack([ring, ring[:1]])])
        assert predicates.contains(polygon, polygon) is True


def test_location_in_blocks_is_the_same(monkeypatch):
    rng = np.random.default_rng(4)
    walls = predicates.edges(codec.decode_wkt(HOLED))
    xy = rng.integers(-2, 13, (200, 2)).astype(float)
    whole = predicates.locate(xy, walls)
    monkeypatch.setattr(predicates, "COMPARISONS", 20)
    assert np.array_equal(whole, predicates.locate(xy, walls))


@pytest.mark.parametrize("left,right,expected", [
    ("POINT (1 1)", "POINT (1.0005 1)", True), ("POINT (1 1)", "POINT (1.01 1)", False),
    ("POINT (1 1)", "POINT (1.0009 1.0009)", False), (SQUARE, HOLED, False), (SQUARE, SQUARE, True),
    ("POINT (1 1)", "MULTIPOINT (1 1)", False), (TWO, TWO, True), ("POINT EMPTY", "POINT EMPTY", True)])
def test_equals_within(left, right, expected):
    assert predicates.equals_within(codec.decode_wkt(left), codec.decode_wkt(right), 0.001) is expected


# ---------------------------------------------------------------- batches as arrays

def _any_shape(rng):
    def pair():
        return f"{rng.choice([0.0, -0.0, 1.5, -2.25, 1e-7, 1e10])!r} {rng.choice([0.0, -2.0, 179.99])!r}"

    def ring(n):
        return "(" + ", ".join(pair() for _ in range(n)) + ")"

    def rings():
        return "(" + ", ".join(ring(4) for _ in range(rng.randint(1, 3))) + ")"
    return rng.choice([
        lambda: f"POINT ({pair()})", lambda: "LINESTRING " + ring(rng.randint(2, 5)), lambda: "POLYGON " + rings(),
        lambda: "MULTIPOINT " + ring(rng.randint(1, 4)), lambda: "MULTILINESTRING " + rings(),
        lambda: "MULTIPOLYGON (" + ", ".join(rings() for _ in range(rng.randint(1, 3))) + ")",
        lambda: "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1))", lambda: "POINT Z (1 2 3)", lambda: None,
        lambda: rng.choice(["POLYGON EMPTY", "POINT EMPTY", "LINESTRING EMPTY", "MULTIPOLYGON EMPTY"])])()


def _spoiled(rng, text):
    if text is None or rng.random() < 0.6:
        return text
    return rng.choice([text.lower(), text.replace(", ", " ,  "), text.replace("(", "( "), text[:-1], text + ")", text.replace(" ", "", 1),
                       text.replace("1", "x"), "SRID=4326;" + text, text.replace(".0", "."), f" {text} ", text.replace(",", "")])


def test_batches_equal_single_values():
    rng = random.Random(3)
    for _ in range(150):
        texts = [_spoiled(rng, _any_shape(rng)) for _ in range(rng.randint(1, 14))]
        wkb = [geo._try(lambda t: codec.encode_wkb(codec.decode_wkt(t)), t) for t in texts]
        assert geo.wkb_batch_from_wkt(pa.array(texts, pa.string())).to_pylist() == wkb
        wkb = [rng.choice([b[:-1], b + b"x", b[:3], b""]) if b is not None and rng.random() < 0.1 else b for b in wkb]
        batch, geoms = pa.array(wkb, pa.binary()), [geo._try(codec.decode_wkb, b) for b in wkb]
        assert geo.geom_to_wkt.func(batch).to_pylist() == [g and codec.encode_wkt(g) for g in geoms]
        assert geo.canonical_wkb.func(batch).to_pylist() == [g and codec.encode_wkb(g) for g in geoms]
        assert geo.bbox_batch(batch).to_pylist() == geo._boxes(geoms).to_pylist()
        for frame, geom in zip(geo.geom_frame.func(batch).to_pylist(), geoms):
            walls = predicates.edges(geom).tolist() if geom and geom[0] in predicates.AREAS else None
            assert frame["edges"] == (walls and [dict(zip(geo.EDGE_NAMES, w)) for w in walls]) or frame["edges"] == walls
