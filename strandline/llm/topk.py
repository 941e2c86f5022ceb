"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through
from .text import in_small_batches, mix64

#: Rows of a group at least, while there are not so many groups, and bytes of one at most.
BLOCK, LEAST_GROUPS, GROUP_BYTES = 4096, 32, 1 << 26
#: Rows of a group that share bounds, queries that pass them at a time, and bytes of a packed piece of either.
CHUNK, QUERIES, PIECE_BYTES = 2048, 512, 1 << 15
#: Bytes of the sample that the driver draws.
SAMPLE_BYTES = 1 << 24
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: Squared lengths up to which distances are finite; where a vector is longer, bounds say nothing.
LONGEST = 1e200


def lower_bounds(to_pivots: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """For each query and chunk the greatest lower bound of its distance to any row of the chunk: by the triangle inequality over every pivot.

    ``nearest`` and ``farthest`` are the least and greatest distances of the chunks' rows to the pivots.
    """
    bounds = np.zeros((len(to_pivots), len(nearest)))
    for p in range(to_pivots.shape[1]):
        d = to_pivots[:, p][:, None]
        np.maximum(bounds, np.maximum(nearest[:, p] - d, d - farthest[:, p]), out=bounds)
    return bounds


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers, or as Python's where these do not hold one of them."""
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    if (np.abs(y) < 2 ** 53).all():
        return y.astype(np.int64)
    # a product of 2 ** 53 or more is whole; one beyond the largest float is made of whole numbers
    exact = [int(v) if abs(v) < float("inf") else int(u) * scale for u, v in zip(x.ravel().tolist(), y.ravel().tolist(), strict=True)]
    out = np.empty(x.size, object)
    out[:] = exact
    return out.reshape(x.shape)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with ``b``; what 64 bits do not hold is their nearest end."""
    if object not in (a.dtype, b.dtype):
        size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        if size < 2 ** 53:
            return (a.astype(float) @ b.astype(float)).astype(np.int64)
        if size < 2 ** 62:
            return a @ b
    whole = b.tolist()
    exact = (sum(x * y for x, y in zip(row, whole, strict=True)) for row in a.tolist())
    return np.array([min(max(v, LOWEST), HIGHEST) for v in exact], np.int64)


def distances(points: np.ndarray, pivots: np.ndarray, most: float, lift: bool = True) -> np.ndarray:
    """Distances to the pivots after every vector has got a further component that brings its length to ``most``.

    Queries get 0 there (``lift`` false). Then the squared distance of a query to a vector is the sum of both squared lengths less
    twice their inner product, so the nearest vectors are those of the highest product.
    """
    points, pivots = points.astype(float), pivots.astype(float)
    squares, pivot_squares = (points ** 2).sum(1), (pivots ** 2).sum(1)
    products = points @ pivots.T
    if lift:
        products += np.sqrt(np.maximum(most ** 2 - squares, 0))[:, None] * np.sqrt(np.maximum(most ** 2 - pivot_squares, 0))
        squares = np.full(len(points), most ** 2)
    return np.sqrt(np.maximum(squares[:, None] + most ** 2 - 2 * products, 0))


def products(vectors: np.ndarray, queries: np.ndarray, most: float) -> np.ndarray:
    """Exact products of each query with each vector. No vector is longer than ``most``, so no partial sum exceeds its square."""
    for kind, whole in ((np.float32, 2 ** 24), (np.float64, 2 ** 53)):
        if most * most < whole:
            return queries.astype(kind) @ vectors.astype(kind).T
    return np.stack([inner(vectors, q) for q in queries])


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """``scaled``, unless these are whole numbers already."""
    return x if x.dtype.kind == "i" else scaled(x, scale)


class Best:
    """The best ``k`` of each query so far: ``count`` scores in descending order and their ids, and what another one has to reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.floor, self.floor_id = least.copy(), np.full(len(least), HIGHEST)
        self.scores, self.ids, self.count = np.zeros((len(least), k), np.int64), np.zeros((len(least), k), np.int64), np.zeros(len(least), np.int64)

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take these in, ties to the smaller id; ``floor`` and ``floor_id`` are then of the k-th best where there are as many."""
        k = self.scores.shape[1]
        some = np.unique(query)
        had = np.arange(k) < self.count[some][:, None]
        query = np.concatenate([np.repeat(some, self.count[some]), query])
        scores, ids = np.concatenate([self.scores[some][had], scores]), np.concatenate([self.ids[some][had], ids])
        order = np.lexsort((ids, ~scores, query))  # descending, without overflow at the ends
        query, scores, ids = query[order], scores[order], ids[order]
        first = np.searchsorted(query, some)
        number = np.diff(np.r_[first, len(query)])
        place = np.arange(len(query)) - np.repeat(first, number)
        stay = place < k
        self.scores[query[stay], place[stay]], self.ids[query[stay], place[stay]] = scores[stay], ids[stay]
        self.count[some] = np.minimum(number, k)
        full = some[number >= k]
        self.floor[full], self.floor_id[full] = self.scores[full, -1], self.ids[full, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The query, id and score of each."""
        query, place = np.nonzero(np.arange(self.scores.shape[1]) < self.count[:, None])
        return query, self.ids[query, place], self.scores[query, place]


class Rows:
    """The rows of a group in chunks of like distances to the pivots, with the range of these distances for each chunk."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, scale: int, chosen: np.ndarray, most: float, bounded: bool):
        self.scale, self.most = scale, most
        self.firsts = np.arange(0, len(ids), CHUNK)
        self.nearest = self.farthest = np.zeros((len(self.firsts), 0))
        if bounded and len(ids):
            pivot, near = np.zeros(len(ids), np.int64), np.zeros(len(ids))
            for i in self.firsts:
                table = distances(whole(vectors[i:i + CHUNK], scale), chosen, most)
                pivot[i:i + CHUNK], near[i:i + CHUNK] = table.argmin(1), table.min(1)
            order = np.lexsort((near, pivot))
            ids, rows, vectors = ids[order], rows[order], vectors[order]
            tables = (distances(whole(vectors[i:i + CHUNK], scale), chosen, most) for i in self.firsts)
            self.nearest, self.farthest = (np.stack(c) for c in zip(*((t.min(0), t.max(0)) for t in tables), strict=True))
        self.ids, self.rows, self.vectors = ids, rows, vectors

    def search(self, queries: np.ndarray, query_rows: np.ndarray, to_pivots: np.ndarray, least: np.ndarray, k: int) -> Best:
        """The best ``k`` of each query among the rows that score at least ``least``.

        A chunk is left out for the queries whose bound of it allows no score that reaches the k-th best so far, those of the highest bounds
        come first. The margin is far above the rounding errors.
        """
        best = Best(least, k)
        reach = np.full((len(queries), len(self.firsts)), np.inf)
        if self.nearest.shape[1]:
            squares = (queries.astype(float) ** 2).sum(1)
            bounds = lower_bounds(to_pivots, self.nearest, self.farthest)
            margin = 1e-6 * (1 + self.most + squares[:, None] ** 0.5)
            reach = (squares[:, None] + self.most ** 2 - np.maximum(bounds - margin, 0) ** 2) / 2 + 1
            reach += 1e-9 * np.abs(reach)
        for c in np.argsort(-reach.max(0, initial=-np.inf), kind="stable"):
            able = np.flatnonzero(reach[:, c] >= best.floor)
            if not len(able):
                continue
            part = slice(self.firsts[c], self.firsts[c] + CHUNK)
            ids, rows = self.ids[part], self.rows[part]
            scores = products(whole(self.vectors[part], self.scale), queries[able], self.most)
            some = scores.max(1) >= best.floor[able].astype(scores.dtype)
            able, scores = able[some], scores[some]
            hit = np.flatnonzero(scores >= best.floor[able].astype(scores.dtype)[:, None])
            q, r = np.divmod(hit, len(ids))
            of, score = able[q], scores.ravel()[hit].astype(np.int64)
            new = ((score > best.floor[of]) | (ids[r] < best.floor_id[of])) & (rows[r] != query_rows[of])
            if new.any():
                best.add(of[new], score[new], ids[r[new]])
        return best


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10,
          scale: int = 1024, pivots: int = 32) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the ``k`` other rows of the
    highest inner product of ``floor(scale * x)``, ties to the smaller id; all, if there are fewer.

    Rows are dealt to groups of a bounded size, each of which one task holds while all queries pass, some at a time; what is left per
    query and group is merged. Only the queries are copied, once for each group. A group's rows lie in chunks of like distances to the
    pivots, whose ranges bound what a query can score there. A query's products with a bounded sample of the rows bound its k-th best from
    below before it starts. At most ``pivots`` rows of it are taken as pivots, spread by farthest-first choice; sample and pivots affect
    time only.

    Rows with a null id, a null vector, or a null or non-finite component take no part. Vectors of other lengths are not
    compared. Rows with equal ids are rows of their own; a query leaves out its own row only. Without queries there are no rows.
    Products are exact for any finite components; a score that 64 bits do not hold is their nearest end, and ties there go to
    the smaller id as well. Where a vector's squared length is beyond ``LONGEST``, there are no bounds and every candidate is evaluated.
    """
    x = F.col(vector_col)
    # floats are doubles as they stand, in half the space
    plain = x if vectors.schema[vector_col].dataType.elementType == T.FloatType() else x.cast("array<double>")
    read = vectors.where(F.col(id_col).isNotNull() & x.isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), plain.alias("v"))
    kind = read.schema["v"].dataType.simpleString()

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            widths = v.value_lengths().to_numpy()
            of_row = np.repeat(np.arange(len(v)), widths)
            parts = np.abs(v.flatten().to_numpy(zero_copy_only=False).astype(float))  # null is not a number
            with np.errstate(over="ignore"):
                squares = np.bincount(of_row, (parts * scale + 1) ** 2, len(v))
            whole_rows = np.bincount(of_row, ~(parts < np.inf), len(v)) == 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(widths, pa.int32()), pa.array(squares, pa.float64())],
                                             ["id", "row", "v", "width", "square"]).filter(pa.array(whole_rows))

    rows = write_through(in_small_batches(read).mapInArrow(usable, f"id long, row long, v {kind}, width int, square double"), "vectors")
    widths = rows.groupBy("width").agg(
        F.count("*").alias("n"), F.sum((F.col("id") % every == 0).cast("long")).alias("q"), F.max("square").alias("square")).collect()
    found = [_of_width(rows.where(F.col("width") == w["width"]), w, every, k, scale, pivots) for w in widths if w["q"] and w["width"]]
    empty = rows.sparkSession.createDataFrame([], "query long, query_id long, vec_id long, score long")
    for part in found:
        empty = empty.union(part)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return empty.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def flat(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _of_width(rows: DataFrame, size, every: int, k: int, scale: int, pivots: int) -> DataFrame:
    spark, width, most = rows.sparkSession, size["width"], float(size["square"]) ** 0.5 + 1
    bounded = float(size["square"]) <= LONGEST
    wanted = max(1, min(64 * pivots, SAMPLE_BYTES // (8 * width)))
    share = min(1.0, wanted / size["n"])
    drawn = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(2 * wanted).select("v").toArrow()
    sample = scaled(flat(drawn.column("v").combine_chunks(), width), scale)  # bounded
    chosen = sample[:1]
    if len(sample) and bounded:
        near = distances(sample, chosen, most)[:, 0]
        while len(chosen) < min(pivots, len(sample)):
            chosen = np.concatenate([chosen, sample[near.argmax()][None]])
            near = np.minimum(near, distances(sample, chosen[-1:], most)[:, 0])

    known = sample if most * most < 2 ** 53 else sample[:pivots]

    # Whole numbers travel in as few bytes as hold them all; beyond that, the components do.
    kind = next((np.dtype(t) for t in (np.int16, np.int32) if most < np.iinfo(t).max and most * most < 2 ** 53), None)
    packed = np.dtype(float) if kind is None else kind
    row_bytes = 16 + width * packed.itemsize
    piece = max(1, PIECE_BYTES // row_bytes)
    groups = max(-(-size["n"] * row_bytes // GROUP_BYTES), min(LEAST_GROUPS, -(-size["n"] // BLOCK)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = None
        for batch in batches:
            ids, row, v = batch.column(0).to_numpy(), batch.column(1).to_numpy(), flat(batch.column(2), width)
            v = v if kind is None else scaled(v, scale).astype(kind)
            asks = np.flatnonzero(ids % every == 0)
            if turn is None and len(row):
                turn = int(mix64(row[:1].astype(np.uint64))[0] % np.uint64(groups))
            parts = []
            for i in range(0, len(ids), piece):  # a task deals its pieces to the groups in turn
                parts.append((0, turn, np.arange(i, min(i + piece, len(ids)))))
                turn = (turn + 1) % groups
            parts += [(1, None, asks[i:i + piece]) for i in range(0, len(asks), piece)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int32()),
                 *(pa.array([x[p[2]].tobytes() for p in parts], pa.binary()) for x in (ids, row, v))],
                ["side", "own", "ids", "rows", "vectors"])

    def unpacked(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, row, v = (b"".join(p[c] for p in parts) for c in ("ids", "rows", "vectors"))
        return np.frombuffer(ids, np.int64), np.frombuffer(row, np.int64), np.frombuffer(v, packed).reshape(-1, width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: Rows, asked: list[dict]) -> Iterator[pa.RecordBatch]:
            ids, row, v = unpacked(asked)
            v = whole(v, scale)
            to_pivots = distances(v, chosen, most, False) if bounded else np.zeros((len(v), 0))
            order = np.argsort(to_pivots.argmin(1), kind="stable") if bounded else np.arange(len(v))
            for i in range(0, len(order), QUERIES):
                some = order[i:i + QUERIES]
                least = np.full(len(some), LOWEST)
                if len(known) > k:
                    # one of them may be the query itself, and others may be equal vectors but are different rows
                    least = np.partition(products(known, v[some], most), -k - 1, axis=1)[:, -k - 1].astype(np.int64)
                query, vec_ids, scores = held.search(v[some], row[some], to_pivots[some], least, k).found()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row[some][query], ids[some][query], vec_ids, scores)],
                                                 ["query", "query_id", "vec_id", "score"])

        group, parts, held, number = None, [], None, 0  # parts are of the rows until there is a query, of queries from there on
        for batch in batches:
            for r in batch.to_pylist():
                if held is not None and (r["group"] != group or number >= 8 * QUERIES):
                    yield from found(held, parts)
                    parts, number = [], 0
                if r["group"] != group:
                    group, parts, held, number = r["group"], [], None, 0
                if r["side"] and held is None:
                    held, parts = Rows(*unpacked(parts), scale, chosen, most, bounded), []
                parts.append(r)
                number += r["side"] * len(r["ids"]) // 8
        if held is not None:
            yield from found(held, parts)

    pieces = in_small_batches(rows.select("id", "row", "v")).mapInArrow(pack, "side int, own int, ids binary, rows binary, vectors binary")
    to = F.when(F.col("side") == 0, F.array("own")).otherwise(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = pieces.select(F.explode(to).alias("group"), "side", "ids", "rows", "vectors")
    dealt = dealt.repartitionById(groups, "group").sortWithinPartitions("group", "side")
    return dealt.mapInArrow(search, "query long, query_id long, vec_id long, score long")
