"""Places along a Hilbert curve, as native expressions: what is near on the curve is near on the map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Halvings of each side of the frame; a key has twice as many bits.
LEVELS = 24


def curve_place(x: Column, y: Column, levels: int = LEVELS) -> Column:
    """The place of cell (x, y), whole numbers below ``2 ** levels``, on the curve from (0, 0) to the far end of the x axis.

    Every halving tells which quarter the cell lies in, and turns the quarter so that the next one is read alike.
    """
    most = (1 << levels) - 1

    def step(at: Column, side: Column) -> Column:
        right, upper = at.x.bitwiseAND(side) > 0, at.y.bitwiseAND(side) > 0
        quarter = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0)).cast("long")
        mirrored = right & ~upper
        px, py = F.when(mirrored, most - at.x).otherwise(at.x), F.when(mirrored, most - at.y).otherwise(at.y)
        return F.struct(F.when(upper, px).otherwise(py).alias("x"), F.when(upper, py).otherwise(px).alias("y"),
                        (at.place * 4 + quarter).alias("place"))

    sides = F.array(*(F.lit(1 << i).cast("long") for i in reversed(range(levels))))
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(sides, start, step, lambda at: at.place)


def curve_key(box: Column, frame: tuple[float, float, float, float]) -> Column:
    """The place of a box's centre on the curve over a frame (xmin, ymin, xmax, ymax); null for a null box.

    What lies outside goes to the nearest cell at the edge; a side without length is one cell.
    """
    xmin, ymin, xmax, ymax = map(float, frame)
    most = (1 << LEVELS) - 1

    def cell(low: Column, high: Column, first: float, last: float) -> Column:
        if not last > first:
            return F.lit(0)
        share = ((low / 2 + high / 2) - first) / (last - first)
        return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * most)
    return F.when(box.isNotNull(), curve_place(cell(box.xmin, box.xmax, xmin, xmax), cell(box.ymin, box.ymax, ymin, ymax)))
