"""Which box holds a point: a range join decided by the nearest box centre.

Boxes are rows ``code string, ordinal int, min_lon, min_lat, max_lon, max_lat, centre_lon, centre_lat
double``. A point belongs to the box that contains it, ends included, and whose centre is nearest in
degrees; on equal distance the lower ordinal wins. Points in no box get null. A box whose minimum
exceeds its maximum contains nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.maths import distance, in_box

BOX_FIELDS = (
    "code", "ordinal", "min_lon", "min_lat", "max_lon", "max_lat", "centre_lon", "centre_lat",
)

# Boxes up to this number are broadcast: at most four cells each, about 100 bytes a cell.
BROADCAST_BOXES = 100_000
FINEST_LEVEL = 30


def box_of(
    points: DataFrame,
    boxes: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    output: str = "country",
) -> DataFrame:
    """``points`` with the code of their box.

    Up to ``BROADCAST_BOXES`` boxes, counted beforehand, are broadcast; more go through a shuffle. Both
    ways give the same answer for every point, as it depends on the coordinates alone.
    """
    extent = _extent(boxes)
    way = box_of_indexed if extent.n <= BROADCAST_BOXES else box_of_grid
    return way(points, boxes, lon, lat, output, extent)


@dataclass(frozen=True)
class _Grid:
    """Cells of several widths, each level half as wide as the one before.

    Every second level is used. A box lies on the finest whose cells are as wide as the box, so it
    touches at most two cells in each direction however large it is, and a cell lists boxes of about its
    own size. Points look up their cell on every level in use, at most 16.
    """

    extent: BoxExtent
    span: float
    levels: list[int]

    def x(self, x: Column, at: Column) -> Column:
        return F.floor((x - self.extent.min_lon) / (self.span / F.pow(F.lit(2.0), at)))

    def y(self, y: Column, at: Column) -> Column:
        return F.floor((y - self.extent.min_lat) / (self.span / F.pow(F.lit(2.0), at)))

    def level(self) -> Column:
        width = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
        fitting = F.floor(F.log2(F.try_divide(F.lit(self.span), width)))
        fitting = F.when(width == 0, FINEST_LEVEL).otherwise(fitting)
        steps_up = F.ceil(F.greatest(F.lit(0), FINEST_LEVEL - fitting) / 2)
        return F.greatest(F.lit(0), FINEST_LEVEL - 2 * steps_up).cast("int")

    def cells(self, boxes: DataFrame) -> DataFrame:
        """A row for each cell that a box touches, with the box's fields."""
        at = F.col("__level")
        return (
            _usable(boxes)
            .select(*BOX_FIELDS, self.level().alias("__level"))
            .withColumn("__cx", F.explode(F.sequence(self.x(F.col("min_lon"), at), self.x(F.col("max_lon"), at))))
            .withColumn("__cy", F.explode(F.sequence(self.y(F.col("min_lat"), at), self.y(F.col("max_lat"), at))))
        )


def _grid(boxes: DataFrame, extent: BoxExtent) -> _Grid:
    widest = max(extent.max_lon - extent.min_lon, extent.max_lat - extent.min_lat)
    grid = _Grid(extent, 2.0 * widest or 1.0, [])
    used = _usable(boxes).agg(F.collect_set(grid.level()).alias("levels")).first().levels
    return replace(grid, levels=sorted(used))


def box_of_indexed(
    points: DataFrame,
    boxes: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    output: str = "country",
    extent: BoxExtent | None = None,
) -> DataFrame:
    """A broadcast join for each level in use with cells that list their boxes.

    Points are never shuffled. For boxes of a number that may be broadcast; ``extent`` spares a caller
    that has it the look at the box table.
    """
    extent = extent or _extent(boxes)
    if not extent.n:
        return points.withColumn(output, F.lit(None).cast("string"))
    grid = _grid(boxes, extent)
    listed = grid.cells(boxes).groupBy("__level", "__cx", "__cy").agg(
        F.collect_list(F.struct(*BOX_FIELDS)).alias("__boxes")
    )
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")

    def nearest(cell: Column) -> Column:
        holding = F.filter(cell, lambda b: in_box(x, y, b.min_lon, b.min_lat, b.max_lon, b.max_lat))
        ranked = F.transform(
            holding,
            lambda b: F.struct(
                distance(x, y, b.centre_lon, b.centre_lat).alias("d"),
                b.ordinal.alias("ordinal"),
                b.code.alias("code"),
            ),
        )
        return F.array_min(ranked)

    located = points
    for level in grid.levels:
        names = [f"__cx{level}", f"__cy{level}", f"__boxes{level}"]
        own = listed.where(F.col("__level") == level).select(
            *[F.col(c).alias(n) for c, n in zip(("__cx", "__cy", "__boxes"), names)]
        )
        same = [grid.x(x, F.lit(level)) == F.col(names[0]), grid.y(y, F.lit(level)) == F.col(names[1])]
        located = located.join(F.broadcast(own), same, "left")
    best = F.array_min(F.array_compact(F.array(*[nearest(F.col(f"__boxes{n}")) for n in grid.levels])))
    return located.select(*[points[c] for c in points.columns], best.getField("code").alias(output))


def box_of_grid(
    points: DataFrame,
    boxes: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    output: str = "country",
    extent: BoxExtent | None = None,
) -> DataFrame:
    """Equi-join on grid cells for any number of boxes of mixed sizes.

    Different coordinates are looked up once. The exact test is part of the join, and candidates of a
    place are reduced before they are shuffled; points then meet their place's box by coordinates.
    """
    extent = extent or _extent(boxes)
    if not extent.n:
        return points.withColumn(output, F.lit(None).cast("string"))
    grid = _grid(boxes, extent)
    cells = grid.cells(boxes)
    at, x, y = F.col("__level"), F.col("__x"), F.col("__y")
    probes = (
        points.select(F.col(lon).cast("double").alias("__x"), F.col(lat).cast("double").alias("__y"))
        .where(x.between(extent.min_lon, extent.max_lon) & y.between(extent.min_lat, extent.max_lat))
        .distinct()
        .withColumn("__level", F.explode(F.array(*[F.lit(n) for n in grid.levels])))
        .withColumns({"__cx": grid.x(x, at), "__cy": grid.y(y, at)})
    )
    same_cell = [probes[c] == cells[c] for c in ("__level", "__cx", "__cy")]
    inside = in_box(x, y, F.col("min_lon"), F.col("min_lat"), F.col("max_lon"), F.col("max_lat"))
    centre = distance(x, y, F.col("centre_lon"), F.col("centre_lat"))
    nearest = (
        probes.join(cells, [*same_cell, inside])
        .groupBy("__x", "__y")
        .agg(F.min(F.struct(centre.alias("d"), "ordinal", "code")).alias("__best"))
        .select("__x", "__y", F.col("__best.code").alias(output))
    )
    same_place = [
        F.col(lon).cast("double").eqNullSafe(F.col("__x")),
        F.col(lat).cast("double").eqNullSafe(F.col("__y")),
    ]
    return points.join(nearest, same_place, "left").select(*[points[c] for c in points.columns], output)


def code_of(df: DataFrame, boxes: DataFrame, ordinal: str, output: str = "code") -> DataFrame:
    """Box code for an ordinal, null for an unknown one."""
    names = boxes.select(F.col("ordinal").alias("__ordinal"), F.col("code").alias(output))
    return df.join(names, F.col(ordinal) == F.col("__ordinal"), "left").drop("__ordinal")


def ordinal_of(df: DataFrame, boxes: DataFrame, code: str, output: str = "ordinal") -> DataFrame:
    """Ordinal for a box code, null for an unknown one."""
    names = boxes.select(F.col("code").alias("__code"), F.col("ordinal").alias(output))
    return df.join(names, F.col(code) == F.col("__code"), "left").drop("__code")


def _usable(boxes: DataFrame) -> DataFrame:
    return boxes.where("min_lon <= max_lon and min_lat <= max_lat")


@dataclass(frozen=True)
class BoxExtent:
    """What a plan needs to know of a box table: its size and bounds."""

    n: int
    min_lon: float
    max_lon: float
    min_lat: float
    max_lat: float


def _extent(boxes: DataFrame) -> BoxExtent:
    """One aggregate over the box table."""
    bounds = _usable(boxes).agg(
        F.count(F.lit(1)),
        F.min("min_lon"),
        F.max("max_lon"),
        F.min("min_lat"),
        F.max("max_lat"),
    ).first()
    if not bounds[0]:
        return BoxExtent(0, 0.0, 0.0, 0.0, 0.0)
    if not all(math.isfinite(v) for v in bounds[1:]):
        raise ValueError("box bounds must be finite")
    return BoxExtent(*bounds)
