"""Bounding boxes as structs of four doubles; all tests include the edges."""

from pyspark.sql import Column, functions as F, types as T

BOX_TYPE = T.StructType(
    [T.StructField(side, T.DoubleType()) for side in ("xmin", "ymin", "xmax", "ymax")]
)


def make_box(xmin, ymin, xmax, ymax) -> Column:
    """Box struct from numbers or columns; NULL when any side is NULL or NaN.

    So is a box whose sides are the wrong way round: it covers no point. Boxes that
    cross the antimeridian are two boxes.
    """
    sides = [
        (side if isinstance(side, Column) else F.lit(side)).cast("double")
        for side in (xmin, ymin, xmax, ymax)
    ]
    present = F.lit(True)
    for side in sides:
        present = present & side.isNotNull() & ~F.isnan(side)
    present = present & (sides[0] <= sides[2]) & (sides[1] <= sides[3])
    box = F.struct(*[s.alias(f.name) for s, f in zip(sides, BOX_TYPE.fields)])
    return F.when(present, box)


def bbox_meets(box: Column, other) -> Column:
    """Do two boxes share a point?  ``other`` is a box column or four numbers.

    With numbers each side becomes a comparison of a struct leaf with a
    literal, which Parquet checks against its row-group statistics.
    """
    if isinstance(other, Column):
        xmin, ymin, xmax, ymax = (other[f.name] for f in BOX_TYPE.fields)
    else:
        xmin, ymin, xmax, ymax = (F.lit(float(v)) for v in other)
    return (
        (box["xmin"] <= xmax)
        & (box["xmax"] >= xmin)
        & (box["ymin"] <= ymax)
        & (box["ymax"] >= ymin)
    )


def bbox_within(box: Column, outer) -> Column:
    """Does ``box`` lie inside the four numbers of ``outer``?"""
    xmin, ymin, xmax, ymax = (F.lit(float(v)) for v in outer)
    return (
        (box["xmin"] >= xmin)
        & (box["xmax"] <= xmax)
        & (box["ymin"] >= ymin)
        & (box["ymax"] <= ymax)
    )
