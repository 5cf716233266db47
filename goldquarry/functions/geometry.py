"""Bounding-box expressions over ``array<struct<xmin, ymin, xmax, ymax>>``."""

from pyspark.sql import Column, functions as F

from goldquarry import fixed_values as fv

_CORNERS = ("xmin", "ymin", "xmax", "ymax")


def box(xmin, ymin, xmax, ymax) -> Column:
    values = (xmin, ymin, xmax, ymax)
    return F.struct(*[v.cast("double").alias(n) for v, n in zip(values, _CORNERS)])


def boxes_from_lists(col: Column) -> Column:
    """Turn ``array<array<...>>`` into boxes; entries that are not four numbers are dropped."""
    four = F.filter(col, lambda b: F.size(b) == 4)
    as_boxes = F.transform(
        four,
        lambda b: F.struct(*[F.get(b, i).try_cast("double").alias(n) for i, n in enumerate(_CORNERS)]),
    )
    return F.filter(as_boxes, _complete)


def boxes_to_lists(col: Column) -> Column:
    return F.transform(col, lambda b: F.array(*[b[n] for n in _CORNERS]))


def _complete(b: Column) -> Column:
    test = b.isNotNull()
    for n in _CORNERS:
        test = test & b[n].isNotNull()
    return test


def box_width(b: Column) -> Column:
    return b["xmax"] - b["xmin"]


def box_height(b: Column) -> Column:
    return b["ymax"] - b["ymin"]


def box_area(b: Column) -> Column:
    """Area with negative sides counted as zero."""
    zero = F.lit(0.0)
    return F.greatest(F.nanvl(box_width(b), zero), zero) * F.greatest(
        F.nanvl(box_height(b), zero), zero
    )


def frame_area(width: Column, height: Column) -> Column:
    side = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return side(width) * side(height)


def largest_box_fraction(bbox: Column, width: Column, height: Column) -> Column:
    """Largest box area over frame area, 0 without boxes, null without a frame area."""
    area = frame_area(width, height)
    largest = F.array_max(F.transform(F.filter(bbox, _complete), box_area))
    return F.when(area > 0, F.coalesce(largest, F.lit(0.0)) / area)


def largest_box_ratio(present: Column, bbox: Column, width: Column, height: Column) -> Column:
    """The fraction above for frames with the object present; 0 reads as null."""
    fraction = largest_box_fraction(bbox, width, height)
    return F.when(present & (fraction > 0), fraction)


def visibility_bucket(
    present: Column, bbox: Column, width: Column, height: Column, cuts=fv.VISIBILITY_CUTS
) -> Column:
    """Size bucket of the largest box; null when the object is absent or presence unknown."""
    fraction = largest_box_fraction(bbox, width, height)
    large, medium = cuts
    size = (
        F.when(fraction >= large, fv.VISIBILITIES[0])
        .when(fraction >= medium, fv.VISIBILITIES[1])
        .otherwise(fv.VISIBILITIES[2])
    )
    return F.when(present, size)


def rescale_boxes(bbox: Column, width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """Boxes scaled from the frame to a target size; an unknown frame side counts as the target's."""
    side = lambda c, to: F.greatest(
        F.coalesce(F.nullif(c.cast("double"), F.lit(0.0)), F.lit(float(to))), F.lit(1.0)
    )
    sx = F.lit(float(to_width)) / side(width, to_width)
    sy = F.lit(float(to_height)) / side(height, to_height)
    return F.transform(
        F.filter(bbox, _complete),
        lambda b: box(b["xmin"] * sx, b["ymin"] * sy, b["xmax"] * sx, b["ymax"] * sy),
    )
