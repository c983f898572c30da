"""Boxes and distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL, LARGE = 32, 96


def iou(a: dict[str, Column] | list[Column], b: list[Column]) -> Column:
    """Intersection over union of two corner boxes; 0 if the union is not positive."""
    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    zero = F.lit(0.0)
    inter = F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), zero) * F.greatest(F.least(ay2, by2) - F.greatest(ay1, by1), zero)
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def size_bucket(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    side = F.sqrt(F.greatest(x2 - x1, F.lit(0.0)) * F.greatest(y2 - y1, F.lit(0.0)))
    return F.when(side < SMALL, "small").when(side < LARGE, "medium").otherwise("large")


def to_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    return [(cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height]


def to_normal(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> list[Column]:
    return [(x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height]


def polygon_box(values: Column) -> Column:
    """``struct(cx, cy, w, h)`` of an array x1, y1, x2, y2, ...; an odd last value is dropped."""
    even = F.slice(values, 1, F.size(values) - F.size(values) % 2)
    xs, ys = F.filter(even, lambda v, i: i % 2 == 0), F.filter(even, lambda v, i: i % 2 == 1)
    lo_x, hi_x, lo_y, hi_y = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    return F.struct(((lo_x + hi_x) / 2).alias("cx"), ((lo_y + hi_y) / 2).alias("cy"), (hi_x - lo_x).alias("w"), (hi_y - lo_y).alias("h"))


def crop_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, pad: float = 0.3) -> Column:
    """The padded crop in whole pixels within the image, two pixels wide and high at least."""
    dx, dy = (x2 - x1) * pad, (y2 - y1) * pad
    left, top = F.greatest(x1 - dx, F.lit(0.0)).cast("int"), F.greatest(y1 - dy, F.lit(0.0)).cast("int")
    right = F.greatest(F.least(x2 + dx, width.cast("double")).cast("int"), left + 2)
    bottom = F.greatest(F.least(y2 + dy, height.cast("double")).cast("int"), top + 2)
    return F.struct(left.alias("x1"), top.alias("y1"), right.alias("x2"), bottom.alias("y2"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))
