"""Regions of image maps: shape and bounding box from markup, and where they lie in words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROWS, COLUMNS = ("top", "middle", "bottom"), ("left", "centre", "right")


def _attribute(html: Column, name: str) -> Column:
    """The value in double quotes; null without one."""
    return F.when(html.rlike(rf'(?i){name}\s*=\s*"[^"]*"'), F.regexp_extract(html, rf'(?i){name}\s*=\s*"([^"]*)"', 1))


def parse_region(role: Column, html: Column, space: Column) -> Column:
    """struct(shape, coords, width, height) of an area with three numbers at least; an empty piece counts as 0."""
    pieces = F.split(_attribute(html, "coords"), r"[\s,]+")
    number = lambda x: F.when(x == "", 0.0).otherwise(F.when(x.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), x.try_cast("double")))
    coords = F.filter(F.transform(pieces, number), lambda x: x.isNotNull())
    sized = space.rlike(r"^\d+x\d+$")
    size = lambda k: F.when(sized, F.split_part(space, F.lit("x"), F.lit(k)).cast("double"))
    shape = F.coalesce(F.lower(F.trim(_attribute(html, "shape"))), F.lit("rect"))
    return F.when((role == "area") & (F.size(coords) >= 3), F.struct(shape.alias("shape"), coords.alias("coords"), size(1).alias("width"), size(2).alias("height")))


def region_shape(region: Column) -> Column:
    """struct(tag, corners, x1, y1, x2, y2): circle by its radius, polygon of three corners at least, else a rectangle."""
    c, shape = region["coords"], region["shape"]
    n = F.floor(F.size(c) / 2).cast("int")
    xs, ys = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(c, i * 2)), F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(c, i * 2 + 1))
    at = lambda k: F.get(c, F.lit(k))
    box = lambda tag, corners, *v: F.struct(F.lit(tag).alias("tag"), corners.cast("int").alias("corners"), *(x.alias(k) for x, k in zip(v, ("x1", "y1", "x2", "y2"), strict=True)))
    none = F.lit(None)
    return (
        F.when(shape == "circle", box("circle", none, at(0) - at(2), at(1) - at(2), at(0) + at(2), at(1) + at(2)))
        .when(shape.isin("poly", "polygon"), F.when(n >= 3, box("polygon", n, F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))))
        .when(F.size(c) >= 4, box("rect", none, F.least(at(0), at(2)), F.least(at(1), at(3)), F.greatest(at(0), at(2)), F.greatest(at(1), at(3))))
    )


def band(value: Column, extent: Column, names: tuple[str, str, str]) -> Column:
    third = F.least(F.lit(2), F.greatest(F.lit(0), F.floor(value / extent * 3)))
    return F.when(value.isNotNull() & extent.isNotNull(), F.element_at(F.array(*(F.lit(n) for n in names)), (third + 1).cast("int")))


def region_note(shape: Column, width: Column, height: Column) -> Column:
    """Where a region lies, for those who can't see its outline."""
    whole = lambda x: F.floor(x + 0.5).cast("long").cast("string")
    what = F.when(shape["corners"].isNotNull(), F.concat(shape["corners"].cast("string"), F.lit("-point outline"))).otherwise(F.concat(F.lit("outlined "), shape["tag"]))
    y, x = band((shape["y1"] + shape["y2"]) / 2, height, ROWS), band((shape["x1"] + shape["x2"]) / 2, width, COLUMNS)
    return F.concat(
        what, F.lit(", "), y, F.lit(" "), x, F.lit(" of the map: x "), whole(shape["x1"]), F.lit(" to "), whole(shape["x2"]), F.lit(", y "), whole(shape["y1"]), F.lit(" to "), whole(shape["y2"]),
        F.lit(" of "), whole(width), F.lit(" by "), whole(height),
    )
