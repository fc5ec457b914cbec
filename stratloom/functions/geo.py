"""Distances, boxes and coordinate keys."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .common import SPACE, col, contains_any, let

BOX_TYPE = "struct<lat0:double,lat1:double,lon0:double,lon1:double>"
METRES_PER_DEGREE = 111320.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dp, dl = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = (F.pow(F.sin(dp / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dl / 2), 2))
    return F.lit(2 * 6371) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def planar_m(lat: Column, lon: Column, lat2: Column, lon2: Column, metres: float = METRES_PER_DEGREE) -> Column:
    """Equirectangular distance; the cosine is taken at the first point."""
    dy = (lat2 - lat) * metres
    dx = (lon2 - lon) * metres * F.cos(F.radians(lat))
    return F.sqrt(dy * dy + dx * dx)


def valid_coord(lat: Column, lon: Column, lat_min: float = 41) -> Column:
    return lat.between(lat_min, 82) & lon.between(19, 180)


def box(lat0: float, lat1: float, lon0: float, lon1: float) -> Column:
    return F.struct(F.lit(float(lat0)).alias("lat0"), F.lit(float(lat1)).alias("lat1"),
                    F.lit(float(lon0)).alias("lon0"), F.lit(float(lon1)).alias("lon1"))


def in_bbox(lat: Column, lon: Column, b: Column, pad: float = 0.0) -> Column:
    return (lat.between(b["lat0"] - pad, b["lat1"] + pad)
            & lon.between(b["lon0"] - pad, b["lon1"] + pad))


def first_box(text: Column, table: list[tuple]) -> Column:
    """struct(name, box) of the first table entry one of whose keywords occurs in the text.

    The tables are a dozen literal rows, so this is a projection: no join and no broadcast.
    """
    def body(t: Column) -> Column:
        out = F.lit(None).cast(f"struct<name:string,box:{BOX_TYPE}>")
        for name, bb, words in reversed(table):
            out = F.when(contains_any(t, words), F.struct(F.lit(name).alias("name"), box(*bb).alias("box"))
                         ).otherwise(out)
        return out
    return let(text, body)


def region_hint(sources: Column | str) -> Column:
    return first_box(F.lower(F.coalesce(col(sources), F.lit(""))), vocab.REGIONS)


def landform_hint(text: Column | str) -> Column:
    low = F.translate(F.lower(F.coalesce(col(text), F.lit(""))), "ё", "е")
    return first_box(low, vocab.LANDFORMS)


def round_to(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def marker_key(lat: Column, lon: Column) -> Column:
    # plus zero: the place -0.0 is the place 0.0
    return F.concat((F.round(lat, 6) + 0.0).cast("string"), F.lit(","), (F.round(lon, 6) + 0.0).cast("string"))


def storage_key(marker: Column) -> Column:
    """Marker key as a file name: the comma is not allowed there."""
    return F.translate(marker, ",", "")


def split_marker_key(c: Column | str) -> Column:
    """array<struct<lat,lon>> of every valid way to cut a key that lost its comma."""
    s = col(c)
    n = F.length(s)
    cuts = F.when(n > 5, F.sequence(F.lit(2), n - 3)).otherwise(F.array().cast("array<int>"))
    number = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

    def cut(k: Column) -> Column:
        a, b = F.substr(s, F.lit(1), k), F.substr(s, k + 1)
        return F.struct(F.when(a.rlike(number), a.try_cast("double")).alias("lat"),
                        F.when(b.rlike(number), b.try_cast("double")).alias("lon"))

    return F.filter(F.transform(cuts, cut),
                    lambda p: F.coalesce(valid_coord(p["lat"], p["lon"], 35), F.lit(False)))


_COORD = rf"(-?\d{{2}}\.\d{{3,}})[{SPACE}]*[,;][{SPACE}]*(-?\d{{1,3}}\.\d{{3,}})"


def coords_from_comment(c: Column | str) -> Column:
    """struct(lat, lon) of the first decimal pair in a comment; fields NULL when there is none."""
    t = F.coalesce(col(c), F.lit(""))
    return F.struct(F.regexp_extract(t, _COORD, 1).try_cast("double").alias("lat"),
                    F.regexp_extract(t, _COORD, 2).try_cast("double").alias("lon"))


_SIDES = [("северн|northern", (1.0, 0.0)), ("южн|southern", (-1.0, 0.0)),
          ("восточн|eastern", (0.0, 1.0)), ("западн|western", (0.0, -1.0))]


def _vec(dy: float, dx: float) -> Column:
    return F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"))


def direction_of_outskirts(c: Column | str) -> Column:
    """struct(dy, dx) of the edge of a place a phrase names; NULL when it names none."""
    t = F.coalesce(col(c), F.lit(""))
    out = F.lit(None).cast("struct<dy:double,dx:double>")
    for pat, v in reversed(_SIDES):
        out = F.when(t.rlike(f"(?iu){pat}"), _vec(*v)).otherwise(out)
    return F.when(t.rlike("(?iu)окраин|outskirts|краю|edge of"), out)


def offset_point(lat: Column, lon: Column, direction: Column, km: Column, phrase: Column) -> Column:
    """struct(lat, lon, accuracy): base point moved by a direction and distance named in prose."""
    step = _vec(0.0, 0.0)
    for word, v in vocab.DIRECTIONS.items():
        step = F.when(direction == word, _vec(*v)).otherwise(step)

    def body(p: Column) -> Column:
        still = (p["km"] == 0) & (p["v"]["dy"] == 0) & (p["v"]["dx"] == 0) & p["edge"].isNotNull()
        dy = F.when(still, p["edge"]["dy"]).otherwise(p["v"]["dy"])
        dx = F.when(still, p["edge"]["dx"]).otherwise(p["v"]["dx"])
        dist = F.when(still, F.lit(1.0)).otherwise(p["km"])
        return F.struct(
            F.round(lat + dy * dist / 111.32, 5).alias("lat"),
            F.round(lon + dx * dist / (F.lit(111.32) * F.cos(F.radians(lat))), 5).alias("lon"),
            (F.lit(1500) + dist * 100).cast("long").alias("accuracy"))

    return let(F.struct(step.alias("v"), F.coalesce(km.cast("double"), F.lit(0.0)).alias("km"),
                        direction_of_outskirts(phrase).alias("edge")), body)


def bbox_of_vertices(vertices: Column) -> Column:
    xs = F.transform(vertices, lambda v: v["x"].cast("int"))
    ys = F.transform(vertices, lambda v: v["y"].cast("int"))
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
                    F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def grid_step_degrees(radius_m: float, lat_limit: float = 82.0) -> tuple[float, float]:
    """Cell sizes (lat, lon) never narrower than the radius up to the highest accepted latitude."""
    lat = radius_m / METRES_PER_DEGREE
    return lat, lat / math.cos(math.radians(lat_limit))
