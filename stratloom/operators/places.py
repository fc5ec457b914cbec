"""Locating sections: gazetteer look-ups, hints, repair of homonyms, points near points.

Gazetteer rows are ``name, admin, class, type, lat, lon, rank`` in the service's rank order. Every look-up
reduces the gazetteer to one answer per key before it meets the sections, so a name that a third of the
sections share joins one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import text as t
from ..functions.common import not_missing, strip
from . import tools


def _settlement() -> Column:
    return F.col("class").isin(vocab.PLACE_CLASSES) & F.col("type").isin(vocab.SETTLEMENT_TYPES)


def best_hits(gaz: DataFrame, keys: list[str], k: int | None = None) -> DataFrame:
    """(keys, hit): the first settlement within bounds by rank, of the first ``k`` rows if that is given."""
    top = tools.first_rows(gaz, keys, [F.col("rank"), F.col("lat"), F.col("lon")], k)
    good = top.filter(_settlement() & g.valid_coord(F.col("lat"), F.col("lon")))
    return good.groupBy(*keys).agg(F.min(F.struct("rank", "lat", "lon")).alias("hit"))


def _hit(name: str = "hit") -> Column:
    return F.struct(F.col(f"{name}.lat").alias("lat"), F.col(f"{name}.lon").alias("lon"))


def geocode_join(df: DataFrame, gaz: DataFrame, k: int | None = None, out: str = "found") -> DataFrame:
    """(name, admin) → ``found`` struct(lat, lon); an empty admin searches by the bare name."""
    full = best_hits(gaz, ["name", "admin"], k).withColumnRenamed("hit", "_full")
    bare = best_hits(gaz, ["name"], k).withColumnRenamed("hit", "_bare")
    j = df.join(full, ["name", "admin"], "left").join(bare, "name", "left")
    pick = F.when(F.col("admin") != "", F.col("_full")).otherwise(F.col("_bare"))
    return j.withColumn("_pick", pick).withColumn(out, F.when(F.col("_pick").isNotNull(), _hit("_pick"))).drop(
        "_full", "_bare", "_pick")


def geocode_in_box_join(df: DataFrame, gaz: DataFrame, k: int | None = None, out: str = "found", cell: float = 4.0) -> DataFrame:
    """Same for rows with a ``box``: candidates must lie inside, and only those count towards ``k`` if it is given.

    Distinct (name, box) keys meet the gazetteer through grid cells, which spreads a frequent name.
    """
    def cells(lo: str, hi: str) -> Column:
        return F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))

    keys = df.filter(F.col("box").isNotNull()).select(
        "name", *[F.col(f"box.{c}").alias(f"_{c}") for c in ("lat0", "lat1", "lon0", "lon1")]).distinct()
    boxes = keys.withColumn("_cy", F.explode(cells("_lat0", "_lat1"))).withColumn("_cx", F.explode(cells("_lon0", "_lon1")))
    placed = gaz.withColumn("_cy", F.floor(F.col("lat") / cell)).withColumn("_cx", F.floor(F.col("lon") / cell))
    inside = boxes.join(placed, ["name", "_cy", "_cx"]).filter(
        F.col("lat").between(F.col("_lat0"), F.col("_lat1")) & F.col("lon").between(F.col("_lon0"), F.col("_lon1")))
    by = ["name", "_lat0", "_lat1", "_lon0", "_lon1"]
    top = tools.first_rows(inside, by, [F.col("rank"), F.col("lat"), F.col("lon")], k).filter(_settlement())
    hits = top.groupBy(*by).agg(F.min(F.struct("rank", "lat", "lon")).alias("_hit"))
    flat = df
    for c in ("lat0", "lat1", "lon0", "lon1"):
        flat = flat.withColumn(f"_{c}", F.col(f"box.{c}"))
    j = flat.join(hits, by, "left")
    return j.withColumn(out, F.when(F.col("_hit").isNotNull(), _hit("_hit"))).drop(
        "_hit", "_lat0", "_lat1", "_lon0", "_lon1")


def geocode_ladder(df: DataFrame, gaz: DataFrame, k: int | None = None) -> DataFrame:
    """Names without a coordinate: the raw name, then without prefix, then without a trailing numeral.

    Adds ``found`` and ``note``; each distinct name is looked up once.
    """
    names = df.select("name").distinct().filter(t.not_place_reason("name").isNull())
    tried = names.select("name", F.posexplode(t.name_variants("name")).alias("pos", "variant"))
    bare = best_hits(gaz, ["name"], k).select(F.col("name").alias("variant"), "hit")
    hits = tried.join(bare, "variant").groupBy("name").agg(F.min(F.struct("pos", "variant", "hit")).alias("b"))
    note = F.when(F.col("b.variant") == F.col("name"), "найдено по названию без уточнения").otherwise(
        F.concat(F.lit("найдено как «"), F.col("b.variant"), F.lit("» — номер объекта отброшен")))
    found = hits.select("name", _hit("b.hit").alias("found"), note.alias("note"))
    return df.join(found, "name", "left")


def geocode_with_fallback(df: DataFrame, gaz: DataFrame, k: int | None = None) -> DataFrame:
    """name + admin first, then the bare name with a note that the admin is unconfirmed."""
    full = best_hits(gaz, ["name", "admin"], k).withColumnRenamed("hit", "_full")
    bare = best_hits(gaz, ["name"], k).withColumnRenamed("hit", "_bare")
    j = df.join(full, ["name", "admin"], "left").join(bare, "name", "left")
    note = F.when(F.col("_full").isNull() & F.col("_bare").isNotNull() & (F.col("admin") != ""),
                  "по названию без уточнения")
    j = j.withColumn("note", note).withColumn("_pick", F.coalesce("_full", "_bare"))
    return j.withColumn("found", F.when(F.col("_pick").isNotNull(), _hit("_pick"))).drop("_full", "_bare", "_pick")


def geocode_box_smart(df: DataFrame, gaz: DataFrame, k: int | None = None) -> DataFrame:
    """In-box look-up by name, then without a leading side or size word; ``used`` is the name that hit."""
    short = t.drop_side_word(F.col("name"))
    first = geocode_in_box_join(df, gaz, k, "_a").withColumn("_name", F.col("name")).withColumn(
        "name", F.when((short != "") & (F.lower(short) != F.lower("name")), short))
    both = geocode_in_box_join(first, gaz, k, "_b")
    return (both.withColumn("used", F.when(F.col("_a").isNull() & F.col("_b").isNotNull(), F.col("name")).otherwise(F.col("_name")))
            .withColumn("found", F.coalesce("_a", "_b")).withColumn("name", F.col("_name")).drop("_a", "_b", "_name"))


def region_hint_join(df: DataFrame, sources: str = "sources") -> DataFrame:
    """First region named by the sources: ``region`` and its ``box``."""
    return df.withColumn("_h", g.region_hint(sources)).withColumn("region", F.col("_h.name")).withColumn(
        "box", F.col("_h.box")).drop("_h")


def landform_hint_join(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("_h", g.landform_hint(text)).withColumn("landform", F.col("_h.name")).withColumn(
        "box", F.col("_h.box")).drop("_h")


def homonym_region_fix(df: DataFrame, gaz: DataFrame) -> DataFrame:
    """Rows with name, sources, lat, lon: a point outside its sources' region is looked up inside, or dropped."""
    hinted = region_hint_join(df)
    out = F.col("box").isNotNull() & F.col("lat").isNotNull() & ~g.in_bbox(F.col("lat"), F.col("lon"), F.col("box"))
    fixed = geocode_in_box_join(hinted.withColumn("_out", F.coalesce(out, F.lit(False))).withColumn(
        "box", F.when(F.col("_out"), F.col("box"))), gaz)
    moved = F.col("_out") & F.col("found").isNotNull()
    return (fixed.withColumn("outcome", F.when(moved, "fixed").when(F.col("_out"), "dropped").otherwise("kept"))
            .withColumn("lat", F.when(F.col("_out"), F.col("found.lat")).otherwise(F.col("lat")))
            .withColumn("lon", F.when(F.col("_out"), F.col("found.lon")).otherwise(F.col("lon")))
            .drop("_out", "found", "box"))


def ambiguous_names(gaz: DataFrame, k: int | None = None, far_km: float = 150) -> DataFrame:
    """Names whose candidates (rounded to 0.1°) lie more than ``far_km`` apart.

    Of the candidates of a latitude only the westernmost and easternmost can be the farthest from anything, so
    a name keeps two points per tenth of a degree at most.
    """
    top = tools.first_rows(gaz, ["name"], [F.col("rank"), F.col("lat"), F.col("lon")], k)
    pts = top.filter(_settlement()).select("name", F.round("lat", 1).alias("lat"), F.round("lon", 1).alias("lon"))
    pts = pts.filter(g.valid_coord(F.col("lat"), F.col("lon"))).groupBy("name", "lat").agg(
        F.array_distinct(F.array(F.min("lon"), F.max("lon"))).alias("ends")).select("name", "lat", F.explode("ends").alias("lon"))
    per_name = pts.groupBy("name").agg(F.collect_set(F.struct("lat", "lon")).alias("p"))
    spread = F.array_max(F.flatten(F.transform("p", lambda a: F.transform(
        F.col("p"), lambda b: g.haversine_km(a["lat"], a["lon"], b["lat"], b["lon"])))))
    return per_name.select("name", F.size("p").alias("n"), spread.alias("spread_km")).filter(
        (F.col("n") >= 2) & (F.col("spread_km") > far_km))


def location_confidence(df: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """ok with an admin unit; without one, uncertain when the name is ambiguous; empty without a point."""
    amb = ambiguous.select("name", F.lit(True).alias("_amb"))
    j = df.join(amb, "name", "left")
    conf = (F.when(F.col("lat").isNull(), "").when(F.col("admin") != "", "ok")
            .when(F.col("_amb"), "uncertain").otherwise("ok"))
    return j.withColumn("loc_confidence", conf).drop("_amb")


# ---------------------------------------------------------------- admin units of namesakes
_FORMAL = "(?iu)(област|край|республик|обл\\.|governorate|region)"


def without_admin(sections: DataFrame) -> DataFrame:
    return sections.filter(F.col("lat").isNotNull() & ~not_missing(strip("administrative_unit")))


def name_key(c: str) -> Column:
    return F.translate(F.lower(strip(c)), "ё", "е")


def admin_propagation(sections: DataFrame) -> DataFrame:
    """Rows without an admin unit take it from rows of the same name.

    A set of admin units has one member exactly when its smallest and largest are equal, so per
    (name, source) and per name only those two travel; no pair of rows is formed.
    """
    adm = strip("administrative_unit")
    rows = sections.withColumn("nk", name_key("nearest_locality"))
    known = rows.filter(not_missing(adm)).select("nk", adm.alias("a"), "sources")
    formal = F.when(F.col("a").rlike(_FORMAL), F.col("a"))
    corpus = known.groupBy("nk").agg(F.min(formal).alias("c_lo"), F.max(formal).alias("c_hi"))
    per_src = known.select("nk", "a", F.explode(F.array_distinct(t.split_sources("sources"))).alias("src")).groupBy("nk", "src").agg(
        F.min(formal).alias("f_lo"), F.max(formal).alias("f_hi"), F.min("a").alias("a_lo"), F.max("a").alias("a_hi"))
    need = without_admin(rows).select("ord", "nk", "sources")
    shared = need.select("ord", "nk", F.explode(F.array_distinct(t.split_sources("sources"))).alias("src")).join(
        per_src, ["nk", "src"]).groupBy("ord").agg(F.min("f_lo").alias("f_lo"), F.max("f_hi").alias("f_hi"),
                                                   F.min("a_lo").alias("a_lo"), F.max("a_hi").alias("a_hi"))
    j = need.join(shared, "ord", "left").join(corpus, "nk", "left")

    def single(p: str) -> Column:
        return F.col(f"{p}_lo").isNotNull() & (F.col(f"{p}_lo") == F.col(f"{p}_hi"))

    same = F.when(single("f"), F.col("f_lo")).when(single("a"), F.col("a_lo"))
    return j.select("ord", F.coalesce(same, F.when(single("c"), F.col("c_lo"))).alias("admin"),
                    F.when(same.isNotNull(), "тот же источник").when(single("c"), "единственный вариант в корпусе").alias("why"),
                    F.coalesce(single("c"), F.lit(False)).alias("strong")).filter("admin is not null")


def context_text(with_sources: bool = False) -> Column:
    cols = ["evidence", "geomorphic_position", "administrative_unit"] + (["sources"] if with_sources else [])
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cols])


def _moved_km(lat: str, lon: str, to: str) -> Column:
    return g.haversine_km(F.col(lat), F.col(lon), F.col(f"{to}.lat"), F.col(f"{to}.lon"))


def homonym_plan_apply(sections: DataFrame, gaz: DataFrame, far_km: float = 50) -> DataFrame:
    """Repair rows without an admin unit: by a strong propagated unit, else by a landform, else only flag.

    Returns the planned rows with ``plan`` and ``outcome`` (fixed, kept, dropped, flagged) and new lat, lon.
    """
    need = without_admin(sections).withColumn("name", strip("nearest_locality"))
    need = need.join(admin_propagation(sections), "ord", "left").withColumnRenamed("admin", "hint")
    need = landform_hint_join(need, context_text(True))
    outside = F.col("box").isNotNull() & ~g.in_bbox(F.col("lat"), F.col("lon"), F.col("box"))
    plan = (F.when(F.col("hint").isNotNull() & F.col("strong"), "admin").when(outside, "bbox")
            .when(F.col("hint").isNotNull(), "flag"))
    # the plan ends one stage: both look-ups read it
    planned = need.withColumn("plan", plan).filter("plan is not null").withColumn(
        "box", F.when(F.col("plan") == "bbox", F.col("box")))
    by_admin = best_hits(gaz, ["name", "admin"]).select("name", F.col("admin").alias("hint"), _hit().alias("_adm"))
    looked = geocode_box_smart(planned, gaz).join(by_admin, ["name", "hint"], "left")
    looked = looked.withColumn("new", F.when(F.col("plan") == "admin", F.col("_adm")).when(F.col("plan") == "bbox", F.col("found")))
    far = F.col("new").isNotNull() & (_moved_km("lat", "lon", "new") > far_km)
    outcome = (F.when(F.col("plan") == "flag", "flagged").when(far, "fixed").when(F.col("new").isNotNull(), "kept")
               .when(F.col("plan") == "bbox", "dropped").otherwise("flagged"))
    done = looked.withColumn("outcome", outcome)
    for c in ("lat", "lon"):
        done = done.withColumn(f"_{c}", F.when(F.col("outcome") == "fixed", F.round(f"new.{c}", 5)).when(
            F.col("outcome") != "dropped", F.col(c)))
    conf = F.when(F.col("outcome").isin("flagged", "dropped"), "uncertain").otherwise(F.col("loc_confidence"))
    return done.select("ord", "plan", "outcome", F.col("_lat").alias("lat"), F.col("_lon").alias("lon"),
                       conf.alias("loc_confidence"))


def area_boxes(areas: DataFrame, k: int | None = None) -> DataFrame:
    """name → box of the first boundary or place that has one, among the first ``k`` hits if that is given."""
    top = tools.first_rows(areas, ["name"], [F.col("rank")], k).filter(
        F.col("class").isin("boundary", "place") & F.col("lat0").isNotNull())
    return top.groupBy("name").agg(F.min_by(F.struct("lat0", "lat1", "lon0", "lon1"), "rank").alias("box"))


def context_region_fix(sections: DataFrame, areas: DataFrame, gaz: DataFrame) -> DataFrame:
    """Points that contradict the region their own text names.

    Outside the region (padded by 0.15°) the name is looked up in the named district, then in the region;
    without a hit the coordinate is dropped. Returns candidate rows with ``outcome``.
    """
    boxes = area_boxes(areas)
    cand = sections.filter(F.col("lat").isNotNull()).withColumn("_a", t.admin_from_text(context_text())).withColumn(
        "region", F.col("_a.region")).withColumn("district", F.concat(F.col("_a.district"), F.lit(", "), F.col("_a.region"))
                                                 ).drop("_a").filter("region is not null").withColumn("name", strip("nearest_locality"))
    j = cand.join(boxes.select(F.col("name").alias("region"), F.col("box").alias("rbox")), "region", "left").join(
        boxes.select(F.col("name").alias("district"), F.col("box").alias("dbox")), "district", "left")
    inside = F.coalesce(g.in_bbox(F.col("lat"), F.col("lon"), F.col("rbox"), 0.15), F.lit(True))
    j = j.withColumn("_in", inside)
    by_d = geocode_in_box_join(j.withColumn("box", F.when(~F.col("_in"), F.col("dbox"))), gaz, out="_d")
    by_r = geocode_in_box_join(by_d.withColumn("box", F.when(~F.col("_in"), F.col("rbox"))), gaz, out="_r")
    new = F.coalesce("_d", "_r")
    out = by_r.withColumn("new", new).withColumn("outcome", F.when(F.col("rbox").isNull(), "no_box").when(F.col("_in"), "ok").when(
        F.col("new").isNotNull(), "fixed").otherwise("dropped"))
    fixed, gone = F.col("outcome") == "fixed", F.col("outcome") == "dropped"
    adm = F.when(fixed & ~not_missing(strip("administrative_unit")), F.col("region")).otherwise(F.col("administrative_unit"))
    return out.select(
        "ord", "region", "outcome", adm.alias("administrative_unit"),
        F.when(fixed, F.round("new.lat", 5)).when(~gone, F.col("lat")).alias("lat"),
        F.when(fixed, F.round("new.lon", 5)).when(~gone, F.col("lon")).alias("lon"),
        F.when(gone, "uncertain").otherwise(F.col("loc_confidence")).alias("loc_confidence"))


def waterway_boxes(names: DataFrame, waterways: DataFrame, k: int | None = None) -> DataFrame:
    """river → box: the first written or de-inflected form with a water body, among its first ``k`` hits if that is given."""
    tried = names.select("river").distinct().select("river", F.posexplode(t.river_variants("river")).alias("pos", "name"))
    top = tools.first_rows(waterways, ["name"], [F.col("rank")], k)
    water = top.filter((F.col("class") == "waterway") | ((F.col("class") == "natural") & F.col("type").isin("water", "stream")))
    first = water.groupBy("name").agg(F.min(F.struct("rank", "lat0", "lat1", "lon0", "lon1")).alias("w"))
    best = tried.join(first, "name").groupBy("river").agg(F.min(F.struct("pos", "w")).alias("b"))
    return best.select("river", F.struct(*[F.col(f"b.w.{c}").alias(c) for c in ("lat0", "lat1", "lon0", "lon1")]).alias("rbox"))


def river_basin_fix(sections: DataFrame, waterways: DataFrame, gaz: DataFrame, max_span: float = 6.0,
                    far_m: float = 50_000) -> DataFrame:
    """Points outside (padded by 0.3°) the box of the river their text names.

    A box wider than ``max_span`` degrees only flags; a narrow one moves the point when a namesake inside
    lies more than ``far_m`` away, and flags otherwise. Returns candidate rows with ``outcome``.
    """
    cand = sections.filter(F.col("lat").isNotNull()).withColumn("river", t.river_from_text(context_text())).filter(
        "river is not null").withColumn("name", strip("nearest_locality"))
    j = cand.join(waterway_boxes(cand, waterways), "river", "left")
    wide = F.greatest(F.col("rbox.lat1") - F.col("rbox.lat0"), F.col("rbox.lon1") - F.col("rbox.lon0")) > max_span
    inside = g.in_bbox(F.col("lat"), F.col("lon"), F.col("rbox"), 0.3)
    j = j.withColumn("_look", F.coalesce(~inside & ~wide, F.lit(False))).withColumn("_in", inside)
    found = geocode_in_box_join(j.withColumn("box", F.when(F.col("_look"), F.col("rbox"))), gaz)
    far = F.col("found").isNotNull() & (g.planar_m(F.col("lat"), F.col("lon"), F.col("found.lat"), F.col("found.lon")) > far_m)
    outcome = (F.when(F.col("rbox").isNull(), "no_box").when(F.col("_in"), "ok")
               .when(F.col("_look") & far, "fixed").otherwise("flagged"))
    out = found.withColumn("outcome", outcome)
    fixed = F.col("outcome") == "fixed"
    return out.select("ord", "river", "outcome",
                      F.when(fixed, F.round("found.lat", 5)).otherwise(F.col("lat")).alias("lat"),
                      F.when(fixed, F.round("found.lon", 5)).otherwise(F.col("lon")).alias("lon"),
                      F.when(F.col("outcome") == "flagged", "uncertain").otherwise(F.col("loc_confidence")).alias("loc_confidence"))


# ---------------------------------------------------------------- nearest points
def near_pairs(left: DataFrame, right: DataFrame, radius_m: float, on: list[str] | None = None,
               keep_left: list[str] | None = None) -> DataFrame:
    """Pairs closer than ``radius_m``, with their distance ``d``, through grid cells.

    ``left`` has lat, lon; ``right`` has rlat, rlon; both are made of distinct coordinates by the caller,
    so the rows of a cell are bounded by the coordinate precision, not by the data.
    """
    step_lat, step_lon = g.grid_step_degrees(radius_m)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = left.withColumn("_cy", F.floor(F.col("lat") / step_lat)).withColumn("_cx", F.floor(F.col("lon") / step_lon))
    b = right.withColumn("_dy", F.explode(around)).withColumn("_dx", F.explode(around))
    b = b.withColumn("_cy", F.floor(F.col("rlat") / step_lat) + F.col("_dy")).withColumn(
        "_cx", F.floor(F.col("rlon") / step_lon) + F.col("_dx")).drop("_dy", "_dx")
    d = g.planar_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon"))
    return a.join(b, ["_cy", "_cx", *(on or [])]).withColumn("d", d).filter(F.col("d") < radius_m).drop("_cy", "_cx")


def snap_to_existing(new: DataFrame, existing: DataFrame, same_name_m: float = 300, any_m: float = 150) -> DataFrame:
    """New points take the nearest same-named point within 300 m, else the nearest point within 150 m.

    The index is the table before the batch: new points do not attract each other. Adds ``snapped``.
    """
    key = F.lower(strip("name"))
    # identical points answer alike: the search runs on distinct coordinates
    pts = new.select(key.alias("nk"), "lat", "lon").distinct()
    old = existing.groupBy(key.alias("nk"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon")).agg(F.min("ord").alias("o"))
    best = F.min(F.struct("d", "o", "rlat", "rlon"))
    named = near_pairs(pts, old, same_name_m, ["nk"]).groupBy("nk", "lat", "lon").agg(best.alias("a"))
    spots = old.groupBy("rlat", "rlon").agg(F.min("o").alias("o"))
    near = near_pairs(pts.select("lat", "lon").distinct(), spots, any_m).groupBy("lat", "lon").agg(best.alias("b"))
    j = new.withColumn("nk", key).join(named, ["nk", "lat", "lon"], "left").join(near, ["lat", "lon"], "left")
    hit = F.coalesce("a", "b")
    return j.withColumn("snapped", hit.isNotNull()).withColumn("_h", hit).withColumn(
        "new_lat", F.coalesce("_h.rlat", "lat")).withColumn("new_lon", F.coalesce("_h.rlon", "lon")).drop(
        "nk", "a", "b", "_h", "lat", "lon").withColumnRenamed("new_lat", "lat").withColumnRenamed("new_lon", "lon")


def too_close_anti(new: DataFrame, existing: DataFrame, m: float = 300) -> DataFrame:
    """Points at least ``m`` metres from existing points and from points accepted before them (by ``ord``).

    Rounds of a parallel greedy pass. Each small cell (any two of its points are closer than ``m``) offers
    its first undecided point; an offer with no earlier offer in the cells around it is accepted, and
    accepted points, which are sparse, reject the undecided points near them. Equal coordinates are decided
    by their first point alone. No list of close pairs is built.
    """
    cell = m / math.sqrt(2) / g.METRES_PER_DEGREE * 0.999
    first = tools.first_rows(new, ["lat", "lon"], [F.col("ord")])
    todo = first.join(near_pairs(
        first.select("lat", "lon"), existing.select(F.col("lat").alias("rlat"), F.col("lon").alias("rlon")).distinct(), m
    ).select("lat", "lon").distinct(), ["lat", "lon"], "left_anti")
    todo = todo.withColumn("_cy", F.floor(F.col("lat") / cell).cast("long")).withColumn("_cx", F.floor(F.col("lon") / cell).cast("long"))
    todo = tools.materialise(todo)
    done = None
    while not todo.isEmpty():
        offers = todo.groupBy("_cy", "_cx").agg(F.min("ord").alias("ord"))
        reach_y = int(math.ceil(m / g.METRES_PER_DEGREE / cell))
        # the longitude reach grows towards the pole: cells are counted at the far edge of the neighbourhood
        far_lat = F.least(F.lit(89.0), (F.abs(F.col("_cy")) + reach_y + 1) * cell)
        reach_x = F.ceil(F.lit(m / g.METRES_PER_DEGREE / cell) / F.cos(F.radians(far_lat))).cast("long")
        seen = offers.select(
            "ord", F.explode(F.sequence(F.col("_cy") - reach_y, F.col("_cy") + reach_y)).alias("_cy"),
            F.sequence(F.col("_cx") - reach_x, F.col("_cx") + reach_x).alias("xs")).select("ord", "_cy", F.explode("xs").alias("_cx"))
        earliest = seen.groupBy("_cy", "_cx").agg(F.min("ord").alias("lowest"))
        winners = offers.join(earliest, ["_cy", "_cx"]).filter(F.col("ord") == F.col("lowest")).select("ord")
        accepted = tools.materialise(todo.join(winners, "ord", "left_semi").drop("_cy", "_cx"))
        done = accepted if done is None else done.unionByName(accepted)
        hit = near_pairs(todo.select("lat", "lon"), accepted.select(F.col("lat").alias("rlat"), F.col("lon").alias("rlon")), m)
        todo = tools.materialise(todo.join(hit.select("lat", "lon").distinct(), ["lat", "lon"], "left_anti"))
    return todo.drop("_cy", "_cx") if done is None else done


def near_work_area(points: DataFrame, anchors: DataFrame, km: float = 150) -> DataFrame:
    """Points of a job within ``km`` of any of its anchors, and all points of jobs without anchors.

    A semi-join stops at the first anchor in reach, and only distinct anchors of the cells around count.
    """
    step_lat, step_lon = km / 111.32, km / 111.32 / math.cos(math.radians(82))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spots = anchors.select("job_id", F.col("lat").alias("alat"), F.col("lon").alias("alon")).distinct()
    grid = spots.withColumn("_dy", F.explode(around)).withColumn("_dx", F.explode(around)).select(
        F.col("job_id").alias("aj"), "alat", "alon", (F.floor(F.col("alat") / step_lat) + F.col("_dy")).alias("ay"),
        (F.floor(F.col("alon") / step_lon) + F.col("_dx")).alias("ax"))
    p = points.withColumn("_cy", F.floor(F.col("lat") / step_lat)).withColumn("_cx", F.floor(F.col("lon") / step_lon))
    near = p.join(grid, (F.col("job_id") == F.col("aj")) & (F.col("_cy") == F.col("ay")) & (F.col("_cx") == F.col("ax"))
                  & (g.planar_m(F.col("lat"), F.col("lon"), F.col("alat"), F.col("alon"), 111.32) <= km), "left_semi")
    free = p.join(anchors.select("job_id").distinct(), "job_id", "left_anti")
    return near.unionByName(free).drop("_cy", "_cx")


HALF_ROUND = 20_100_000.0  # metres to the other side of the Earth


def accuracy_radius_join(points: DataFrame, gaz: DataFrame, reach_m: float = 5000) -> DataFrame:
    """Radius by the type of the nearest gazetteer place; the default where the gazetteer is empty.

    Points without a place within ``reach_m`` look four times as far, until all have one.
    """
    table = F.create_map(*[x for k, v in vocab.RADIUS_BY_TYPE.items() for x in (F.lit(k), F.lit(v))])
    pts = points.select("lat", "lon").distinct()
    places = gaz.groupBy(F.col("lat").alias("rlat"), F.col("lon").alias("rlon")).agg(F.min(F.struct("rank", "type")).alias("p"))
    best, todo = None, pts
    while True:
        found = near_pairs(todo, places, reach_m).groupBy("lat", "lon").agg(F.min(F.struct("d", "p")).alias("b"))
        found = tools.materialise(found)
        best = found if best is None else best.unionByName(found)
        todo = tools.materialise(todo.join(found.select("lat", "lon"), ["lat", "lon"], "left_anti"))
        if reach_m > HALF_ROUND or todo.isEmpty():
            break
        reach_m *= 4
    radius = best.select("lat", "lon", F.coalesce(F.try_element_at(table, F.col("b.p.type")), F.lit(vocab.DEFAULT_RADIUS)).alias("radius_m"))
    return pts.join(radius, ["lat", "lon"], "left").withColumn("radius_m", F.coalesce("radius_m", F.lit(vocab.DEFAULT_RADIUS)))


def dem_lookup_join(points: DataFrame, grid: DataFrame, step: float) -> DataFrame:
    """Terrain height of every distinct coordinate from a grid table (cy, cx, height)."""
    pts = points.select("lat", "lon").distinct().withColumn("cy", F.floor(F.col("lat") / step)).withColumn(
        "cx", F.floor(F.col("lon") / step))
    return pts.join(grid, ["cy", "cx"], "left").select("lat", "lon", "height")


def sidecar_join(markers: DataFrame, dem: DataFrame, acc: DataFrame) -> DataFrame:
    """Height and radius of a marker on coordinates rounded to five digits."""
    keyed = markers.withColumn("lat5", F.round("lat", 5)).withColumn("lon5", F.round("lon", 5))
    h = dem.select("lat5", "lon5", F.col("v").alias("elev_dem"))
    a = acc.select("lat5", "lon5", F.col("v").alias("_acc"))
    return keyed.join(h, ["lat5", "lon5"], "left").join(a, ["lat5", "lon5"], "left").withColumn(
        "accuracy", F.coalesce("_acc", F.lit(float(vocab.DEFAULT_RADIUS)))).drop("_acc", "lat5", "lon5")


def named_region_counts(df: DataFrame, column: str, k: int = 12) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def stage_audit(df: DataFrame, column: str = "outcome") -> DataFrame:
    """Rows per outcome of a repair stage."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))

