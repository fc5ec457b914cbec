"""Sub-sites: placing them from phrases and neighbours, linking them to their summary site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import text as t
from . import places, tools
from .containment import containing


def anchor_resolve(sub: DataFrame, anchors: DataFrame, gaz: DataFrame) -> DataFrame:
    """Base point of sub-sites: parent, else the one known site their reason names, else a known site inside
    the anchor phrase, else the gazetteer's first answer. Adds base_lat, base_lon, base_by.

    Sites are made distinct by name within a publication before the join; phrases meet the names they contain through
    the rarest substring of each name.
    """
    key = t.plain_key
    a = anchors.select("job_id", key("locality").alias("k"), "lat", "lon", "ord").filter("k <> ''").groupBy("job_id", "k").agg(
        F.min(F.struct("ord", "lat", "lon")).alias("p"))
    s = sub.withColumn("pk", key("parent")).withColumn("ak", key("anchor")).withColumn("wk", key("why")).withColumn(
        "usable", ~t.is_hedged("why"))
    parent = s.filter(F.col("usable") & (F.col("relation") != vocab.REL_FOREIGN)).join(
        a.withColumnRenamed("k", "pk"), ["job_id", "pk"]).select("ord", F.col("p").alias("p1"))
    # phrases are compared as texts, once each: many sub-sites repeat them
    free = s.filter(F.col("usable") & (F.col("anchor") == "") & (F.col("parent") == "")).select("ord", "job_id", "wk")
    told = containing(free, a, ["job_id"], "wk", "k").groupBy("job_id", "wk").agg(F.count(F.lit(1)).alias("c"), F.min("k").alias("k"))
    told = told.filter("c = 1").join(a, ["job_id", "k"]).select("job_id", "wk", F.col("p").alias("p2"))
    told = free.join(told, ["job_id", "wk"]).select("ord", "p2")
    phrase = s.filter(F.col("usable") & (F.col("anchor") != "")).select("ord", "job_id", "ak")
    inside = containing(phrase, a, ["job_id"], "ak", "k").join(a, ["job_id", "k"]).groupBy("job_id", "ak").agg(F.min("p").alias("p3"))
    inside = phrase.join(inside, ["job_id", "ak"]).select("ord", "p3")
    first = gaz.groupBy(F.col("name").alias("anchor")).agg(F.min(F.struct("rank", "lat", "lon")).alias("p4"))
    j = s.join(parent, "ord", "left").join(told, "ord", "left").join(inside, "ord", "left").join(first, "anchor", "left")
    p4 = F.when(F.col("usable") & (F.col("anchor") != "") & ~t.is_internal_label("anchor"), F.col("p4"))
    lat = F.coalesce("p1.lat", "p2.lat", "p3.lat", p4["lat"])
    lon = F.coalesce("p1.lon", "p2.lon", "p3.lon", p4["lon"])
    by = (F.when(F.col("p1").isNotNull(), "parent").when(F.col("p2").isNotNull(), "reason").when(F.col("p3").isNotNull(), "phrase")
          .when(p4.isNotNull(), "gazetteer"))
    return j.withColumn("base_lat", lat).withColumn("base_lon", lon).withColumn("base_by", by).drop(
        "pk", "ak", "wk", "usable", "p1", "p2", "p3", "p4")


def place_from_base(sub: DataFrame, anchors: DataFrame | None = None) -> DataFrame:
    """Coordinates and accuracy from the base point; points far from their publication's sites stay unplaced."""
    phrase = F.concat_ws(" ", "anchor", "why")
    p = sub.withColumn("_p", F.when(F.col("base_lat").isNotNull(), g.offset_point(
        F.col("base_lat"), F.col("base_lon"), F.col("direction"), F.col("offset_km"), phrase)))
    out = p.withColumn("lat", F.col("_p.lat")).withColumn("lon", F.col("_p.lon")).withColumn("accuracy", F.col("_p.accuracy")).drop("_p")
    return _drop_far(out, anchors)


def _drop_far(df: DataFrame, anchors: DataFrame | None) -> DataFrame:
    if anchors is None:
        return df
    ok = places.near_work_area(df.filter("lat is not null"), anchors).select("ord", F.lit(True).alias("_ok"))
    j = df.join(ok, "ord", "left")
    for c in ("lat", "lon", "accuracy"):
        j = j.withColumn(c, F.when(F.col("_ok"), F.col(c)))
    return j.drop("_ok")


def hierarchy_placement(sub: DataFrame, anchors: DataFrame | None = None) -> DataFrame:
    """Sub-sites tied to neighbours that have just been placed, until nothing more can be.

    A parent beats an anchor, and only an anchor that is not the parent adds its offset: the parent's own
    point already holds it. A round places all that its predecessor made possible, and sub-sites tied only to
    each other stay unplaced.
    """
    key = t.plain_key
    cur = sub if "inherited_from" in sub.columns else sub.withColumn("inherited_from", F.lit(None).cast("string"))
    cols = cur.columns
    while True:
        placed = cur.filter("lat is not null").groupBy(key("name").alias("k")).agg(
            F.max(F.struct("ord", "lat", "lon", "accuracy", "name")).alias("p"))
        todo = cur.filter("lat is null").withColumn("pk", key("parent")).withColumn("ak", key("anchor"))
        j = todo.join(placed.select(F.col("k").alias("pk"), F.col("p").alias("bp")), "pk", "left").join(
            placed.select(F.col("k").alias("ak"), F.col("p").alias("ba")), "ak", "left")
        base = F.coalesce("bp", "ba")
        own = F.col("bp").isNull() & F.col("ba").isNotNull() & (F.col("ak") != F.col("pk")) & (F.col("anchor") != "")
        phrase = F.concat_ws(" ", F.when(own, F.col("anchor")).otherwise(""), "why")
        point = g.offset_point(base["lat"], base["lon"], F.when(own, F.col("direction")).otherwise("нет"),
                               F.when(own, F.col("offset_km")).otherwise(0.0), phrase)
        new = j.withColumn("_b", base).filter("_b is not null").withColumn("_p", point)
        acc = F.when(F.col("offset_km") != 0, F.col("_p.accuracy")).otherwise(
            F.greatest(F.lit(500), F.coalesce("_b.accuracy", F.lit(1500))))
        new = new.withColumn("lat", F.col("_p.lat")).withColumn("lon", F.col("_p.lon")).withColumn(
            "accuracy", acc.cast("bigint")).withColumn("inherited_from", F.col("_b.name")).select(*cols)
        new = tools.materialise(_drop_far(new, anchors).filter("lat is not null").select(*cols))
        if new.isEmpty():
            return cur
        cur = tools.materialise(cur.join(new.select("ord"), "ord", "left_anti").select(*cols).unionByName(new))


def hierarchy_root(sub: DataFrame) -> DataFrame:
    """Real object above each placed sub-site: climb while the parent is itself a new sub-site.

    Adds ``root`` (name key, empty when the climb ends in nothing, in itself or goes in a circle). Each round doubles
    the length of the links, so a chain of n steps takes log n rounds.
    """
    key = t.plain_key
    placed = sub.filter("lat is not null")
    own, par = key("name"), key(F.coalesce(F.when(F.col("parent") != "", F.col("parent")), F.col("inherited_from"), F.lit("")))
    rows = placed.withColumn("_own", own).withColumn("_par", par)
    link = rows.groupBy(F.col("_own").alias("cur")).agg(F.min(F.struct("ord", "_par")).alias("l"),
                                                       F.bool_or(F.col("relation") != vocab.REL_SAME).alias("is_sub"))
    link = link.select("cur", F.col("l._par").alias("up"), "is_sub")
    # where one step from a name leads: a name that is no sub-site is a root and stays
    step = F.when(~F.col("is_sub"), F.col("cur")).when(F.col("up") == F.col("cur"), "").otherwise(F.coalesce("up", F.lit("")))
    jump = tools.materialise(link.select("cur", step.alias("to")))
    length, names = 1, jump.count()
    while length <= names:
        further = jump.alias("a").join(jump.select(F.col("cur").alias("to"), F.col("to").alias("then")).alias("b"), "to", "left")
        new = tools.materialise(further.select("cur", F.when(F.col("to") == "", "").otherwise(F.coalesce("then", "to")).alias("to")))
        same = new.join(jump, ["cur", "to"], "left_anti").isEmpty()
        jump, length = new, length * 2
        if same:
            break
    # names that still lead to a sub-site go in a circle
    real = jump.join(link.filter("is_sub").select(F.col("cur").alias("to")), "to", "left_anti")
    ends = jump.select("cur").join(real, "cur", "left").select(F.col("cur").alias("_par"), F.coalesce("to", F.lit("")).alias("_end"))
    out = rows.join(ends, "_par", "left").withColumn(
        "root", F.when(F.col("_par") == F.col("_own"), "").otherwise(F.coalesce("_end", "_par")))
    return out.drop("_own", "_par", "_end")


def existing_row_anti(new: DataFrame, sections: DataFrame) -> DataFrame:
    """Drop objects the table already has under the same name and point, and second names of a place."""
    have = sections.filter("lat is not null").select(
        F.lower(F.trim("nearest_locality")).alias("_n"), F.round("lat", 5).alias("_la"), F.round("lon", 5).alias("_lo")).distinct()
    keyed = new.filter(F.coalesce("relation", F.lit("")) != vocab.REL_SAME)
    cond = (F.lower(F.trim("name")) == F.col("_n")) & (F.round("lat", 5) == F.col("_la")) & (F.round("lon", 5) == F.col("_lo"))
    return keyed.join(have, cond, "left_anti")


def hierarchy_links(sub: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(includes, part_of): children of a real object's marker, and the parent name on a child's marker.

    Both only name rows that exist in the table; nothing links to itself.
    """
    def marker(lat, lon):
        return F.concat(F.round(lat, 5).cast("string"), F.lit(","), F.round(lon, 5).cast("string"))

    located = sections.filter("lat is not null")
    byname = located.groupBy(t.plain_key("nearest_locality").alias("root")).agg(
        F.min(F.struct("ord", marker("lat", "lon").alias("m"), "nearest_locality")).alias("s"))
    have = located.select(F.lower(F.trim("nearest_locality")).alias("_n"), F.round("lat", 5).alias("_la"), F.round("lon", 5).alias("_lo")).distinct()
    j = hierarchy_root(sub).filter("root <> ''").withColumn("at", marker("lat", "lon")).join(byname, "root").filter(
        F.col("s.m") != F.col("at"))
    part_of = j.select(F.col("at").alias("marker"), F.col("s.nearest_locality").alias("part_of"))
    real = j.join(have, (F.lower(F.trim("name")) == F.col("_n")) & (F.round("lat", 5) == F.col("_la"))
                  & (F.round("lon", 5) == F.col("_lo")), "left_semi")
    includes = real.filter(t.plain_key("name") != F.col("root")).select(F.col("s.m").alias("marker"), "name", "at").distinct()
    return includes, part_of
