"""Upload jobs: queue, review decisions, merge into the master table, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import numbers as n
from ..functions.common import WORD, let, strip
from . import groups, places, tools


# ---------------------------------------------------------------- folding logs
def latest_decision(log: DataFrame) -> DataFrame:
    """Last decision of every (job, i)."""
    rest = [c for c in log.columns if c not in ("job_id", "i", "ts")]
    return log.groupBy("job_id", "i").agg(F.max(F.struct("ts", *rest)).alias("d")).select(
        "job_id", "i", "d.ts", *[f"d.{c}" for c in rest])


def latest_job_status(log: DataFrame, order: str = "updated") -> DataFrame:
    """Key-wise overwrite: each column keeps its last value that is not NULL."""
    cols = [c for c in log.columns if c not in ("job_id", order)]
    return log.groupBy("job_id").agg(F.max(order).alias(order), *[
        F.max(F.when(F.col(c).isNotNull(), F.struct(order, c)))[c].alias(c) for c in cols])


def latest_coordinate_fix(corr: DataFrame) -> DataFrame:
    """Last commented entry other than "correct" with a plausible coordinate, per marker file."""
    c = corr.withColumn("_p", t_coords()).filter(
        (strip(F.coalesce("comment", F.lit(""))) != "") & (F.coalesce("verdict", F.lit("")) != "correct")
        & F.coalesce(g.valid_coord(F.col("_p.lat"), F.col("_p.lon"), 35), F.lit(False)))
    last = c.groupBy("marker_key").agg(F.max(F.struct(
        "ord", F.round("_p.lat", 6).alias("lat"), F.round("_p.lon", 6).alias("lon"), "comment", "reviewer")).alias("f"))
    return last.select("marker_key", "f.ord", "f.lat", "f.lon", "f.comment", "f.reviewer")


def t_coords() -> Column:
    return g.coords_from_comment("comment")


def resumable_progress(chunks: DataFrame) -> DataFrame:
    """Pages done so far, whether the text is complete, and the pages left, per path."""
    p = chunks.groupBy("path").agg(F.max("done_upto").alias("done_upto"), F.bool_or("complete").alias("complete"),
                                   F.max("total").alias("total"))
    left = F.when(F.col("complete"), 0).otherwise(F.greatest(F.col("total") - F.col("done_upto"), F.lit(0)))
    return p.select("path", "done_upto", "complete", left.cast("bigint").alias("pages_left"),
                    F.when(F.col("complete"), "done").otherwise("queued").alias("status"))


# ---------------------------------------------------------------- queue
def queue_index(status: DataFrame, props: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row per job: objects, with coordinates, decided."""
    found = props.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.count("lat").alias("geo"))
    decided = decisions.select("job_id", "i").distinct().groupBy("job_id").agg(F.count(F.lit(1)).alias("checked"))
    decided = decided.join(found.select("job_id"), "job_id", "left_semi")
    j = status.join(found, "job_id", "left").join(decided, "job_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return j.select(F.col("job_id").alias("id"), F.coalesce("filename", "job_id").alias("name"),
                    F.coalesce("status", F.lit("?")).alias("status"), zero("n"), zero("geo"), zero("checked"),
                    F.coalesce("submitter", F.lit("")).alias("src"), F.coalesce("created", F.lit(0)).alias("created"),
                    F.coalesce("msg", F.lit("")).alias("msg"))


def queue_filter(q: DataFrame, text: str = "", status: list[str] | None = None, found: bool = False,
                 geo: bool = False, todo: bool = False) -> DataFrame:
    if text.strip():
        q = q.filter(F.contains(F.lower("name"), F.lit(text.strip().lower())))
    if status:
        q = q.filter(F.col("status").isin(status))
    if found:
        q = q.filter("n > 0")
    if geo:
        q = q.filter("geo > 0")
    return q.filter("n > checked") if todo else q


def queue_order(q: DataFrame) -> DataFrame:
    """Unfinished first, then more objects, then more coordinates."""
    return q.orderBy((F.col("checked") >= F.col("n")) & (F.col("n") > 0), F.desc("n"), F.desc("geo"), "id")


def queue_page(q: DataFrame, sort: str = "n", offset: int = 0, limit: int = 25) -> tuple[DataFrame, DataFrame]:
    """(page, totals) of a sorted queue; the page holds 1 to 200 rows."""
    keys = {"n": F.desc("n"), "geo": F.desc("geo"), "new": F.desc("created"), "name": F.asc("name")}
    page = q.orderBy(keys.get(sort, keys["n"]), "id").offset(max(0, offset)).limit(min(200, max(1, limit)))
    return page, q.agg(F.count(F.lit(1)).alias("total"))


def recent_jobs(status: DataFrame, k: int = 50, by: str = "created") -> DataFrame:
    return status.orderBy(F.desc(by), "job_id").limit(k)


def queue_outcome(status: DataFrame) -> DataFrame:
    """Jobs per status, how many have proposals, and how many proposals."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("n") > 0).alias("with_proposals"),
                                        F.coalesce(F.sum("n"), F.lit(0)).alias("proposals"))


def select_queue_jobs(status: DataFrame, done: DataFrame, take: list[str], limit: int | None = None) -> DataFrame:
    todo = status.filter(F.col("status").isin(take)).join(done.select("job_id"), "job_id", "left_anti").orderBy("job_id")
    return todo.limit(limit) if limit else todo


def pending_no_coord(props: DataFrame) -> DataFrame:
    """Proposals without a coordinate whose place has a name."""
    return props.filter(F.col("lat").isNull() & ~F.coalesce(strip("locality"), F.lit("")).isin("", "ND", "не указано"))


# ---------------------------------------------------------------- proposals
CROWDED = 10_000  # records of a bucket of jobs up to which a job is put together in one place; a matter of cost, not of results
_BUCKETS = 1 << 16
_KEYS = ["job_id", "locality"]
_LISTS = ("excavation", "deposits", "strat", "dating", "source_kinds", "geomorph", "raw_terms", "thickness", "evidence")


def build_proposals(recs: DataFrame, hits: DataFrame | None = None, crowded: int = CROWDED) -> DataFrame:
    """Records of a job grouped by place, largest group first.

    ``recs``: job_id, ord, locality, admin, elevation (text or NULL), excavation, geomorph, deposits,
    raw_terms, thickness, strat, dating, source_kinds, quotes (arrays). ``hits``: job_id, evidence, page.
    Records travel once, to their job. Jobs of buckets that hold more than ``crowded`` records, and four times the mean, are
    spread over their values instead.
    """
    named = tools.once(recs.withColumnRenamed("locality", "_name"), "locality", strip("_name")).drop("_name") \
        .filter(F.col("locality").isNotNull() & ~F.col("locality").isin("", "ND"))
    quotes = F.transform("quotes", lambda x: F.nullif(strip(x), F.lit("[]"))).alias("evidence")
    rows = named.select(*_KEYS, "ord", "admin", "elevation", *_LISTS[:-1], quotes).withColumn(
        "_bucket", F.pmod(F.xxhash64("job_id"), F.lit(_BUCKETS)))
    sizes = tools.materialise(recs.groupBy(F.pmod(F.xxhash64("job_id"), F.lit(_BUCKETS)).alias("_bucket")).agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.filter(F.col("n") > max(crowded, 4 * total // _BUCKETS)).select("_bucket")
    if hot.isEmpty():
        out = _proposals_by_job(rows)
    else:
        hot = F.broadcast(hot)
        out = _proposals_by_job(rows.join(hot, "_bucket", "left_anti")).unionByName(_proposals_by_value(rows.join(hot, "_bucket", "left_semi")))
    if hits is not None:
        pages = out.select(*_KEYS, F.explode("evidence").alias("evidence")).join(hits, ["job_id", "evidence"]).select(*_KEYS, "page").distinct()
        out = out.join(pages.groupBy(*_KEYS).agg(F.sort_array(F.collect_list("page")).alias("pages")), _KEYS, "left")
    return out


def _known(v: Column) -> Column:
    return v.isNotNull() & ~v.isin("", "ND")


def _plain_fields() -> list[Column]:
    def first(c: str) -> Column:
        return F.coalesce(F.min(F.when(_known(F.col(c)), F.struct("ord", c)))[c], F.lit("ND")).alias(c)
    return [F.count(F.lit(1)).alias("n_records"), F.min("ord").alias("first"), first("admin"), first("elevation")]


def _proposals_by_job(rows: DataFrame) -> DataFrame:
    """Proposals of jobs of bounded size: one shuffle by job serves groups, lists and numbers."""
    def listed(c: str) -> Column:
        placed = F.flatten(F.transform("z", lambda x: F.transform(F.coalesce(x[c], F.array().cast("array<string>")), lambda v, i: F.struct(
            groups.place_of(x["ord"], i).alias("first"), v.alias("v")))))
        return F.array_distinct(F.transform(F.sort_array(F.filter(placed, lambda e: _known(e["v"]))), lambda e: e["v"])).alias(c)

    cells = rows.repartition("job_id").groupBy(*_KEYS).agg(*_plain_fields(), F.collect_list(F.struct("ord", *_LISTS)).alias("z"))
    cells = cells.select(*_KEYS, "n_records", "first", "admin", "elevation", *[listed(c) for c in _LISTS])
    line = Window.partitionBy("job_id").orderBy(F.desc("n_records"), "first", "locality")
    return cells.withColumn("i", F.row_number().over(line).cast("bigint") - 1).select(
        *_KEYS, "n_records", "admin", "elevation", "i", *_LISTS)


def _proposals_by_value(rows: DataFrame) -> DataFrame:
    """Proposals of crowded jobs: values are rows of their own until the cells are written, and no task holds all rows of a job."""
    core = tools.materialise(rows.groupBy(*_KEYS).agg(*_plain_fields()))
    lists = groups.open_values(rows, _KEYS, {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in _LISTS})
    # numbers need the keys and the counts only; the lists join the numbered rows by their group
    numbered = tools.ordinal(core.select(*_KEYS, "n_records", "first"), ["job_id"], [F.desc("n_records"), F.col("first"), F.col("locality")], "i") \
        .select(*_KEYS, "i")
    cells = lists.filter(_known(F.col("v"))).groupBy(*_KEYS).agg(*[groups.seen(c).alias(f"x_{c}") for c in _LISTS])
    out = core.join(numbered, _KEYS).join(cells, _KEYS, "left")
    empty = F.array().cast("array<string>")
    return out.select(*_KEYS, "n_records", "admin", "elevation", "i", *[F.coalesce(groups.by_place(F.col(f"x_{c}")), empty).alias(c) for c in _LISTS])


def job_bundle_join(props: DataFrame, decisions: DataFrame, status: DataFrame) -> DataFrame:
    """Proposals with their last decision and their job's file name."""
    return props.join(latest_decision(decisions), ["job_id", "i"]).join(status.select("job_id", "filename", "status"), "job_id", "left")


def accepted_with_coords(props: DataFrame, decisions: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted with coordinates and not merged yet, accepted without coordinates)."""
    ok = latest_decision(decisions).filter("verdict = 'accept'").join(ledger.select("job_id", "i"), ["job_id", "i"], "left_anti")
    j = props.join(ok.select("job_id", "i", "reviewer"), ["job_id", "i"])
    return j.filter("lat is not null"), j.filter("lat is null")


def master_rows(accepted: DataFrame, status: DataFrame) -> DataFrame:
    """Accepted proposals (arrays) as master rows, with the (job_id, i) they come from."""
    def join(c: str) -> Column:
        return F.array_join(F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull() & ~x.isin("", "ND")), "; ")

    e = n.elev_bounds("elevation")
    j = accepted.join(status.select("job_id", "filename"), "job_id", "left")
    return j.select(
        F.coalesce("locality", F.lit("")).alias("nearest_locality"), F.coalesce("admin", F.lit("ND")).alias("administrative_unit"),
        join("excavation").alias("excavation_type"), join("geomorph").alias("geomorphic_position"),
        join("deposits").alias("type_of_deposits"), join("raw_terms").alias("deposit_raw_terms"),
        *[n.kind_value(F.col("thickness"), k).alias(f"thickness_{k}") for k in vocab.THICKNESS_KINDS],
        e["first"].alias("elevation_min_m"), e["last"].alias("elevation_max_m"), join("strat").alias("stratigraphic_position"),
        join("dating").alias("dating_methods"), join("source_kinds").alias("source_kinds"),
        F.coalesce("n_records", F.lit(1)).cast("bigint").alias("n_records"), F.lit(1).cast("bigint").alias("n_sources"),
        F.concat(F.coalesce("filename", "job_id"), F.lit(vocab.UPLOAD_MARK)).alias("sources"),
        F.array_join("evidence", " || ").alias("evidence"),
        "lat", "lon", F.lit("ok").alias("loc_confidence"), "job_id", "i")


class ContractError(ValueError):
    """Rows do not fit the master table."""


def append_accepted(master: DataFrame, rows: DataFrame) -> DataFrame:
    """Master table plus mapped proposals, exactly the 22 master columns; both must carry them."""
    for df in (master, rows):
        lacking = [c for c in vocab.MASTER_COLUMNS if c not in df.columns]
        if lacking:
            raise ContractError(f"missing master columns: {lacking}")
    return master.select(*vocab.MASTER_COLUMNS).unionByName(rows.select(*vocab.MASTER_COLUMNS))


def idempotent_merge(accepted: DataFrame, ledger: DataFrame, master: DataFrame) -> DataFrame:
    """Accepted proposals with coordinates that are in neither the ledger nor the master, moved onto existing points.

    One without coordinates waits: it is not merged, and may be once it is located.
    The check against the master's (job_id, i) covers a run that stopped between the two writes.
    """
    new = accepted.filter("lat is not null and lon is not null").join(ledger.select("job_id", "i"), ["job_id", "i"], "left_anti").join(
        master.filter("job_id is not null").select("job_id", "i"), ["job_id", "i"], "left_anti")
    new = tools.first_rows(new, ["job_id", "i"], [F.col("lat"), F.col("lon")])
    pts = new.withColumn("name", F.col("locality")).withColumn("lat", F.round("lat", 5)).withColumn("lon", F.round("lon", 5))
    old = master.filter("lat is not null").select(F.col("nearest_locality").alias("name"), "lat", "lon",
                                                  F.xxhash64("nearest_locality", "lat", "lon").alias("ord"))
    return places.snap_to_existing(pts, old).drop("name", "snapped")


def incremental_enrich(points: DataFrame, previous: DataFrame, compute) -> DataFrame:
    """Sidecar rows for coordinates that have none yet, added to the stored ones.

    ``compute`` maps distinct (lat, lon) to (lat, lon, v).
    """
    keyed = points.select(F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon")).distinct()
    todo = keyed.join(previous.select("lat", "lon"), ["lat", "lon"], "left_anti")
    return previous.select("lat", "lon", "v").unionByName(compute(todo).select("lat", "lon", "v"))


def ledger_anti(df: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(ledger.select(*keys).distinct(), keys, "left_anti")


# ---------------------------------------------------------------- corrections
def correction_apply_join(sections: DataFrame, fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sections with every row of a fixed marker moved, fixes whose marker no longer exists)."""
    key = g.storage_key(g.marker_key(F.col("lat"), F.col("lon")))
    rows = sections.withColumn("marker_key", F.when(F.col("lat").isNotNull(), key))
    f = fixes.select("marker_key", F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    j = rows.join(f, "marker_key", "left")
    hit = F.col("_la").isNotNull()
    moved = j.withColumn("loc_confidence", F.when(hit, "ok").otherwise(F.col("loc_confidence"))).withColumn(
        "lat", F.coalesce("_la", "lat")).withColumn("lon", F.coalesce("_lo", "lon")).withColumn("moved", hit).drop("_la", "_lo")
    return moved, fixes.join(rows.select("marker_key").distinct(), "marker_key", "left_anti")


def apply_fix_log(corr: DataFrame, ledger: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(moved sections, ledger additions, replies): new coordinate fixes, each applied once."""
    new = ledger_anti(latest_coordinate_fix(corr), ledger, ["marker_key"])
    moved, missed = correction_apply_join(sections, new)
    names = moved.filter("moved").groupBy("marker_key").agg(F.min_by("nearest_locality", "ord").alias("locality"))
    added = new.join(missed.select("marker_key"), "marker_key", "left_anti").join(names, "marker_key").select(
        "marker_key", "locality", g.marker_key(F.col("lat"), F.col("lon")).alias("to"), F.col("reviewer").alias("by"),
        "comment")
    text = F.concat(F.lit("ИСПРАВЛЕНО: координаты обновлены на "), F.col("lat").cast("string"), F.lit(", "),
                    F.col("lon").cast("string"), F.lit(" по замечанию проверяющего"))
    target = F.explode(F.array(g.storage_key(g.marker_key(F.col("lat"), F.col("lon"))), F.col("marker_key")))
    replies = new.select(target.alias("section_id"), F.lit("location").alias("field"), F.lit("correct").alias("verdict"),
                         text.alias("comment"), F.lit(vocab.SYSTEM_USER).alias("reviewer"))
    return moved, added, replies


def orphan_corrections(corr: DataFrame, live: DataFrame) -> DataFrame:
    """People's entries whose marker no longer exists."""
    return corr.filter(F.coalesce("reviewer", F.lit("")) != vocab.SYSTEM_USER).join(live.select("marker_key").distinct(), "marker_key", "left_anti")


def nearest_or_only(points: DataFrame, markers: DataFrame, limit_m: float, sure_m: float = 1000.0) -> DataFrame:
    """(marker_key, marker): the nearest marker within ``sure_m`` of a key's points, else the only one within ``limit_m``.

    Rings grow by doubling: a key leaves once it has a sure marker or a second one, so the many markers of a crowded area
    are met at the smallest distance only. Markers of one point count as many and are one row.
    """
    spots = markers.groupBy(F.col("lat").alias("rlat"), F.col("lon").alias("rlon")).agg(F.min("marker").alias("marker"), F.count(F.lit(1)).alias("n"))
    spots, todo = tools.materialise(spots), tools.materialise(points)
    radius, found = min(sure_m, limit_m), None
    while True:
        met = places.near_pairs(todo, spots, radius).groupBy("marker_key").agg(F.sum("n").alias("k"), F.min(F.struct("d", "marker")).alias("m"))
        met = tools.materialise(met.select("marker_key", "k", "m.marker", (F.col("m.d") < sure_m).alias("sure")))
        last = radius >= limit_m
        chosen = met.filter(F.col("sure") | ((F.col("k") == 1) & F.lit(last))).select("marker_key", "marker")
        found = chosen if found is None else found.unionByName(chosen)
        if last:
            return found
        left = tools.materialise(todo.join(met.filter("sure or k > 1").select("marker_key"), "marker_key", "left_anti"))
        tools.forget(todo)
        todo, radius = left, min(radius * 2, limit_m)


def orphan_resolve(orphans: DataFrame, moved: DataFrame, markers: DataFrame, limit_km: float = 5) -> DataFrame:
    """Where entries of vanished markers belong: (marker_key, target, why).

    First the recorded move, if its target exists; then the one marker (name of five letters or more) their
    text names as a whole word; then the nearest marker within ``limit_km`` if it is the only one or
    within 1 km. ``moved``: marker_key, to; ``markers``: marker, name, lat, lon.
    """
    keys = orphans.select("marker_key").distinct()
    led = keys.join(moved, "marker_key").join(markers.select(F.col("marker").alias("to")), "to", "left_semi").groupBy(
        "marker_key").agg(F.max("to").alias("a"))

    # a name is looked up through the word that fewest names have; namesakes collapse to one row first
    tokens = lambda c: F.regexp_extract_all(F.lower(c), F.lit(f"[{WORD}]+"), F.lit(0))
    names = markers.filter(F.length("name") >= 5).groupBy(F.lower("name").alias("nm")).agg(
        F.min("marker").alias("lo"), F.max("marker").alias("hi"))
    each = names.select("nm", "lo", "hi", F.explode(F.array_distinct(tokens("nm"))).alias("w"))
    often = each.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    keyed = each.join(often, "w").groupBy("nm", "lo", "hi").agg(F.min(F.struct("n", (-F.length("w")).alias("l"), "w"))["w"].alias("w"))
    words = orphans.filter("comment <> ''").select("marker_key", "comment").distinct().select(
        "marker_key", "comment", F.explode(F.array_distinct(tokens("comment"))).alias("w"))
    named = words.join(keyed, "w").filter(F.rlike(F.lower("comment"), F.concat(
        F.lit(f"(?<![{WORD}])\\Q"), F.col("nm"), F.lit(f"\\E(?![{WORD}])"))))
    nm = named.groupBy("marker_key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo = hi").select(
        "marker_key", F.col("lo").alias("b"))

    cuts = keys.select("marker_key", F.explode(g.split_marker_key("marker_key")).alias("p")).select("marker_key", "p.lat", "p.lon")
    nr = nearest_or_only(cuts, markers.select("marker", "lat", "lon"), limit_km * 1000.0).withColumnRenamed("marker", "c")
    j = keys.join(led, "marker_key", "left").join(nm, "marker_key", "left").join(nr, "marker_key", "left")
    return j.select("marker_key", F.coalesce("a", "b", "c").alias("target"),
                    F.when(F.col("a").isNotNull(), "ledger").when(F.col("b").isNotNull(), "named")
                    .when(F.col("c").isNotNull(), "nearest").alias("why"))


def append_corrections_dedup(cur: DataFrame, add: DataFrame) -> DataFrame:
    """Moved entries join the target's list unless it has the same verdict, comment and time."""
    c = cur.select(*[F.col(x).alias(f"_{x}") for x in ("marker_key", "verdict", "comment", "ts")])
    same = (F.col("marker_key") == F.col("_marker_key"))
    for x in ("verdict", "comment", "ts"):
        same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
    return cur.unionByName(add.join(c, same, "left_anti"), allowMissingColumns=True)


def publish_guard(new: DataFrame, prev: DataFrame, keep: float = 0.9) -> DataFrame:
    """Counts of both versions and whether the new one may replace the old."""
    a, b = new.agg(F.count(F.lit(1)).alias("new_markers")), prev.agg(F.count(F.lit(1)).alias("old_markers"))
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").select(
        "new_markers", "old_markers", (F.col("new_markers") >= F.col("old_markers") * keep).alias("publish"))

