"""Jobs, corrections, sub-sites, crawl and streams."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import text as t
from ..operators import crawl as c
from ..operators import hierarchy as h
from ..operators import jobs as j
from ..operators import places as geo_places
from ..operators import tools
from ..sources import readers
from ..streaming import jobs as st
from . import duck as d
from .core import query
from .places import best_hit_sql

_LAST = "(select job_id, i, arg_max(verdict, ts) as verdict, arg_max(reviewer, ts) as reviewer, max(ts) as ts from fx_decisions group by job_id, i)"


def _big(df, *cols):
    for x in cols or ("i",):
        df = df.withColumn(x, F.col(x).cast("bigint"))
    return df


@query("latest_decision", f"select job_id, i, ts, verdict, reviewer from {_LAST} x")
def _(v):
    return j.latest_decision(v.decisions)


_LOG = "(select concat('job', cast(user_id as varchar(9))) as job_id, event_id as updated, case when event_id % 3 = 0 then event_type end as status, case when event_id % 4 = 0 then props end as msg, case when event_id % 5 = 0 then event_id end as n_proposals from events)"


@query("latest_job_status", f"select job_id, max(updated) as updated, arg_max(status, updated) filter (status is not null) as status, arg_max(msg, updated) filter (msg is not null) as msg, arg_max(n_proposals, updated) filter (n_proposals is not null) as n_proposals from {_LOG} x group by job_id")
def _(v):
    return j.latest_job_status(v.sql(f"select * from {_LOG} x"))


@query("latest_coordinate_fix", """
with x as (select *, try_cast(regexp_extract(comment, '(-?\\d{2}\\.\\d{3,})\\s*[,;]\\s*(-?\\d{1,3}\\.\\d{3,})', 1) as double) as la, try_cast(regexp_extract(comment, '(-?\\d{2}\\.\\d{3,})\\s*[,;]\\s*(-?\\d{1,3}\\.\\d{3,})', 2) as double) as lo from fx_corrections where comment <> '' and verdict <> 'correct')
select marker_key, max(ord) as ord, arg_max(round(la, 6), ord) as lat, arg_max(round(lo, 6), ord) as lon from x where la between 35 and 82 and lo between 19 and 180 group by marker_key""")
def _(v):
    return j.latest_coordinate_fix(v.corrections).select("marker_key", "ord", "lat", "lon")


_CHUNK = "(select path, idx as done_upto, idx % 9 = 0 as complete, cast(400 as bigint) as total from fx_doc_pages)"


@query("resumable_progress", f"select path, max(done_upto) as done_upto, bool_or(complete) as complete, cast(case when bool_or(complete) then 0 else greatest(400 - max(done_upto), 0) end as bigint) as pages_left, case when bool_or(complete) then 'done' else 'queued' end as status from {_CHUNK} x group by path")
def _(v):
    return j.resumable_progress(v.sql(f"select * from {_CHUNK} x"))


# ------------------------------------------------------------------ queue
_IDX = f"""(select s.job_id as id, filename as name, status, coalesce(n, 0) as n, coalesce(geo, 0) as geo, case when n is null then 0 else coalesce(chk, 0) end as checked, submitter as src, created, msg
 from fx_status s left join (select job_id, count(*) as n, count(lat) as geo from fx_proposals group by 1) p using (job_id) left join (select job_id, count(*) as chk from {_LAST} x group by 1) e using (job_id))"""


def _index(v):
    return j.queue_index(v.status, v.proposals, v.decisions)


@query("queue_index", f"select * from {_IDX} x")
def _(v):
    return _index(v)


@query("queue_filter", f"select id from {_IDX} x where contains(lower(name), 'customer#00000') and status in ('ready', 'queued') and n > 0 and geo > 0 and n > checked")
def _(v):
    return j.queue_filter(_index(v), "Customer#00000", ["ready", "queued"], True, True, True).select("id")


@query("queue_order", f"select id, row_number() over (order by checked >= n and n > 0, n desc, geo desc, id) as pos from {_IDX} x")
def _(v):
    q = _index(v).withColumn("done", (F.col("checked") >= F.col("n")) & (F.col("n") > 0))
    return tools.ordinal(q, [], ["done", F.desc("n"), F.desc("geo"), "id"], "pos", start=1).select("id", "pos")


@query("queue_page", f"select id, n from {_IDX} x order by n desc, id limit 25 offset 50")
def _(v):
    return j.queue_page(_index(v), "n", 50, 25)[0].select("id", "n")


@query("recent_jobs", "select job_id, created from fx_status order by created desc, job_id limit 50")
def _(v):
    return j.recent_jobs(v.status).select("job_id", "created")


@query("queue_outcome", f"select status, count(*) as jobs, count(*) filter (n > 0) as with_proposals, cast(sum(n) as bigint) as proposals from {_IDX} x group by status")
def _(v):
    return j.queue_outcome(_index(v))


@query("select_queue_jobs", "select job_id from fx_status where status in ('queued', 'error') and job_id not in (select job_id from fx_decisions)")
def _(v):
    return j.select_queue_jobs(v.status, v.decisions, ["queued", "error"]).select("job_id")


@query("pending_no_coord", "select job_id, i from fx_proposals where lat is null and locality not in ('', 'ND', 'не указано')")
def _(v):
    return _big(j.pending_no_coord(v.proposals).select("job_id", "i"))


# ------------------------------------------------------------------ proposals
@query("job_bundle_join", f"select p.job_id, p.i, locality, verdict, filename from fx_proposals p join {_LAST} x on x.job_id = p.job_id and x.i = p.i left join fx_status s on s.job_id = p.job_id")
def _(v):
    return _big(j.job_bundle_join(v.proposals, v.decisions, v.status).select("job_id", "i", "locality", "verdict", "filename"))


_LEDGER = "(select job_id, i from fx_proposals where admin = 'ND')"


@query("accepted_with_coords", f"select p.job_id, p.i, lat is not null as located from fx_proposals p join {_LAST} x on x.job_id = p.job_id and x.i = p.i where verdict = 'accept' and not exists (select 1 from {_LEDGER} l where l.job_id = p.job_id and l.i = p.i)")
def _(v):
    ok, skipped = j.accepted_with_coords(v.proposals, v.decisions, v.sql(f"select * from {_LEDGER} l"))
    return _big(ok.unionByName(skipped).select("job_id", "i", F.col("lat").isNotNull().alias("located")))


def _full_proposals(v):
    arr = lambda x: F.array(F.lit(x))
    return v.proposals.select("job_id", F.col("i").cast("int").alias("i"), "locality", "admin", arr("pit").alias("excavation"), arr("ND").alias("geomorph"),
                              arr("loess").alias("deposits"), arr("лёсс").alias("raw_terms"), F.array("thickness").alias("thickness"), "elevation",
                              arr("Holocene").alias("strat"), arr("OSL").alias("dating"), arr("prose").alias("source_kinds"),
                              F.array("locality", "elevation").alias("evidence"), F.lit(1).alias("n_records"), "lat", "lon")


@query("append_accepted", f"""
select nearest_locality, administrative_unit, thickness_studied, elevation_min_m, sources, evidence, lat from fx_sections
union all select locality, admin, cast(regexp_extract(thickness, '(\\d+)', 1) as varchar), split_part(elevation, '-', 1), filename || '{vocab.UPLOAD_MARK}', locality || ' || ' || elevation, lat from fx_proposals join fx_status using (job_id) where lat is not null""")
def _(v):
    master = v.sections.select(*vocab.MASTER_COLUMNS)
    out = j.append_accepted(master, j.master_rows(_full_proposals(v).filter("lat is not null"), v.status))
    return out.select("nearest_locality", "administrative_unit", "thickness_studied", "elevation_min_m", "sources", "evidence", "lat")


@query("ledger_anti", f"select job_id, i from fx_proposals where admin <> 'ND'")
def _(v):
    return _big(j.ledger_anti(v.proposals, v.sql(f"select * from {_LEDGER} l"), ["job_id", "i"]).select("job_id", "i"))


_PREC = """(select doc_no, ord, nearest_locality as loc, administrative_unit as adm, geomorphic_position as geo, thickness_studied as th, evidence_locality as e1, evidence_deposit as e2, evidence_geomorph as e3, type_of_deposits as dep from fx_raw_records where nearest_locality not in ('ND', ''))"""


def _proposal_records(v):
    nd = lambda x: F.when(~F.col(x).isin("ND", ""), F.col(x))
    th = tools.one_or_none(F.concat(F.lit("studied: "), nd("thickness_studied"), F.lit(" м")))
    return v.raw_records.select(
        F.col("doc_no").cast("string").alias("job_id"), "ord", F.col("nearest_locality").alias("locality"), nd("administrative_unit").alias("admin"),
        nd("absolute_elevation_m").alias("elevation"), F.array("excavation_type").alias("excavation"), F.array("geomorphic_position").alias("geomorph"),
        t.split_tags("type_of_deposits").alias("deposits"), t.split_tags("deposit_raw_terms").alias("raw_terms"), th.alias("thickness"),
        t.split_tags("stratigraphic_position").alias("strat"), t.split_tags("dating_methods").alias("dating"), F.array("source_kind").alias("source_kinds"),
        F.array("evidence_locality", "evidence_deposit", "evidence_geomorph").alias("quotes"))


def _ouniq(e, cap=None):
    cut = f"[1:{cap}]" if cap else ""
    return f"coalesce(array_to_string(list_filter({e}, lambda z, i: list_position({e}, z) = i){cut}, '|'), '')"


def _placed(e):
    """List of an aggregate with the place of each value: its row's position, then its place in the row."""
    return f"flatten(list(list_transform({e}, lambda z, i: {{'o': ord, 'i': i, 'v': z}})))"


def _in_order(c, sep="|"):
    """Distinct known values of such a list by first place, joined."""
    v = f"list_filter(list_transform(list_sort({c}), lambda z: z.v), lambda z: z is not null and z not in ('', 'ND', '[]'))"
    return f"coalesce(array_to_string(list_filter({v}, lambda z, i: list_position({v}, z) = i), {d.q(sep)}), '')"


_PLISTS = {"excavation": "[excavation_type]", "geomorph": "[geomorphic_position]", "deposits": d.split_tags("type_of_deposits"), "raw_terms": d.split_tags("deposit_raw_terms"),
           "thickness": "case when thickness_studied in ('ND', '') then [] else ['studied: ' || thickness_studied || ' м'] end", "strat": d.split_tags("stratigraphic_position"),
           "dating": d.split_tags("dating_methods"), "source_kinds": "[source_kind]", "evidence": "[trim(evidence_locality), trim(evidence_deposit), trim(evidence_geomorph)]"}


@query("build_proposals", f"""
with gg as (select cast(doc_no as varchar) as job_id, {d.strip('nearest_locality')} as locality, count(*) as n_records, min(ord) as fst,
  first(administrative_unit order by ord, administrative_unit) filter (administrative_unit not in ('ND', '')) as admin, first(absolute_elevation_m order by ord, absolute_elevation_m) filter (absolute_elevation_m not in ('ND', '')) as elevation,
  {', '.join(f"{_placed(e)} as {c}" for c, e in _PLISTS.items())} from fx_raw_records where {d.strip('nearest_locality')} not in ('ND', '') group by 1, 2)
select job_id, row_number() over (partition by job_id order by n_records desc, fst, locality) - 1 as i, locality, n_records, coalesce(admin, 'ND') as admin, coalesce(elevation, 'ND') as elevation,
  {', '.join(f"{_in_order(c)} as {c}" for c in _PLISTS)} from gg""")
def _(v):
    b = j.build_proposals(_proposal_records(v))
    return b.select("job_id", "i", "locality", "n_records", "admin", "elevation", *[F.array_join(c, "|").alias(c) for c in _PLISTS])


_EV = f"list_filter(list_transform(ev, lambda z: {d.strip('z')}), lambda z: z is not null and z not in ('', '[]', 'ND'))"


@query("proposals_to_master", f"""
with gg as (select cast(doc_no as varchar) as job_id, {d.strip('loc')} as name, count(*) as n_records, coalesce(first(adm order by ord, adm) filter (adm <> 'ND'), '') as admin, list_transform(list_sort(flatten(list([{{'o': ord, 'i': 0, 'v': e1}}, {{'o': ord, 'i': 1, 'v': e2}}, {{'o': ord, 'i': 2, 'v': e3}}]))), lambda z: z.v) as ev from {_PREC} x group by 1, 2)
select g.name as nearest_locality, case when g.admin = '' then 'ND' else g.admin end as administrative_unit, n_records, 'том ' || job_id || '.pdf{vocab.UPLOAD_MARK}' as sources,
 array_to_string(list_filter({_EV}, lambda z, i: list_position({_EV}, z) = i), ' || ') as evidence, coalesce(f.hlat, b.hlat) as lat, coalesce(f.hlon, b.hlon) as lon
from gg g left join {best_hit_sql('name, admin')} f on g.name = f.name and g.admin = f.admin left join {best_hit_sql('name')} b on g.name = b.name where coalesce(f.hlat, b.hlat) is not null""")
def _(v):
    """Records of jobs → proposals → coordinates → rows of the master table, with all their quotes."""
    found = j.build_proposals(_proposal_records(v)).withColumn("name", F.col("locality")).withColumn("admin", F.when(F.col("admin") == "ND", "").otherwise(F.col("admin")))
    placed = geo_places.geocode_with_fallback(found, v.gazetteer).withColumn("lat", F.col("found.lat")).withColumn("lon", F.col("found.lon"))
    decided = placed.select("job_id", "i", F.lit("accept").alias("verdict"), F.lit("u").alias("reviewer"), F.lit(1).alias("ts"))
    ready, _waiting = j.accepted_with_coords(placed.withColumn("admin", F.when(F.col("admin") == "", "ND").otherwise(F.col("admin"))), decided, decided.limit(0))
    status = placed.select("job_id", F.concat(F.lit("том "), "job_id", F.lit(".pdf")).alias("filename")).distinct()
    return j.master_rows(ready, status).select("nearest_locality", "administrative_unit", "n_records", "sources", "evidence", "lat", "lon")


@query("incremental_enrich", """
with pts as (select distinct round(lat, 5) as lat, round(lon, 5) as lon from fx_sections where lat is not null), prev as (select distinct round(lat, 5) as lat, round(lon, 5) as lon, 1.0::double as v from fx_gazetteer)
select * from prev union all select lat, lon, lat + lon from pts where not exists (select 1 from prev where prev.lat = pts.lat and prev.lon = pts.lon)""")
def _(v):
    prev = v.gazetteer.select(F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), F.lit(1.0).alias("v")).distinct()
    return j.incremental_enrich(v.sections.filter("lat is not null"), prev, lambda x: x.withColumn("v", F.col("lat") + F.col("lon")))


@query("idempotent_merge", """
with old as (select nearest_locality, lat, lon from fx_sections where lat is not null), n as (select job_id, i, round(lat, 5) as lat, round(lon, 5) as lon, lower(locality) as nm from fx_proposals where lat is not null and admin <> 'ND'),
 a as (select job_id, i, arg_min({'a': o.lat, 'b': o.lon}, {'d': PL}) as z from n join old o on lower(o.nearest_locality) = n.nm and PL < 300 group by 1, 2), b as (select job_id, i, arg_min({'a': o.lat, 'b': o.lon}, {'d': PL}) as z from n join old o on o.lat between n.lat - 0.01 and n.lat + 0.01 and PL < 150 group by 1, 2)
select n.job_id, n.i, coalesce(a.z.a, b.z.a, n.lat) as lat, coalesce(a.z.b, b.z.b, n.lon) as lon from n left join a using (job_id, i) left join b using (job_id, i)""".replace("PL", d.planar("n.lat", "n.lon", "o.lat", "o.lon")))
def _(v):
    master = v.sections.withColumn("job_id", F.lit(None).cast("string")).withColumn("i", F.lit(None).cast("int"))
    return _big(j.idempotent_merge(_full_proposals(v).filter("lat is not null"), v.sql(f"select * from {_LEDGER} l"), master).select("job_id", "i", "lat", "lon"))


# ------------------------------------------------------------------ corrections
_FIX_SRC = "(select distinct lat, lon from fx_gazetteer)"
_FIXD = f"(select replace({d.marker_key('lat', 'lon')}, ',', '') as marker_key, lat + 1 as lat, lon from {_FIX_SRC} x)"


@query("correction_apply_join", f"select ord, coalesce(f.lat, s.lat) as lat, s.lon, case when f.lat is not null then 'ok' else loc_confidence end as loc_confidence from fx_sections s left join {_FIXD} f on replace({d.marker_key('s.lat', 's.lon')}, ',', '') = f.marker_key")
def _(v):
    fixes = v.sql(f"select * from {_FIX_SRC} x").select(g.storage_key(g.marker_key(F.col("lat"), F.col("lon"))).alias("marker_key"), (F.col("lat") + 1).alias("lat"), "lon")
    return j.correction_apply_join(v.sections, fixes)[0].select("ord", "lat", "lon", "loc_confidence")


def _corr_on_markers(v):
    s = v.sections.filter("lat is not null").select("ord", g.storage_key(g.marker_key(F.col("lat"), F.col("lon"))).alias("marker_key"))
    return v.corrections.drop("marker_key").join(s, "ord")


_CM = f"(select c.ord, c.verdict, c.comment, c.reviewer, replace({d.marker_key('s.lat', 's.lon')}, ',', '') as marker_key from fx_corrections c join fx_sections s on s.ord = c.ord where s.lat is not null)"


@query("apply_fix_log", f"""
with x as (select *, try_cast(regexp_extract(comment, '(-?\\d{{2}}\\.\\d{{3,}})\\s*[,;]\\s*(-?\\d{{1,3}}\\.\\d{{3,}})', 1) as double) as la, try_cast(regexp_extract(comment, '(-?\\d{{2}}\\.\\d{{3,}})\\s*[,;]\\s*(-?\\d{{1,3}}\\.\\d{{3,}})', 2) as double) as lo from {_CM} c where comment <> '' and verdict <> 'correct'),
f as (select marker_key, arg_max(round(la, 6), ord) as la, arg_max(round(lo, 6), ord) as lo from x where la between 35 and 82 and lo between 19 and 180 group by 1)
select marker_key, first(nearest_locality order by s.ord) as locality, {d.marker_key('any_value(la)', 'any_value(lo)')} as "to" from f join fx_sections s on replace({d.marker_key('s.lat', 's.lon')}, ',', '') = f.marker_key group by 1""")
def _(v):
    ledger = v.sql("select 'none' as marker_key")
    return j.apply_fix_log(_corr_on_markers(v), ledger, v.sections)[1].select("marker_key", "locality", "to")


# all markers, those of every third customer no longer where they were
_LIVE = "(select concat(lat_text, lon_text, case when ord % 3 = 0 then '5' else '' end) as marker_key from fx_marker_points)"


@query("orphan_corrections", f"select ord, marker_key from fx_corrections where reviewer <> 'система' and marker_key not in (select marker_key from {_LIVE} l)")
def _(v):
    return j.orphan_corrections(v.corrections, v.sql(f"select * from {_LIVE} l")).select("ord", "marker_key")


_MP = "(select name, cast(lat_text as double) as lat, cast(lon_text as double) + 0.02 as lon, concat('x', name) as marker from fx_marker_points)"

@query("orphan_resolve", f"""
with o as (select distinct marker_key from fx_corrections where reviewer <> 'система'), m as {_MP}, led as (select marker_key, max('x' || name) as a from (select marker_key, min(ord) as k from fx_corrections where reviewer <> 'система' and verdict = 'correct' group by 1) q join m on m.name = 'Customer#' || lpad(cast(k % 1500 as varchar), 9, '0') group by 1),
 nm as (select marker_key, min(marker) as b from (select distinct c.marker_key, m.marker from fx_corrections c join m on c.reviewer <> 'система' and regexp_extract(c.comment, 'Customer#\\d{{9}}') = m.name) group by 1 having count(*) = 1),
 cuts as (select marker_key, p.a as la, p.b as lo from (select marker_key, unnest(list_filter(list_transform(generate_series(2, length(marker_key) - 3), lambda c: {{'a': case when regexp_matches(left(marker_key, c), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') then try_cast(left(marker_key, c) as double) end, 'b': case when regexp_matches(substring(marker_key, c + 1), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') then try_cast(substring(marker_key, c + 1) as double) end}}), lambda p: p.a between 35 and 82 and p.b between 19 and 180)) as p from o)),
 nr as (select marker_key, arg_min(marker, dd) as c from (select marker_key, marker, {d.planar('la', 'lo', 'lat', 'lon')} as dd from cuts join m on lat between la - 0.05 and la + 0.05) where dd < 5000 group by 1 having count(*) = 1 or min(dd) < 1000)
select o.marker_key, coalesce(a, b, c) as target, case when a is not null then 'ledger' when b is not null then 'named' when c is not null then 'nearest' end as why from o left join led using (marker_key) left join nm using (marker_key) left join nr using (marker_key)""")
def _(v):
    people = v.corrections.filter(F.col("reviewer") != vocab.SYSTEM_USER)
    moved = people.filter("verdict = 'correct'").groupBy("marker_key").agg(F.min("ord").alias("k")).select(
        "marker_key", F.concat(F.lit("xCustomer#"), F.lpad((F.col("k") % 1500).cast("string"), 9, "0")).alias("to"))
    return j.orphan_resolve(people, moved, v.sql(f"select * from {_MP} m"))


@query("append_corrections_dedup", "with cur as (select * from fx_corrections where verdict <> 'partial'), add as (select * from fx_corrections where verdict <> 'correct') select ord, marker_key from cur union all select ord, marker_key from add where verdict <> 'incorrect'")
def _(v):
    cc = v.corrections
    return j.append_corrections_dedup(cc.filter("verdict <> 'partial'"), cc.filter("verdict <> 'correct'")).select("ord", "marker_key")


@query("publish_guard", "select count(*) as new_markers, (select count(*) from customer) as old_markers, count(*) >= (select count(*) from customer) * 0.9 as publish from (select distinct lat, lon from fx_sections where lat is not null)")
def _(v):
    return j.publish_guard(v.sections.filter("lat is not null").select("lat", "lon").distinct(), v.table("customer"))


@query("scan_jobs", "select p.job_id, p.i, locality, lat from fx_proposals p")
def _(v):
    items = _full_proposals(v)
    rec = F.struct(*[x for x in items.columns if x != "job_id"])
    arr = F.transform(F.sort_array(F.collect_list(F.struct("i", rec.alias("r")))), lambda x: x["r"])
    whole = items.groupBy("job_id").agg(arr.alias("a"))
    value = F.when(F.length("job_id") % 2 == 0, F.to_json("a")).otherwise(F.to_json(F.struct(F.col("a").alias("proposals"))))
    rows = readers.proposal_rows(whole.select("job_id", value.alias("value")))
    return _big(rows.select("job_id", "i", "p.locality", "p.lat"))


@query("scan_corrections", "select marker_key, verdict, comment, ts from fx_corrections")
def _(v):
    entry = F.struct("verdict", "comment", F.col("reviewer").alias("user"), "ts")
    # entries of a marker may be many: files of one marker are written per reviewer
    texts = v.corrections.groupBy("marker_key", "reviewer").agg(F.to_json(F.collect_list(entry)).alias("value"))
    return readers.correction_rows(texts.select("marker_key", "value")).select("marker_key", "verdict", "comment", "ts")


# ------------------------------------------------------------------ sub-sites
_PASSES = 12  # enough for every chain in the tables: names halve at each step


def _placement_sql():
    ctes = ["p0 as materialized (select *, cast(null as varchar) as inherited_from from fx_subsites)"]
    for k in range(_PASSES):
        q = f"p{k}"
        ctes.append(f"""n{k} as materialized (select c.ord, c.offset_km, bp.ord is not null as byp, coalesce(bp.lat, ba.lat) as blat, coalesce(bp.lon, ba.lon) as blon, coalesce(bp.accuracy, ba.accuracy) as bacc, coalesce(bp.name, ba.name) as bname, bp.ord is null and ba.ord is not null and c.anchor <> c.parent and c.anchor <> '' as own, c.direction
  from {q} c left join {q} bp on bp.lat is not null and lower(bp.name) = lower(c.parent) left join {q} ba on ba.lat is not null and lower(ba.name) = lower(c.anchor) where c.lat is null and (bp.ord is not null or ba.ord is not null)),
 m{k} as materialized (select ord, bname, bacc, offset_km, case when own and offset_km <> 0 and direction = 'юг' then -1.0 when own and direction = 'юг' then -1.0 else 1.0 end as dy, case when own and direction = 'юг' then offset_km else 1.0 end as km, blat, blon from n{k}),
 p{k + 1} as materialized (select c.ord, c.job_id, c.name, c.relation, c.parent, c.anchor, c.offset_km, c.direction, c.why, coalesce(c.lat, round(blat + dy * km / 111.32, 5)) as lat, coalesce(c.lon, round(blon, 5)) as lon,
   coalesce(c.accuracy, case when m.ord is null then null when m.offset_km <> 0 then cast(1500 + km * 100 as bigint) else greatest(500, coalesce(bacc, 1500)) end) as accuracy, coalesce(c.inherited_from, bname) as inherited_from from {q} c left join m{k} m on m.ord = c.ord)""")
    return ",\n".join(ctes)


@query("hierarchy_placement", f"with {_placement_sql()} select ord, lat, lon, accuracy, inherited_from from p{_PASSES}")
def _(v):
    return h.hierarchy_placement(v.subsites).select("ord", "lat", "lon", "accuracy", "inherited_from")


def _root_sql():
    # own, up: names one step apart; the climb is unrolled
    steps = ["r0 as materialized (select ord, lower(name) as own, case when pk = lower(name) then '' else pk end as cur from lk)"]
    for k in range(1, _PASSES + 2):
        end = "true" if k > _PASSES else "up = '' or up = r.cur"
        steps.append(f"r{k} as materialized (select r.ord, own, case when l.is_sub then case when {end} then '' else up end else r.cur end as cur from r{k - 1} r left join lv l on l.nm = r.cur)")
    return f"""{_placement_sql()}, pl as (select * from p{_PASSES} where lat is not null), lk as materialized (select ord, name, lower(case when parent <> '' then parent else coalesce(inherited_from, '') end) as pk from pl),
 lv as materialized (select lower(l.name) as nm, arg_min(pk, l.ord) as up, bool_or(relation <> 'то же самое место') as is_sub from lk l join pl using (ord) group by 1), {', '.join(steps)}"""


@query("hierarchy_root", f"with {_root_sql()} select ord, replace(replace(cur, 'й', 'и'), 'ё', 'е') as root from r{_PASSES + 1}")
def _(v):
    return h.hierarchy_root(h.hierarchy_placement(v.subsites)).select("ord", "root")


# the table: one summary site and all placed sub-sites but independent ones
_SEC = "(select cast(0 as bigint) as o, 'Сводный разрез' as nearest_locality, 55.0::double as la, 44.0::double as lo union all select ord, name, lat, lon from pl where relation <> 'самостоятельный объект')"


def _links_sql(rest):
    at = "cast(round({}, 5) as varchar) || ',' || cast(round({}, 5) as varchar)"
    return f"""with {_root_sql()}, sec as materialized (select * from {_SEC} z), byname as (select replace(replace(lower(nearest_locality), 'й', 'и'), 'ё', 'е') as nm, min({{'o': o, 'm': {at.format('la', 'lo')}, 'loc': nearest_locality}}) as s from sec group by 1),
 j as (select pl.name, pl.lat, pl.lon, {at.format('pl.lat', 'pl.lon')} as spot, s, nm from r{_PASSES + 1} join pl using (ord) join byname on nm = replace(replace(cur, 'й', 'и'), 'ё', 'е') where cur <> '') {rest}"""


def _sec(v, sub):
    top = v.spark.range(1).select(F.lit(0).cast("long").alias("ord"), F.lit("Сводный разрез").alias("nearest_locality"), F.lit(55.0).alias("lat"), F.lit(44.0).alias("lon"))
    rows = sub.filter("lat is not null and relation <> 'самостоятельный объект'").select(F.col("ord").cast("long").alias("ord"), F.col("name").alias("nearest_locality"), "lat", "lon")
    return top.unionByName(rows)


@query("hierarchy_links", _links_sql("select spot as marker, s.loc as part_of from j where s.m <> spot"))
def _(v):
    sub = h.hierarchy_placement(v.subsites)
    return h.hierarchy_links(sub, _sec(v, sub))[1]


@query("hierarchy_links_includes", _links_sql("select distinct s.m as marker, name, spot as at from j where s.m <> spot and replace(replace(lower(name), 'й', 'и'), 'ё', 'е') <> nm and exists (select 1 from sec where lower(sec.nearest_locality) = lower(j.name) and round(la, 5) = round(j.lat, 5) and round(lo, 5) = round(j.lon, 5))"))
def _(v):
    sub = h.hierarchy_placement(v.subsites)
    return h.hierarchy_links(sub, _sec(v, sub))[0]


@query("existing_row_anti", "select s.ord from fx_subsites s where relation <> 'то же самое место' and not exists (select 1 from (select name as n, lat as la, lon as lo from fx_subsites where lat is not null and relation = 'часть другого объекта') h where lower(s.name) = lower(n) and round(s.lat, 5) = round(la, 5) and round(s.lon, 5) = round(lo, 5))")
def _(v):
    s = v.subsites
    return h.existing_row_anti(s, s.filter("lat is not null and relation = 'часть другого объекта'").withColumnRenamed("name", "nearest_locality")).select("ord")


_ANCH = "(select c_custkey as ord, concat('job', cast(c_nationkey as varchar(9))) as job_id, case when c_custkey % 5 < 3 then concat('Якорь ', cast(c_custkey % 40 as varchar(9))) else concat('Площадка ', cast(cast(floor(c_custkey / 2) as bigint) as varchar(9))) end as locality, 45 + cast(c_custkey as double) / cast(100 as double) as lat, 40.0 + cast(c_custkey % 10 as double) as lon from customer)"
# every fifth sub-site is anchored at a place of the gazetteer, which also has the names of some sub-sites
_SUBA = "(select s.ord, job_id, s.name, relation, case when s.ord % 3 = 0 then '' else parent end as parent, case when s.ord % 5 = 2 then z.name when s.ord % 3 = 0 and s.ord % 2 = 0 then '' when s.ord % 4 = 1 then concat('у села Якорь ', cast(s.ord % 40 as varchar(9))) else anchor end as anchor, offset_km, direction, why from fx_subsites s join fx_gazetteer z on z.rank = s.ord)"
_GAZA = "(select name, lat, lon, rank from fx_gazetteer union all select concat('Площадка ', cast(rank as varchar(9))), lat, lon, rank from fx_gazetteer)"


@query("anchor_resolve", f"""
with s as (select *, not regexp_matches(why, '(?i)вероятн|возможно') as usable from {_SUBA} z), a as (select job_id, lower(locality) as k, min({{'o': ord, 'la': lat, 'lo': lon}}) as fst from {_ANCH} y group by 1, 2),
 gz as (select name as anchor, min({{'o': rank, 'la': lat, 'lo': lon}}) as fst from {_GAZA} q group by 1), p1 as (select s.ord, a.fst from s join a on a.job_id = s.job_id and a.k = lower(s.parent) where usable and relation <> '{vocab.REL_FOREIGN}'),
 p2 as (select s.ord, min(a.fst) as fst from s join a on a.job_id = s.job_id and contains(lower(why), a.k) where usable and anchor = '' and parent = '' group by 1 having count(*) = 1),
 p3 as (select s.ord, min(a.fst) as fst from s join a on a.job_id = s.job_id and contains(lower(anchor), a.k) where usable and anchor <> '' group by 1),
 p4 as (select s.ord, gz.fst from s join gz using (anchor) where usable and anchor <> '' and not regexp_matches(anchor, {d.q('(?i)' + t.INTERNAL_LABEL)}))
select s.ord, coalesce(p1.fst.la, p2.fst.la, p3.fst.la, p4.fst.la) as base_lat, coalesce(p1.fst.lo, p2.fst.lo, p3.fst.lo, p4.fst.lo) as base_lon,
 case when p1.ord is not null then 'parent' when p2.ord is not null then 'reason' when p3.ord is not null then 'phrase' when p4.ord is not null then 'gazetteer' end as base_by from s left join p1 using (ord) left join p2 using (ord) left join p3 using (ord) left join p4 using (ord)""")
def _(v):
    sub, anchors, gaz = (v.sql(f"select * from {x} z") for x in (_SUBA, _ANCH, _GAZA))
    return h.anchor_resolve(sub, anchors, gaz).select("ord", "base_lat", "base_lon", "base_by")


# ------------------------------------------------------------------ crawl
def _rel_sql(title, abstract):
    n = d.norm_search(f"{title} || ' ' || {abstract}")

    def one(parts):
        return "(" + " and ".join(f"contains(n, {d.q(x)})" for x in parts) + ")"

    ws = {k: t.word_parts(getattr(vocab, k)) for k in ("TOPIC_NEG", "TOPIC_STRONG", "TOPIC_OLD", "TOPIC_WEAK")}
    any_ = lambda k: "(" + " or ".join(one(x) for x in ws[k]) + ")"
    weak = " + ".join(f"cast({one(x)} as int)" for x in ws["TOPIC_WEAK"])
    return n, f"case when {any_('TOPIC_NEG')} then false when {any_('TOPIC_STRONG')} then true when {any_('TOPIC_OLD')} then false else ({weak}) >= 3 end"


_ITEMS = f"""(select 'doc-' || cast(doc_id as varchar) as slug, case doc_id % 4 when 0 then 'Лёссы и погребенные почвы' when 1 then 'Конодонты девона' when 2 then 'Разрез, скважина, мощность аллювия' else 'Экономика' end as title, {d.strip(d.squash("regexp_replace(text, '<[^>]+>', ' ', 'g')"))} as abstract, doc_id from documents
 union all select 'x-' || cast(doc_id as varchar), 'Юрские отложения', 'т', doc_id from documents)"""
_N, _REL = _rel_sql("title", "abstract")


@query("topical_filter", f"select slug from (select slug, {_N} as n from {_ITEMS} i) where {_REL}")
def _(v):
    return c.topical_filter(c.listing_items(v.listing_html)).select("slug")


@query("min_article_length", "select doc_id from documents where length(text) > 800")
def _(v):
    return c.min_article_length(v.table("documents")).select("doc_id")


_PAGED = "(select concat('doc-', cast(doc_id as varchar(9))) as slug, concat('<meta name=\"citation_title\" content=\"T\"><div itemprop=\"articleBody\">', text) as html from documents)"
_BODY = d.strip(d.squash("regexp_replace('>' || text, '<[^>]+>', ' ', 'g')"))


@query("crawl_to_jobs", f"""
with k as (select slug, n, doc_id from (select slug, doc_id, {_N} as n from {_ITEMS} i) where {_REL}), b as (select slug, {_BODY} as body from k join documents using (doc_id) where slug = 'doc-' || cast(doc_id as varchar)),
w as (select 'cl-' || left(md5(slug), 12) as job_id, body from b where length(body) > 800 and 'cl-' || left(md5(slug), 12) not in (select 'cl-' || left(md5('doc-' || cast(doc_id as varchar)), 12) from labels)),
pg as (select job_id, i, substring(body, i * 5000 + 1, 5000) as part from w, generate_series(0, 100000) z(i) where i * 5000 < length(body))
select job_id, count(*) as n_pages, 'T.pdf' as filename from pg where length({d.strip('part')}) > 200 group by 1""")
def _(v):
    known = v.table("labels").select(t.stable_job_id(F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("job_id"))
    jobs, _pages = c.crawl_to_jobs(c.listing_items(v.listing_html), v.sql(f"select * from {_PAGED} p"), known)
    return jobs.select("job_id", F.col("n_pages").cast("bigint").alias("n_pages"), "filename")


_AT = "(list_sum(list_transform(ps[1:k], lambda x: length(x))) + (k - 1) * length(name))"


@query("snippets", f"""
with n as (select doc_id, text, regexp_extract(text, '([0-9A-Za-z_]{{5,}})', 1) as name from documents), p as (select *, string_split(lower(text), lower(name)) as ps from n where name <> '')
select doc_id, unnest(list_transform(generate_series(1, least(4, len(ps) - 1)), lambda k: substring(text, cast(greatest({_AT} - 420, 0) + 1 as bigint), cast(least({_AT}, 420) + 420 as bigint)))) as snippet from p""")
def _(v):
    docs = v.table("documents").withColumn("name", F.regexp_extract("text", r"(\w{5,})", 1))
    return c.snippets(docs).select("doc_id", F.explode("snippets").alias("snippet"))


# ------------------------------------------------------------------ streams
@query("stream_jobs", "select job_id, filename from fx_status where status = 'queued'")
def _(v):
    root = tools.scratch_path(v.spark, "queue")
    v.status.select("job_id", "filename", "status", "created").repartition(3).write.json(f"{root}/in")
    stream = st.stream_jobs(v.spark, f"{root}/in")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    st.run_once(stream, sink, f"{root}/ckpt")
    return v.spark.read.parquet(f"{root}/out").select("job_id", "filename")

