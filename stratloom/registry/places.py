"""Look-ups, hints, repair and nearest points."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..operators import places as p
from . import duck as d
from .core import query
from .scalars import _REG, _DIS, duck_name_variants, duck_river, duck_variants

S = d.SETTLE
_KEYED = "(select ord, nearest_locality as name, case when administrative_unit = 'ND' then '' else administrative_unit end as admin, sources, evidence, lat, lon from fx_sections)"


def _keyed(v):
    return v.sql(f"select * from {_KEYED} k")


def best_hit_sql(keys, cond=f"{S} and {d.BOUNDS}"):
    return (f"(select {keys}, arg_min(lat, rank) as hlat, arg_min(lon, rank) as hlon from fx_gazetteer "
            f"where {cond} group by {keys})")


def _inbox(rows):
    """Best hit per row of ``rows`` (rid, name, lat0..lon1)."""
    return (f"(select rid, arg_min(lat, rank) as hlat, arg_min(lon, rank) as hlon from (select rid, z.lat, z.lon, z.rank, z.class, z.type "
            f"from {rows} r join fx_gazetteer z on z.name = r.name and z.lat between lat0 and lat1 and z.lon between lon0 and lon1) where {S} group by rid)")


def _ll(df, *cols):
    return df.select(*cols, F.col("found.lat").alias("lat"), F.col("found.lon").alias("lon"))


@query("geocode_join", f"""
select ord, case when k.admin <> '' then f.hlat else b.hlat end as lat, case when k.admin <> '' then f.hlon else b.hlon end as lon from {_KEYED} k
left join {best_hit_sql('name, admin')} f on k.name = f.name and k.admin = f.admin left join {best_hit_sql('name')} b on k.name = b.name""")
def _(v):
    return _ll(p.geocode_join(_keyed(v).drop("lat", "lon"), v.gazetteer), "ord")


_HINT = "(select ord as rid, ord, name, lat, lon, " + ", ".join(f"{d.first_box('lower(sources)', vocab.REGIONS, c)} as {c}" for c in ("name", "lat0", "lat1", "lon0", "lon1")).replace(" as name", " as region") + f" from {_KEYED} k)"


@query("region_hint_join", f"select ord, region, lat0, lat1, lon0, lon1 from {_HINT} h")
def _(v):
    return p.region_hint_join(_keyed(v)).select("ord", "region", "box.*")


@query("in_bbox", f"""
select ord, lat between lat0 and lat1 and lon between lon0 and lon1 as inside, lat between lat0 - 0.15 and lat1 + 0.15 and lon between lon0 - 0.15 and lon1 + 0.15 as padded
from {_HINT} h where lat is not null and region is not null""")
def _(v):
    s = p.region_hint_join(_keyed(v)).filter("lat is not null and region is not null")
    lat, lon, box = F.col("lat"), F.col("lon"), F.col("box")
    return s.select("ord", g.in_bbox(lat, lon, box).alias("inside"), g.in_bbox(lat, lon, box, 0.15).alias("padded"))


@query("geocode_in_box_join", f"select ord, hlat as lat, hlon as lon from {_HINT} h left join {_inbox(_HINT)} x using (rid)")
def _(v):
    return _ll(p.geocode_in_box_join(p.region_hint_join(_keyed(v)).drop("lat", "lon"), v.gazetteer), "ord")


@query("homonym_region_fix", f"""
select ord, case when inside then 'kept' when hlat is not null then 'fixed' else 'dropped' end as outcome, case when inside then lat else hlat end as lat, case when inside then lon else hlon end as lon from
 (select *, coalesce(lat between lat0 and lat1 and lon between lon0 and lon1, true) as inside from {_HINT} h) left join {_inbox(_HINT)} x using (rid)""")
def _(v):
    return p.homonym_region_fix(_keyed(v), v.gazetteer).select("ord", "outcome", "lat", "lon")


_LAND = "(select ord as rid, ord, nearest_locality as name, lat, lon, " + ", ".join(
    f"{d.first_box('ctx', vocab.LANDFORMS, c)} as {c}" for c in ("name", "lat0", "lat1", "lon0", "lon1")).replace(" as name", " as landform") + \
    " from (select *, replace(lower(evidence || ' ' || geomorphic_position || ' ' || administrative_unit || ' ' || sources), 'ё', 'е') as ctx from fx_sections))"


@query("landform_hint_join", f"select ord, landform, lat0 from {_LAND} h")
def _(v):
    return p.landform_hint_join(v.sections, p.context_text(True)).select("ord", "landform", F.col("box.lat0").alias("lat0"))


_LADDER = f"""(select name, pos, variant from (select name, unnest(forms) as variant, generate_subscripts(forms, 1) as pos from (select name, {duck_name_variants('name')} as forms from (select distinct locality as name from fx_names)
  where not regexp_matches(name, '(?i)^\\s*\\d+[\\s,.]*км') and not regexp_matches(name, '(?i)^(скв|разрез)($|[^{d.WORD}])'))))"""
_NAMES = """(select i, job_id, case when i % 3 = 0 then locality || ' II' when i % 3 = 1 then 'с. ' || locality else locality end as locality, lat from fx_proposals)"""


@query("geocode_ladder", f"""
with fx_names as {_NAMES}, best as (select name, arg_min(variant, pos) as variant, arg_min(hlat, pos) as hlat, arg_min(hlon, pos) as hlon from (select l.name, pos, variant, hlat, hlon from {_LADDER} l join {best_hit_sql('name')} b on b.name = l.variant) group by name)
select job_id, i, hlat as lat, hlon as lon, case when variant is null then null when variant = locality then 'найдено по названию без уточнения' else 'найдено как «' || variant || '» — номер объекта отброшен' end as note
from fx_names left join best on best.name = locality""")
def _(v):
    names = v.sql(f"select * from {_NAMES} n").withColumnRenamed("locality", "name").drop("lat")
    return _ll(p.geocode_ladder(names, v.gazetteer), "job_id", F.col("i").cast("bigint").alias("i"), "note")


@query("geocode_with_fallback", f"""
select ord, coalesce(f.hlat, b.hlat) as lat, coalesce(f.hlon, b.hlon) as lon, case when f.hlat is null and b.hlat is not null and k.admin <> '' then 'по названию без уточнения' end as note from {_KEYED} k
left join {best_hit_sql('name, admin')} f on k.name = f.name and k.admin = f.admin left join {best_hit_sql('name')} b on k.name = b.name""")
def _(v):
    return _ll(p.geocode_with_fallback(_keyed(v).drop("lat", "lon"), v.gazetteer), "ord", "note")


_AMB = f"""(select a.name from (select name, round(lat, 1) as lat, round(lon, 1) as lon from fx_gazetteer where {S}) a
  join (select name, round(lat, 1) as lat, round(lon, 1) as lon from fx_gazetteer where {S}) b on a.name = b.name
  where a.lat between 41 and 82 and a.lon between 19 and 180 and b.lat between 41 and 82 and b.lon between 19 and 180 group by a.name having max({d.haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')}) > 150)"""


@query("ambiguous_names", f"select name from {_AMB} x")
def _(v):
    return p.ambiguous_names(v.gazetteer).select("name")


@query("location_confidence", f"select ord, case when lat is null then '' when admin <> '' then 'ok' when name in (select name from {_AMB} x) then 'uncertain' else 'ok' end as loc_confidence from {_KEYED} k")
def _(v):
    return p.location_confidence(_keyed(v), p.ambiguous_names(v.gazetteer)).select("ord", "loc_confidence")


@query("without_admin", "select ord from fx_sections where lat is not null and administrative_unit in ('', 'ND', 'None')")
def _(v):
    return p.without_admin(v.sections).select("ord")


_PROP = f"""(select ord, case when len(fs) = 1 then fs[1] when len(sa) = 1 then sa[1] when len(cf) = 1 then cf[1] end as admin,
  case when len(fs) = 1 or len(sa) = 1 then 'тот же источник' when len(cf) = 1 then 'единственный вариант в корпусе' end as why, len(cf) = 1 as strong from
 (select n.ord, coalesce(list(distinct k.a) filter (list_has_any(k.s, n.s) and regexp_matches(k.a, '(?i)(област|край|республик|обл\\.|governorate|region)')), []) as fs,
   coalesce(list(distinct k.a) filter (list_has_any(k.s, n.s)), []) as sa, coalesce(list(distinct k.a) filter (regexp_matches(k.a, '(?i)(област|край|республик|обл\\.|governorate|region)')), []) as cf
  from (select ord, lower(nearest_locality) as nk, {d.split_list('sources', '|')} as s from fx_sections where lat is not null and administrative_unit in ('', 'ND', 'None')) n
  left join (select lower(nearest_locality) as nk, administrative_unit as a, {d.split_list('sources', '|')} as s from fx_sections where administrative_unit not in ('', 'ND', 'None')) k on k.nk = n.nk group by n.ord))"""


@query("admin_propagation", f"select ord, admin, why, strong from {_PROP} x where admin is not null")
def _(v):
    return p.admin_propagation(v.sections)


_SHORT = f"regexp_replace(name, '(?i)^(восточн|западн|северн|южн|верхн|нижн|больш|мал|нов|стар|средн)[{d.WORD}]*\\s+', '')"


@query("homonym_plan_apply", f"""
with base as (select s.ord, s.loc_confidence, h.name, h.lat, h.lon, h.lat0, h.lat1, h.lon0, h.lon1, x.admin as hint, case when x.admin is not null and x.strong then 'admin' when not (h.lat between lat0 and lat1 and h.lon between lon0 and lon1) then 'bbox' when x.admin is not null then 'flag' end as plan
   from fx_sections s join {_LAND} h on h.ord = s.ord left join {_PROP} x on x.ord = s.ord where s.lat is not null and s.administrative_unit in ('', 'ND', 'None')),
 b1 as (select ord as rid, * from base where plan = 'bbox'), b2 as (select rid, {_SHORT} as name, lat0, lat1, lon0, lon1 from b1),
 res as (select b.*, case when plan = 'admin' then a.hlat when plan = 'bbox' then coalesce(x1.hlat, x2.hlat) end as nlat, case when plan = 'admin' then a.hlon when plan = 'bbox' then coalesce(x1.hlon, x2.hlon) end as nlon
   from base b left join {best_hit_sql('name, admin')} a on a.name = b.name and a.admin = b.hint left join {_inbox('b1')} x1 on x1.rid = b.ord left join {_inbox('b2')} x2 on x2.rid = b.ord where plan is not null),
 o as (select *, case when plan = 'flag' then 'flagged' when nlat is not null and {d.haversine('lat', 'lon', 'nlat', 'nlon')} > 50 then 'fixed' when nlat is not null then 'kept' when plan = 'bbox' then 'dropped' else 'flagged' end as outcome from res)
select ord, plan, outcome, case when outcome = 'fixed' then round(nlat, 5) when outcome <> 'dropped' then lat end as lat, case when outcome = 'fixed' then round(nlon, 5) when outcome <> 'dropped' then lon end as lon,
 case when outcome in ('flagged', 'dropped') then 'uncertain' else loc_confidence end as loc_confidence from o""")
def _(v):
    return p.homonym_plan_apply(v.sections, v.gazetteer)


_CTX = f"""(select ord as rid, ord, nearest_locality as name, administrative_unit, loc_confidence, lat, lon, {_REG} as region, {_DIS} as dis from (select *, evidence || ' ' || geomorphic_position || ' ' || administrative_unit as e from fx_sections where lat is not null))"""
_BOX3 = "(select name, arg_min(lat0, rank) as lat0, arg_min(lat1, rank) as lat1, arg_min(lon0, rank) as lon0, arg_min(lon1, rank) as lon1 from fx_area_boxes group by name)"


@query("context_region_fix", f"""
with c as (select * from {_CTX} c where region is not null), r as (select c.*, b.lat0, b.lat1, b.lon0, b.lon1 from c left join {_BOX3} b on b.name = c.region),
 dd as (select c.rid, c.name, b.lat0, b.lat1, b.lon0, b.lon1 from c join {_BOX3} b on b.name = c.dis || ', ' || c.region),
 o as (select r.*, coalesce(x.hlat, y.hlat) as nlat, coalesce(x.hlon, y.hlon) as nlon, lat between lat0 - 0.15 and lat1 + 0.15 and lon between lon0 - 0.15 and lon1 + 0.15 as inside from r left join {_inbox('dd')} x using (rid) left join {_inbox('r')} y using (rid)),
 z as (select *, case when lat0 is null then 'no_box' when inside then 'ok' when nlat is not null then 'fixed' else 'dropped' end as outcome from o)
select ord, region, outcome, case when outcome = 'fixed' and administrative_unit in ('', 'ND') then region else administrative_unit end as administrative_unit, case when outcome = 'fixed' then round(nlat, 5) when outcome <> 'dropped' then lat end as lat,
 case when outcome = 'fixed' then round(nlon, 5) when outcome <> 'dropped' then lon end as lon, case when outcome = 'dropped' then 'uncertain' else loc_confidence end as loc_confidence from z""")
def _(v):
    return p.context_region_fix(v.sections, v.area_boxes, v.gazetteer)


_RIV = f"(select * from (select ord as rid, ord, nearest_locality as name, loc_confidence, lat, lon, {duck_river('e')} as river from (select *, evidence || ' ' || geomorphic_position || ' ' || administrative_unit as e from fx_sections where lat is not null)) where river is not null)"
_WAT = f"""(select river, arg_min(lat0, pos) as lat0, arg_min(lat1, pos) as lat1, arg_min(lon0, pos) as lon0, arg_min(lon1, pos) as lon1 from (select river, unnest(forms) as form, generate_subscripts(forms, 1) as pos from (select river, {duck_variants('river')} as forms from (select distinct river from rv)))
  join (select name, arg_min(lat0, rank) as lat0, arg_min(lat1, rank) as lat1, arg_min(lon0, rank) as lon0, arg_min(lon1, rank) as lon1 from fx_waterways where (class = 'waterway' or (class = 'natural' and type in ('water', 'stream'))) group by name) w on w.name = form group by river)"""


@query("river_basin_fix", f"""
with rv as {_RIV}, j as (select rv.*, lat0, lat1, lon0, lon1, greatest(lat1 - lat0, lon1 - lon0) > 6 as wide, lat between lat0 - 0.3 and lat1 + 0.3 and lon between lon0 - 0.3 and lon1 + 0.3 as inside from rv left join {_WAT} w using (river)),
 o as (select *, case when lat0 is null then 'no_box' when inside then 'ok' when not wide and hlat is not null and {d.planar('lat', 'lon', 'hlat', 'hlon')} > 50000 then 'fixed' else 'flagged' end as outcome from j left join {_inbox('j')} x using (rid))
select ord, river, outcome, case when outcome = 'fixed' then round(hlat, 5) else lat end as lat, case when outcome = 'fixed' then round(hlon, 5) else lon end as lon, case when outcome = 'flagged' then 'uncertain' else loc_confidence end as loc_confidence from o""")
def _(v):
    return p.river_basin_fix(v.sections, v.waterways, v.gazetteer)


@query("named_region_counts", f"select region, count(*) as n from {_CTX} c where region is not null group by region order by n desc, region limit 12")
def _(v):
    from ..functions.text import admin_from_text
    s = v.sections.filter("lat is not null").select(admin_from_text(p.context_text())["region"].alias("region")).filter("region is not null")
    return p.named_region_counts(s, "region")


@query("stage_audit", f"with c as (select * from {_CTX} c where region is not null) select case when lat0 is null then 'no_box' when lat between lat0 - 0.15 and lat1 + 0.15 and lon between lon0 - 0.15 and lon1 + 0.15 then 'ok' else 'outside' end as outcome, count(*) as n from c left join {_BOX3} b on b.name = c.region group by 1")
def _(v):
    out = p.context_region_fix(v.sections, v.area_boxes, v.gazetteer)
    return p.stage_audit(out.withColumn("outcome", F.when(F.col("outcome").isin("fixed", "dropped"), "outside").otherwise(F.col("outcome"))))


# ------------------------------------------------------------------ points
@query("snap_to_existing", f"""
with n as (select * from fx_new_points), a as (select n.ord, arg_min(e.lat, {{'d': {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')}, 'o': e.ord}}) as la, arg_min(e.lon, {{'d': {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')}, 'o': e.ord}}) as lo from n join fx_existing_points e on lower(n.name) = lower(e.name) and {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')} < 300 group by n.ord),
 b as (select n.ord, arg_min(e.lat, {{'d': {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')}, 'o': e.ord}}) as la, arg_min(e.lon, {{'d': {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')}, 'o': e.ord}}) as lo from n join fx_existing_points e on {d.planar('n.lat', 'n.lon', 'e.lat', 'e.lon')} < 150 group by n.ord)
select n.ord, a.la is not null or b.la is not null as snapped, coalesce(a.la, b.la, n.lat) as lat, coalesce(a.lo, b.lo, n.lon) as lon from n left join a using (ord) left join b using (ord)""")
def _(v):
    return p.snap_to_existing(v.new_points, v.existing_points).select("ord", "snapped", "lat", "lon")


# groups of dense points lie farther apart than 300 m, so each is walked by itself, in order
@query("too_close_anti", f"""
with recursive pts as (select cluster, ord, lat, lon, row_number() over (partition by cluster order by ord) as i from fx_dense_points x
   where not exists (select 1 from fx_existing_points e where abs(e.lat - x.lat) < 0.01 and {d.planar('x.lat', 'x.lon', 'e.lat', 'e.lon')} < 300)),
 walk as (select distinct cluster, cast(0 as bigint) as i, cast([] as struct(a double, b double)[]) as kept, cast(null as bigint) as ord, cast(null as double) as lat, cast(null as double) as lon, false as ok from pts
  union all select q.cluster, q.i, case when q.ok then list_append(q.kept, {{'a': q.lat, 'b': q.lon}}) else q.kept end, q.ord, q.lat, q.lon, q.ok from
   (select p.cluster, p.i, w.kept, p.ord, p.lat, p.lon, len(list_filter(w.kept, lambda z: {d.planar('p.lat', 'p.lon', 'z.a', 'z.b')} < 300)) = 0 as ok from walk w join pts p on p.cluster = w.cluster and p.i = w.i + 1) q)
select ord, lat, lon from walk where ok""")
def _(v):
    return p.too_close_anti(v.dense_points, v.existing_points).select("ord", "lat", "lon")


@query("near_work_area", f"""
select i * 1000000 + cast(substring(job_id, 4) as bigint) as ord from fx_proposals p where lat is not null and (not exists (select 1 from (select job_id, lat, lon from fx_proposals where i = 0 and lat is not null) a where a.job_id = p.job_id)
  or exists (select 1 from (select job_id, lat, lon from fx_proposals where i = 0 and lat is not null) a where a.job_id = p.job_id and {d.planar('p.lat', 'p.lon', 'a.lat', 'a.lon', '111.32')} <= 150))""")
def _(v):
    pts = v.proposals.filter("lat is not null").withColumn("ord", F.col("i") * 1000000 + F.substring("job_id", 4, 20).cast("bigint"))
    return p.near_work_area(pts, v.proposals.filter("i = 0 and lat is not null")).select(F.col("ord").cast("bigint").alias("ord"))


_RADIUS = "case type " + " ".join(f"when '{k}' then {r}" for k, r in vocab.RADIUS_BY_TYPE.items()) + " else 5000 end"


@query("accuracy_radius_join", f"""
with n as (select distinct lat, lon from (select lat + cast(ord % 7 as double) / cast(200 as double) as lat, lon from fx_sections where lat is not null)), g as (select lat, lon, arg_min(type, rank) as type, min(rank) as rank from fx_gazetteer group by lat, lon)
select n.lat, n.lon, cast(coalesce(arg_min({_RADIUS}, {{'d': {d.planar('n.lat', 'n.lon', 'g.lat', 'g.lon')}, 'r': g.rank}}), 5000) as int) as radius_m from n left join g on true group by n.lat, n.lon""")
def _(v):
    pts = v.sql("select lat + cast(ord % 7 as double) / cast(200 as double) as lat, lon from fx_sections where lat is not null")
    return p.accuracy_radius_join(pts, v.gazetteer)


_GRID = "(select cast(floor(lat / 0.5) as bigint) as cy, cast(floor(lon / 0.5) as bigint) as cx, max(rank) as height from fx_gazetteer group by 1, 2)"


@query("dem_lookup_join", f"select lat, lon, height from (select distinct lat, lon, cast(floor(lat / 0.5) as bigint) as cy, cast(floor(lon / 0.5) as bigint) as cx from fx_sections where lat is not null) left join {_GRID} z using (cy, cx)")
def _(v):
    return p.dem_lookup_join(v.sections.filter("lat is not null"), v.sql(f"select * from {_GRID} z"), 0.5)


_SIDE = "(select round(lat, 5) as lat5, round(lon, 5) as lon5, cast(max(rank) as double) as v from fx_gazetteer group by 1, 2)"


@query("sidecar_join", f"select ord, v as elev_dem, coalesce(v, 5000.0) as accuracy from fx_sections left join {_SIDE} z on round(lat, 5) = lat5 and round(lon, 5) = lon5")
def _(v):
    side = v.sql(f"select * from {_SIDE} z")
    return p.sidecar_join(v.sections, side, side).select("ord", "elev_dem", "accuracy")

