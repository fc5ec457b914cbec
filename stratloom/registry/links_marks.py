"""Quotes and pages, scans, markers."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions.geo import marker_key
from ..functions.text import split_sources
from ..operators import links as k
from ..operators import markers as m
from ..operators import places
from ..operators import tools
from ..sources import readers, writers
from . import duck as d
from .core import query

_UNMARK = "regexp_replace(src, '(?i)\\s*\\(загружено пользователем\\)\\s*$', '')"
_NP = d.squash("lower(" + d.strip("regexp_replace({c}, '(?i)\\s*\\(загружено пользователем\\)\\s*$', '')") + ")")


def _npub(c):
    return _NP.replace("{c}", c)


# ------------------------------------------------------------------ publications and pages
# reports with short names, and volumes whose long names differ late
_PUBS = """(select distinct publication from (
  select concat('Отчёт ', cast(p_size as varchar(9)), case when p_partkey % 3 = 0 then ' доп' else '' end, case when p_partkey % 4 = 0 then '.djvu' else '.pdf' end) as publication from part
  union all select concat('Геологическое строение Поволжья, том ', cast(p_size as varchar(9)), case when p_partkey % 2 = 0 then ', вып. 1.pdf' else '.pdf' end) from part) pubs)"""
_SRCS = """(select src from fx_links union all
  select concat('Геологическое строение  Поволжья, том ', cast(p_size + p_partkey % 3 as varchar(9)), case p_partkey % 3 when 0 then '.djvu' when 1 then ', вып. 2.pdf' else ', вып. 1, с картой.pdf' end) from part)"""


@query("publication_lookup", f"""
with pubs as (select publication, publication as ord, {_npub('publication')} as k from {_PUBS} p),
s as (select src, n, regexp_replace(n, '\\.[^.]*$', '') as stem from (select distinct src, {_npub('src')} as n from {_SRCS} x)),
j as (select src, publication, ord, k = n as eq, length(n) as ln, regexp_replace(k, '\\.[^.]*$', '') as ks, stem, k,
  len(list_filter(range(1, 1 + least(length(k), length(stem))), lambda i: left(k, i) = left(stem, i))) as c from s, pubs),
r as (select *, case when eq then 1000 + ln when c >= 25 then c when starts_with(k, left(stem, 25)) then length(left(stem, 25)) when starts_with(stem, left(ks, 25)) then length(left(ks, 25)) end as score from j),
-- a short name counts from both sides; neighbours of 25 characters or more come first
b as (select *, max(score) over (partition by src) as best from r where score is not null)
select src, arg_min(publication, ord) as publication, (case when best >= 1000 then best - 1000 else best end)::int as common, count(distinct publication) > 1 as tied from b where score = best group by src, best""")
def _(v):
    pubs = v.sql(f"select * from {_PUBS} p").withColumn("ord", F.col("publication"))
    return k.publication_lookup(v.sql(f"select * from {_SRCS} x"), pubs)


def _evidence_sql(ev, pages):
    e = f"(select distinct publication, evidence, {d.norm_search('evidence')} as n from {ev})"
    p = f"(select *, list_distinct(string_split(txt, ' ')) as tw from (select publication, idx, ord, {d.norm_search('text')} as txt from {pages}))"
    frag = "array_to_string(string_split(n, ' ')[1:{w}], ' ')"
    ex = " ".join(f"when length({frag.format(w=w)}) >= 12 and contains(txt, {frag.format(w=w)}) then {s}" for s, w in ((2, 8), (3, 6), (4, 4)))
    return f"""
e as {e}, p as materialized {p}, x as (select publication, evidence, n, idx, ord, case when contains(txt, n) then 0 when contains(txt, left(n, 60)) then 1 {ex} end as stage from e join p using (publication) where length(n) >= 12),
exact as (select publication, evidence, min(stage) as stage, arg_min(idx, {{'s': stage, 'o': ord}}) + 1 as page, 'exact' as method from x where stage is not null group by publication, evidence),
r as (select *, list_distinct(list_filter(string_split(n, ' '), lambda w: length(w) >= 5)) as l5, list_distinct(list_filter(string_split(n, ' '), lambda w: length(w) >= 4)) as l4 from e where length(n) >= 12 and not exists (select 1 from exact z where z.publication = e.publication and z.evidence = e.evidence)),
q as (select publication, evidence, case when len(l5) >= 3 then l5 else l4 end as toks from r),
f as (select q.publication, evidence, idx, ord, len(toks) as n, len(list_intersect(toks, tw)) as sc from q join p using (publication) where len(toks) >= 3),
fuzzy as (select publication, evidence, 5 as stage, arg_min(idx, {{'s': -sc, 'o': ord}}) + 1 as page, 'fuzzy' as method from f where sc >= greatest(3, cast(floor(0.6 * n) as int)) group by publication, evidence),
linked as (select publication, evidence, page, method, ['whole', 'start60', 'words8', 'words6', 'words4', 'fuzzy'][stage + 1] as stage from (select * from exact union all select * from fuzzy))"""


@query("evidence_page_join", "with " + _evidence_sql("fx_evidence", "fx_pages") + " select publication, evidence, page, stage, method from linked")
def _(v):
    return k.evidence_page_join(v.evidence, v.pages)


# sections whose quotes are pieces of pages and whose sources are the pages' publications
_LSEC = """(select item_id as ord, cast(45 + item_id % 10 as double) as lat, cast(30 + item_id % 4 as double) as lon, evidence, 'EN.pdf | fr (загружено пользователем) | de' as sources from fx_evidence)"""
_LPAGES = "(select case lang when 'en' then 'en.pdf' else lang end as publication, doc_id as idx, doc_id as ord, text from documents)"


@query("page_links", "with fl as (select distinct " + d.marker_key("lat", "lon") + f""" as marker, unnest(srcs) as src, evs from (select lat, lon, {d.split_list('sources', '|')} as srcs, {d.split_list('evidence', '||')} as evs from {_LSEC} s)),
a as (select distinct marker, src, lower(regexp_replace(src, ' \\(загружено пользователем\\)$', '')) as publication, unnest(evs) as evidence from fl), lp as {_LPAGES}, """
       + _evidence_sql("a", "lp") + """,
h as (select marker, src, page, bool_and(method <> 'exact') as fz from a join linked using (publication, evidence) group by marker, src, page)
select marker, src, page, bool_and(fz) over (partition by marker, src) as approx from h""")
def _(v):
    return k.page_links(v.sql(f"select * from {_LSEC} s"), v.sql(f"select * from {_LPAGES} p"))


@query("link_order", "select marker, src, page, approx from fx_links")
def _(v):
    return k.link_order(v.links)


@query("merge_page_links", "with prev as (select * from fx_links where page > 20), new as (select * from fx_links where page <= 20) select * from prev union all select n.* from new n where not exists (select 1 from prev p where p.marker = n.marker and p.src = n.src)")
def _(v):
    links = v.links
    return k.merge_page_links(links.filter("page > 20"), links.filter("page <= 20"))


@query("scan_page_links", "select marker, src, page, bool_and(bool_and(approx)) over (partition by marker, src) as approx from fx_links group by marker, src, page")
def _(v):
    out = tools.scratch_path(v.spark, "links")
    writers.write_page_links(v.links, out)
    return readers.read_page_links(v.spark, out, whole=False)


@query("scan_scan_index", "select publication, page, scan_key from fx_scan_index")
def _(v):
    out = tools.scratch_path(v.spark, "index")
    pages = v.scan_index.groupBy("publication").agg(F.map_from_entries(F.collect_list(F.struct(F.col("page").cast("string"), "scan_key"))).alias("m"))
    pages.select(F.to_json(F.create_map("publication", "m")).alias("value")).write.text(out)
    return readers.read_scan_index(v.spark, out, whole=False)


@query("scan_sidecar_map", "select distinct round(lat, 5) as lat5, round(lon, 5) as lon5, cast(rank as double) as v from fx_gazetteer")
def _(v):
    out = tools.scratch_path(v.spark, "sidecar")
    key = F.concat(F.col("lat").cast("string"), F.lit(","), F.col("lon").cast("string"))
    rows = v.gazetteer.select(F.to_json(F.create_map(key, F.col("rank"), F.lit("no,such,key"), F.lit(1).cast("bigint"))).alias("value"))
    rows.write.text(out)
    return readers.read_sidecar(v.spark, out, whole=False).distinct()


@query("scan_line_boxes", "select slug, page, n, text, x0, y1 from (select slug, cast(page as int) as page, cast(n as int) as n, text, cast(x0 as int) as x0, cast(y1 as int) as y1 from fx_scan_lines)")
def _(v):
    # one file per page in folders slug=…/page=…; the reader takes lines from the nested arrays
    out = tools.scratch_path(v.spark, "boxes")
    line = F.array("text", *[F.col(c).cast("string") for c in ("x0", "y0", "x1", "y1")])
    pages = v.scan_lines.groupBy("slug", "page", "w", "h").agg(F.sort_array(F.collect_list(F.struct("n", line.alias("l")))).alias("z"))
    pages.select(F.to_json(F.struct("w", "h", F.transform("z", lambda x: x["l"]).alias("lines"))).alias("value"), "slug", "page").write.json(out)
    boxes = v.spark.read.schema("value string, slug string, page int").json(out)
    from ..schemas import LINE_BOXES
    parsed = F.from_json("value", LINE_BOXES.replace(", _corrupt_record string", ""))
    lines = readers.line_rows(boxes.select("slug", "page", parsed["w"].alias("w"), parsed["h"].alias("h"), parsed["lines"].alias("lines")))
    return lines.select("slug", "page", "n", "text", "x0", "y1")


# ------------------------------------------------------------------ scans
@query("needed_pages", f"select distinct publication, page from (select {_UNMARK} as publication, unnest([page - 1, page, page + 1]) as page from fx_links) where page >= 1")
def _(v):
    return k.needed_pages(v.links)


@query("scan_availability_join", f"select marker, src, l.page, approx, regexp_replace(regexp_replace(publication, '\\.[^.]*$', ''), '[^0-9A-Za-zА-Яа-яЁё]+', '_', 'g') || '_' || substring(md5(publication), 1, 6) as slug from (select *, {_UNMARK} as publication from fx_links) l join (select distinct publication, page from fx_scan_index) i using (publication, page)")
def _(v):
    return k.scan_availability_join(v.links, v.scan_index).drop("publication")


@query("missing_scans_anti", f"select distinct {_UNMARK} as publication, page from fx_links where {_UNMARK} not in (select publication from fx_scan_index)")
def _(v):
    return k.missing_scans_anti(v.links, v.scan_index)


_PATHS = "(select path, row_number as ord from (select concat('/a', cast(p_size as varchar(9)), '/Customer#', lpad(cast(p_partkey as varchar(9)), 9, '0'), '.pdf') as path, p_partkey as row_number from part))"


@query("source_path_join", f"select filename as publication, coalesce(arg_min(path, ord), max(case when status = 'ready' then 'uploads/' || job_id || '/source.pdf' end)) as object from fx_status left join {_PATHS} p on split_part(path, '/', -1) = filename group by filename")
def _(v):
    need = v.status.select(F.col("filename").alias("publication")).distinct()
    return k.source_path_join(need, v.sql(f"select * from {_PATHS} p"), v.status).select("publication", "object")


@query("photo_page_number", """
select path, row_number() over (partition by regexp_replace(path, '/[^/]*$', '') order by list_transform(regexp_extract_all(split_part(path, '/', -1), '\\d+|\\D+'), lambda t: case when regexp_matches(t, '^\\d') then lpad(cast(length(ltrim(t, '0')) as varchar), 10, '0') || ltrim(t, '0') else lower(t) end), split_part(path, '/', -1)) as page from fx_catalog""")
def _(v):
    return k.photo_page_number(v.catalog).select("path", "page")


_ROT = """(select slug, page, case when mh > mw * 1.5 then case when top > bot then 90 else -90 end when top > bot + h * 0.3 then 180 end as angle from (select slug, page, h, median(x1 - x0) as mw, median(y1 - y0) as mh, median(y0) filter (n < edge) as top, median(y0) filter (n >= cnt - edge) as bot
  from (select *, greatest(3, cnt // 5) as edge from (select *, count(*) over (partition by slug, page) as cnt from fx_scan_lines)) where cnt >= 10 group by slug, page, h))"""


@query("page_rotation", f"select slug, page, cast(angle as int) as angle from {_ROT} r")
def _(v):
    return k.page_rotation(v.scan_lines)


@query("rotated_publications", f"with r as {_ROT}, tot as (select slug, count(*) as total from (select distinct slug, page from fx_scan_lines) group by slug), a as (select slug, angle, count(*) as n from r where angle is not null group by slug, angle) select slug, total, cast(sum(n) as bigint) as turned, cast(arg_min(angle, {{'m': -n, 'a': angle}}) as int) as angle from a join tot using (slug) group by slug, total having total >= 3 and sum(n) / total >= 0.6")
def _(v):
    lines = v.scan_lines
    return k.rotated_publications(k.page_rotation(lines), lines.select("slug", "page").distinct())


@query("caption_filter", "select slug, page from fx_scan_lines group by slug, page having regexp_matches(string_agg(text, ' ' order by n), 'строение разреза')")
def _(v):
    return k.caption_filter(v.scan_lines)


@query("budget_limit", "with g as (select slug, count(*) as size from (select distinct slug, page from fx_scan_lines) group by slug), l as (select slug, 500 - coalesce(sum(size) over (order by size desc, slug rows between unbounded preceding and 1 preceding), 0) as rest from g) select slug, page from (select slug, page, row_number() over (partition by slug order by page) as pos from (select distinct slug, page from fx_scan_lines)) join l using (slug) where pos <= rest")
def _(v):
    return k.budget_limit(v.scan_lines.select("slug", "page").distinct(), "slug", ["page"], 500).select("slug", "page")


_FIG = "(select concat('pub', cast(p_partkey % 10 as varchar(9))) as slug, p_size as page, concat('Колонка ', p_name) as section_name, p_type as units from part)"
_FLINK = "(select distinct concat('m', cast(l_suppkey as varchar(9))) as marker, concat('pub', cast(l_partkey % 10 as varchar(9))) as slug, cast(l_quantity as int) as page, cast(l_quantity as int) as pos from lineitem)"
_FMARK = "(select distinct concat('m', cast(l_suppkey as varchar(9))) as marker, p_name as locality from lineitem join part on l_partkey = p_partkey)"


@query("figure_column_join", f"""
with ok as (select l.marker, f.section_name, f.units, min({{'pos': l.pos, 'page': l.page}}) as fst from {_FLINK} l join {_FIG} f using (slug, page) where exists (select 1 from {_FMARK} k where k.marker = l.marker and length({d.norm_search('k.locality')}) >= 4 and (contains({d.norm_search('f.section_name')}, {d.norm_search('k.locality')}) or contains({d.norm_search('k.locality')}, {d.norm_search('f.section_name')}))) group by 1, 2, 3)
select marker, section_name, units, fst.page as page from (select *, row_number() over (partition by marker order by fst, section_name, units) as rn, 0 as c from ok)""")
def _(v):
    return k.figure_column_join(v.sql(f"select * from {_FMARK} x"), v.sql(f"select * from {_FLINK} x"), v.sql(f"select * from {_FIG} x"))


_LOCEV = "(select lower(name) as locality, concat('слой ', cast(rank % 7 as varchar(9))) as phrase, rank as n, rank % 5 = 0 as grounded from fx_gazetteer)"


@query("evidence_by_locality_join", f"""
with mk as (select {d.marker_key('lat', 'lon')} as marker, nearest_locality as locality, min(ord) as pos from fx_sections where lat is not null group by 1, 2), j as (select marker, phrase, grounded, pos, n from mk join {_LOCEV} e on lower(mk.locality) = e.locality),
u as (select marker, phrase, min({{'p': pos, 'n': n}}) as fst from j group by 1, 2), t3 as (select * from (select *, row_number() over (partition by marker order by fst, phrase) as rn from u))
select marker, g as grounded, p as phrases from (select marker, bool_or(grounded) as g from j group by 1) join (select marker, string_agg(phrase, '|' order by fst, phrase) as p from t3 group by 1) using (marker)""")
def _(v):
    mk = v.sections.filter("lat is not null").groupBy(marker_key(F.col("lat"), F.col("lon")).alias("marker"), F.col("nearest_locality").alias("locality")).agg(F.min("ord").alias("pos"))
    return k.evidence_by_locality_join(mk, v.sql(f"select * from {_LOCEV} e")).withColumn("phrases", F.array_join("phrases", "|"))


_PHR = "(select concat('pub', cast(p_partkey % 10 as varchar(9))) as slug, cast(p_partkey % 190 as bigint) as page, concat(p_name, ' ', p_type, ' строение разреза') as phrase from part)"


def _cov(a, b):
    return f"(len({a}) >= 2 and len(list_filter({a}, lambda w: list_contains({b}, w))) >= 2 and len(list_filter({a}, lambda w: list_contains({b}, w))) / len({a}) >= 0.6)"


@query("line_highlight_join", f"""
with a as (select slug, page, n, t, string_split(t, ' ') as ta, list_filter(string_split(t, ' '), lambda w: length(w) >= 4) as tl from (select slug, page, n, {d.norm_search('text')} as t from fx_scan_lines) where length(t) >= 4),
 b as (select distinct slug, page, q, string_split(q, ' ') as qa, list_filter(string_split(q, ' '), lambda w: length(w) >= 4) as ql from (select slug, page, {d.norm_search('phrase')} as q from {_PHR} p) where length(q) >= 12)
select distinct a.slug, a.page, a.n from a join b using (slug, page) where contains(t, q) or (length(t) >= 12 and contains(q, t)) or {_cov('ql', 'ta')} or {_cov('tl', 'qa')}""")
def _(v):
    return k.line_highlight_join(v.scan_lines, v.sql(f"select * from {_PHR} p")).select("slug", "page", F.col("n").cast("bigint").alias("n"))


# ------------------------------------------------------------------ archive
@query("scan_archive_catalog", "select path, size, split_part(path, '/', -1) as name, case when len(string_split(path, '/')) > 2 then split_part(path, '/', 2) else '(root)' end as top from fx_catalog")
def _(v):
    return readers.catalog_rows(v.catalog.select("path", "size"))


@query("catalog_rollup", """
with x as (select case when contains(split_part(path, '/', -1), '.') then '.' || lower(split_part(path, '.', -1)) else '(no ext)' end as ext, media_type, top, size from fx_catalog)
select dim as dimension, val as value, count(*) as files, cast(sum(size) as bigint) as bytes, round(sum(size) / 1e9, 2) as gb from (select unnest(['ext', 'media_type', 'top', 'total']) as dim, unnest([ext, media_type, top, null]) as val, size from x) group by 1, 2""")
def _(v):
    return k.catalog_rollup(v.catalog)


@query("manifest_drift", "select l.name from (select concat('f', cast(c_custkey as varchar)) as name, c_custkey * 10 as mtime, md5(c_name) as hash from customer) l join (select concat('f', cast(o_custkey as varchar)) as name, max(o_orderkey) as mtime, md5(case when max(o_orderkey) % 2 = 0 then 'x' else concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0')) end) as hash from orders group by o_custkey) r on l.name = r.name where r.mtime > l.mtime + 5 and r.hash <> l.hash")
def _(v):
    local = v.sql("select concat('f', cast(c_custkey as varchar(20))) as name, c_custkey * 10 as mtime, md5(c_name) as hash from customer")
    remote = v.sql("select concat('f', cast(o_custkey as varchar(20))) as name, max(o_orderkey) as mtime, md5(case when max(o_orderkey) % 2 = 0 then 'x' else concat('Customer#', lpad(cast(o_custkey as varchar(20)), 9, '0')) end) as hash from orders group by o_custkey")
    return k.manifest_drift(local, remote)


# ------------------------------------------------------------------ markers
def _records(v):
    return m.marker_records(v.sections)


_MK = d.marker_key("lat", "lon")


def _useen(c, cap=None):
    cut = f"[1:{cap}]" if cap else ""
    return f"list_filter({c}, lambda z, i: list_position({c}, z) = i){cut}"


def _nd_list(e):
    return f"case when len({e}) = 0 then ['ND'] else {e} end"


_TR = [d.range_lo_hi(f"thickness_{x}") for x in vocab.THICKNESS_KINDS]
_REC = f"""(select *, {_MK} as marker, list_min([{', '.join(a for a, _ in _TR)}]) as thmin, list_max([{', '.join(b for _, b in _TR)}]) as thmax, try_cast(elevation_min_m as double) as elmin, try_cast(elevation_max_m as double) as elmax,
  {d.split_list('evidence', '||')} as qs, {_nd_list(d.split_tags('type_of_deposits'))} as dep, {_nd_list(d.split_tags('excavation_type'))} as exc from fx_sections where lat is not null)"""
_B5 = "cast(cast(floor({v} / 5) * 5 as bigint) as varchar) || '–' || cast(cast(floor({v} / 5) * 5 as bigint) + 5 as varchar) || ' m'"
_B20 = "cast(cast(floor({v} / 20) * 20 as bigint) as varchar) || '–' || cast(cast(floor({v} / 20) * 20 as bigint) + 20 as varchar) || ' m'"
_MARK = f"""(select marker, round(min(lat), 6) as lat, count(*) as source_count, min(ord) as first_ord, first(nearest_locality order by ord) as title, min(thmin) as min_thickness, max(thmax) as max_thickness, min(elmin) as min_elevation, max(elmax) as max_elevation, max(n_sources) as nsrc,
  bool_or(loc_confidence = 'uncertain') as loc_uncertain, flatten(list(qs order by ord)) as qs, flatten(list(dep order by ord)) as dep, flatten(list(exc order by ord)) as exc, list(nearest_locality order by ord) as locs,
  list({_B5.format(v='coalesce(thmax, thmin)')} order by ord) filter (coalesce(thmax, thmin) is not null) as thb from {_REC} r group by marker)"""


@query("build_markers", f"""
select marker, lat, source_count, first_ord, title, min_thickness, max_thickness, min_elevation, max_elevation, loc_uncertain, array_to_string({_useen('qs')}, '|') as quotes, array_to_string({_useen('dep')}, '|') as deposit_type,
 array_to_string({_useen('exc')}, '|') as type_excavation, array_to_string({_useen('locs')}, '|') as localities, coalesce(array_to_string({_useen('thb')}, '|'), 'ND') as thickness_ranges, case when nsrc >= 2 then 'medium' else 'low' end as confidence,
 {_B20.format(v='((min_elevation + max_elevation) / 2)')} as representative_elevation_range from {_MARK} x""")
def _(v):
    b = m.build_markers(_records(v))
    j = lambda c: F.array_join(c, "|").alias(c)
    return b.select("marker", "lat", "source_count", "first_ord", "title", "min_thickness", "max_thickness", "min_elevation", "max_elevation", "loc_uncertain",
                    j("quotes"), j("deposit_type"), j("type_excavation"), j("localities"), j("thickness_ranges"), "confidence", "representative_elevation_range")


_MLINK = "(select ord, unnest(" + d.split_list("sources", "|") + ") as src, ord % 90 as page, lat, lon from fx_sections where lat is not null)"
_MFIG = "(select concat('Колонка ', p_name) as section_name, p_type as units, cast(p_size as bigint) as page, c_custkey as ord from part join customer on p_partkey = c_custkey)"


@query("marker_enriched", f"""
with h as (select round(lat, 5) as a, round(lon, 5) as b, cast(max(rank) as double) as v from fx_gazetteer group by 1, 2), l as (select {d.marker_key('lat', 'lon')} as marker, list_sort(list_distinct(list(src || ':' || cast(page as varchar)))) as ls from {_MLINK} z group by 1),
f as (select {d.marker_key('s.lat', 's.lon')} as marker, list_sort(list_distinct(list(section_name || ':' || units))) as fs from {_MFIG} g join fx_sections s on s.ord = g.ord where s.lat is not null group by 1)
select m.marker, m.source_count, max(h.v) as elev_dem, coalesce(array_to_string(any_value(ls), '|'), '') as links, coalesce(array_to_string(any_value(fs), '|'), '') as figures
from {_MARK} m left join fx_sections s on {d.marker_key('s.lat', 's.lon')} = m.marker left join h on h.a = round(s.lat, 5) and h.b = round(s.lon, 5) left join l on l.marker = m.marker left join f on f.marker = m.marker group by 1, 2""")
def _(v):
    rec = _records(v)
    dem = v.gazetteer.groupBy(F.round("lat", 5).alias("lat5"), F.round("lon", 5).alias("lon5")).agg(F.max("rank").cast("double").alias("v"))
    heights = places.sidecar_join(rec.select("marker", "lat", "lon").distinct(), dem, dem.limit(0)).select("marker", "elev_dem")
    links = v.sections.filter("lat is not null").select(marker_key(F.col("lat"), F.col("lon")).alias("marker"), F.explode(split_sources("sources")).alias("src"), (F.col("ord") % 90).alias("page"))
    figures = v.sql(f"select * from {_MFIG} g").join(rec.select("ord", "marker"), "ord")
    e = m.enrich_markers(m.build_markers(rec), heights, links, figures)
    text = lambda c, a, b: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda x: F.concat(x[a], F.lit(":"), x[b].cast("string"))))), "|")
    return e.select("marker", "source_count", "elev_dem", text("page_links", "src", "page").alias("links"), text("figures", "section_name", "units").alias("figures"))


@query("data_confidence", "select ord, case when n_records % 3 = 0 and n_sources >= 3 then 'high' when n_records % 3 = 0 or n_sources >= 2 or n_records > 7 then 'medium' else 'low' end as confidence from fx_sections")
def _(v):
    return v.sections.select("ord", m.data_confidence(F.col("n_records") % 3 == 0, F.col("n_sources"), F.col("n_records") > 7).alias("confidence"))


# radii of most coordinates; the others take the default
_ACC = "(select round(lat, 5) as lat5, round(lon, 5) as lon5, cast(min(ord) % 60 * 100 as double) as v from fx_sections where lat is not null group by 1, 2 having min(ord) % 4 > 0)"
_RADIUS = f"(select r.marker, max(coalesce(a.v, {float(vocab.DEFAULT_RADIUS)}::double)) as accuracy from {_REC} r left join {_ACC} a on round(r.lat, 5) = a.lat5 and round(r.lon, 5) = a.lon5 group by 1)"
_KINDS = f"(select {_MK} as marker, case count(*) % 3 when 0 then 'сводный разрез' when 1 then 'неясно' else 'особый вид' end as kind from fx_sections where lat is not null group by 1)"
_CANON = {k: c for k, c in m.FACETS.items() if c}


def _tags(c):
    return f"unnest({_nd_list(d.split_tags(c))})"


def _with_radius(v):
    return m.marker_records(v.sections, v.sql(f"select * from {_ACC} a"))


@query("facet_categories", f"""
with r as materialized (select * from {_REC} x), el as (select marker, least(elmin, elmax) as lo, greatest(elmin, elmax) as hi from r),
f as (select 'type_excavation' as facet, {_tags('excavation_type')} as value from r union select 'deposit_type', {_tags('type_of_deposits')} from r
 union select 'stratigraphic_position', {_tags('stratigraphic_position')} from r union select 'dating_method', {_tags('dating_methods')} from r
 union select 'chronological_data', case when len({d.split_tags('dating_methods')}) > 0 then 'Yes' else 'No' end from r union select 'object_kind', kind from {_KINDS} k
 union select 'elevation_ranges', cast(x as varchar) || '–' || cast(x + 20 as varchar) || ' m' from (select unnest(generate_series(cast(floor(lo / 20) * 20 as bigint), cast(floor(hi / 20) * 20 as bigint), 20)) as x from el where lo is not null)
 union select 'elevation_ranges', 'ND' from (select marker from el group by 1 having count(lo) = 0)
 union select 'thickness_ranges', unnest({_nd_list('coalesce(thb, [])')}) from {_MARK} y
 union select 'accuracy_ranges', case when accuracy < 20 then '0–20 m' when accuracy < 100 then '20–100 m' when accuracy < 500 then '100–500 m' when accuracy < 1000 then '500–1,000 m' when accuracy < 2000 then '1–2 km' when accuracy < 5000 then '2–5 km' else '≥5 km' end from {_RADIUS} z),
p as (select *, case facet {' '.join(f"when '{k}' then list_position({d.words(c)}, value)" for k, c in _CANON.items())} when 'elevation_ranges' then try_cast(split_part(value, '–', 1) as int) + 1 when 'thickness_ranges' then try_cast(split_part(value, '–', 1) as int) + 1 end as place from f)
select facet, value, row_number() over (partition by facet order by case when coalesce(place, 0) > 0 then place else 1000000000 end, value) - 1 as pos from p""")
def _(v):
    rec = _with_radius(v)
    r = F.count(F.lit(1)) % 3
    kinds = rec.groupBy("marker").agg(F.when(r == 0, "сводный разрез").when(r == 1, "неясно").otherwise("особый вид").alias("kind"))
    return m.facet_categories(m.build_markers(rec, kinds=kinds))


@query("dataset_summary", f"select cast(sum(source_count) as bigint) as raw_records, count(*) as markers, count(*) filter (source_count > 1) as duplicate_groups, min(accuracy) as accuracy_min, max(accuracy) as accuracy_max from {_MARK} x join {_RADIUS} r using (marker)")
def _(v):
    return m.dataset_summary(m.build_markers(_with_radius(v)))


@query("publication_thickness", f"""
select marker, {', '.join(f"coalesce(nullif(array_to_string({_useen('t_' + x)}, '; '), ''), 'ND') as th_{x}" for x in vocab.THICKNESS_KINDS)} from
 (select {_MK} as marker, {', '.join(f"list(thickness_{x} order by ord) filter (thickness_{x} <> 'ND') as t_{x}" for x in vocab.THICKNESS_KINDS)} from fx_sections where lat is not null group by 1)""")
def _(v):
    return m.publication_thickness(_records(v))


@query("collate_objects", f"""
select marker, array_to_string(list_sort(list_distinct(locs)), '; ') as names, coalesce(array_to_string(list_sort(list_distinct(adms)), '; '), '') as admins, coalesce(array_to_string(list_sort(list_distinct(excs)), '; '), '') as workings,
 array_to_string({_useen('qs')}, chr(10)) as quotes from
 (select {_MK} as marker, list(nearest_locality) as locs, list(administrative_unit) filter (administrative_unit <> '') as adms, list(excavation_type) filter (excavation_type <> 'ND') as excs, flatten(list({d.split_list('evidence', '||')} order by ord)) as qs from fx_sections where lat is not null group by 1)""")
def _(v):
    return m.collate_objects(_records(v))


@query("write_marker_dataset", f"""
select 'markers' as part, marker, source_count as n, title as text, accuracy as number from {_MARK} x join {_RADIUS} r using (marker)
union all select 'records', marker, ord, nearest_locality, accuracy from {_REC} x join {_RADIUS} r using (marker)
union all select 'categories', 'deposit_type', row_number() over (order by case when list_position({d.words(vocab.ORDER_DEPOSITS)}, value) > 0 then list_position({d.words(vocab.ORDER_DEPOSITS)}, value) else 1000000000 end, value) - 1, value, null from (select distinct unnest(dep) as value from {_MARK} x)
union all select 'summary', null, count(*), null, max(accuracy) from {_RADIUS} r""")
def _(v):
    out = tools.scratch_path(v.spark, "dataset")
    # read by four aggregates and a writer
    rec = tools.materialise(_with_radius(v))
    b = tools.materialise(m.build_markers(rec))
    writers.write_marker_dataset(b, rec, m.facet_categories(b), m.dataset_summary(b), out)

    def part(name, schema, marker, n, text, number):
        rows = v.spark.read.schema(schema).json(f"{out}/{name}")
        if name == "categories":
            rows = rows.filter("facet = 'deposit_type'")  # facet_categories checks all of them
        return rows.selectExpr(f"'{name}' as part", f"{marker} as marker", f"{n} as n", f"{text} as text", f"{number} as number")

    return part("markers", "marker string, source_count bigint, title string, max_accuracy double", "marker", "source_count", "title", "max_accuracy") \
        .unionByName(part("records", "marker string, ord bigint, locality string, accuracy double", "marker", "ord", "locality", "accuracy")) \
        .unionByName(part("categories", "facet string, value string, pos bigint", "facet", "pos", "value", "cast(null as double)")) \
        .unionByName(part("summary", "markers bigint, accuracy_max double", "cast(null as string)", "markers", "cast(null as string)", "accuracy_max"))


@query("write_sidecars", f"select 'table' as form, marker, accuracy from {_RADIUS} r union all select 'map', marker, accuracy from {_RADIUS} r")
def _(v):
    out = tools.scratch_path(v.spark, "sidecars")
    rows = _with_radius(v).groupBy("marker").agg(F.max("accuracy").alias("accuracy"))
    writers.write_sidecar(rows, "marker", out, f"{out}-json")
    entries = v.spark.read.text(f"{out}-json").select(F.explode(F.from_json("value", "map<string, struct<accuracy: double>>")).alias("marker", "e"))
    return v.spark.read.parquet(out).select(F.lit("table").alias("form"), "marker", "accuracy") \
        .unionByName(entries.select(F.lit("map").alias("form"), "marker", F.col("e.accuracy").alias("accuracy")))
