"""Views over the driver tables that stand for the engine's inputs.

Each statement is plain SQL that Spark and DuckDB read alike; Spark builds DataFrames from it and the
check SQL takes it as a common table expression. Sort keys come from the rows themselves, so no view
numbers rows over a whole table.
"""

from __future__ import annotations

import re

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_PLACE = ("case {k} % 6 when 0 then 'Яр' when 1 then 'Лиман' when 2 then 'Бор' when 3 then 'Кут' "
          "when 4 then 'Мост' else 'Дол' end")
_LETTER = "substring('абвгдежзиклмнопрстуфхцчшщэюя', cast({k} as int) + 1, 1)"


def _milli(e: str) -> str:
    return f"cast({e} as double) / cast(1000 as double)"


VIEWS: dict[str, str] = {}

# position of a line; lines may share one, so ordered results break ties by value
_LINE_ORD = "l_orderkey * 8 + l_linenumber"
_LINE_ALL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"

VIEWS["fx_raw_records"] = f"""
select {_LINE_ORD} as ord, l_orderkey as doc_no, s_name as source_file,
  case when l_partkey % 53 = 0 then 'ND' else concat(
    case l_linenumber % 4 when 0 then 'г. ' when 1 then 'с.  ' when 2 then 'хутор ' else '' end,
    case when l_partkey % 37 = 0 then 'Китайский ' when l_partkey % 41 = 0 then 'Lake ' else 'Красный ' end,
    {_PLACE.format(k='l_partkey')}, ' ', cast(l_partkey % 200 as varchar(9))) end as nearest_locality,
  case when l_linenumber % 3 = 0 then 'ND' else concat(n_name, '  область') end as administrative_unit,
  case l_suppkey % 4 when 0 then 'outcrop' when 1 then 'borehole' when 2 then 'unspecified' else 'ND' end as excavation_type,
  case l_partkey % 3 when 0 then 'вторая терраса' when 1 then 'склон балки' else 'ND' end as geomorphic_position,
  case l_linenumber % 3 when 0 then 'loess; till' when 1 then 'alluvium; loess' else 'ND' end as type_of_deposits,
  p_name as deposit_raw_terms,
  case l_linenumber % 5 when 0 then concat('до ', cast(cast(l_quantity as int) as varchar(9)), ' м')
    when 1 then concat('свыше ', cast(cast(l_quantity as int) as varchar(9)))
    when 2 then concat(cast(cast(l_quantity as int) as varchar(9)), '–', cast(cast(l_quantity as int) + 4 as varchar(9)))
    when 3 then concat(cast(cast(l_quantity as int) * 10 as varchar(9)), ' см') else 'ND' end as thickness_studied,
  case when l_suppkey % 2 = 0 then concat(cast(p_size as varchar(9)), ',5; ', cast(p_size + 2 as varchar(9))) else 'ND' end as thickness_visible,
  case when l_partkey % 7 = 0 then concat(cast(1850 + l_partkey % 300 as varchar(9)), '; 12–40') else 'ND' end as thickness_borehole_depth,
  'ND' as thickness_unspecified,
  case when l_suppkey % 3 = 0 then cast(l_orderkey % 400 as varchar(9)) else 'ND' end as absolute_elevation_m,
  case l_suppkey % 4 when 0 then 'Holocene' when 1 then 'Upper Pleistocene; Middle Pleistocene' when 2 then 'Lower Pleistocene' else 'ND' end as stratigraphic_position,
  case l_orderkey % 5 when 0 then '14C' when 1 then 'OSL; TL' else 'ND' end as dating_methods,
  case l_linenumber % 2 when 0 then 'prose' else 'table' end as source_kind,
  concat('разрез у места ', cast(l_partkey % 200 as varchar(9)), ', скв. ', cast(l_linenumber as varchar(9)), ', долина р. Десна, ',
    case when l_partkey % 2 = 0 then 'Тамбовской области' else 'Ставропольский край' end) as evidence_locality,
  concat('отложения ', p_type) as evidence_deposit, concat('рельеф ', cast(l_partkey % 9 as varchar(9))) as evidence_geomorph
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join part on l_partkey = p_partkey"""

VIEWS["fx_sections"] = f"""
select o_orderkey as ord,
  concat(case when o_orderkey % 31 = 0 then 'Китайский ' when o_orderkey % 9 = 4 then 'Восточный Красный ' else 'Красный ' end,
    {_PLACE.format(k='o_custkey')}, ' ', cast(o_custkey % 200 as varchar(9))) as nearest_locality,
  case when o_orderkey % 3 = 0 then '' when o_orderkey % 11 = 0 then concat(n_name, ' область') else n_name end as administrative_unit,
  case o_orderkey % 5 when 0 then 'outcrop; borehole' when 1 then 'borehole' when 2 then 'pit' else 'ND' end as excavation_type,
  case o_orderkey % 3 when 0 then 'вторая терраса' when 1 then 'бэровский бугор' else 'ND' end as geomorphic_position,
  case o_orderkey % 4 when 0 then 'loess; till' when 1 then 'alluvium' when 2 then 'paleosol; loess' else 'ND' end as type_of_deposits,
  case o_orderkey % 3 when 0 then 'лёсс; суглинок' when 1 then 'супесь' else 'ND' end as deposit_raw_terms,
  case o_orderkey % 4 when 0 then concat(cast(o_orderkey % 13 as varchar(9)), '.5–', cast(o_orderkey % 13 + 6 as varchar(9)))
    when 1 then concat('≥', cast(o_orderkey % 17 as varchar(9))) when 2 then concat('≤', cast(o_orderkey % 19 + 1 as varchar(9))) else 'ND' end as thickness_studied,
  case when o_orderkey % 5 = 0 then cast(o_orderkey % 40 as varchar(9)) else 'ND' end as thickness_visible,
  case when o_orderkey % 7 = 0 then concat(cast(1900 + o_orderkey % 300 as varchar(9)), '–', cast(o_orderkey % 90 as varchar(9)), '; 12–40') else 'ND' end as thickness_borehole_depth,
  case when o_orderkey % 6 = 0 then concat('0–', cast(o_orderkey % 3000 as varchar(9))) else 'ND' end as thickness_unspecified,
  case when o_orderkey % 4 = 3 then 'ND' else cast(o_orderkey % 300 as varchar(9)) end as elevation_min_m,
  case when o_orderkey % 4 = 3 then 'ND' else cast(o_orderkey % 300 + o_orderkey % 47 as varchar(9)) end as elevation_max_m,
  case o_orderkey % 4 when 0 then 'Holocene; Upper Pleistocene' when 1 then 'Middle Pleistocene' when 2 then 'Lower Pliocene; Lower Pleistocene' else 'ND' end as stratigraphic_position,
  case o_orderkey % 5 when 0 then '14C' when 1 then 'OSL; TL' else 'ND' end as dating_methods,
  case o_orderkey % 2 when 0 then 'prose' else 'prose; table' end as source_kinds,
  o_orderkey % 9 + 1 as n_records, o_orderkey % 4 + 1 as n_sources,
  concat('Отчёт ', cast(o_custkey % 97 as varchar(9)), '.pdf',
    case when o_orderkey % 4 > 0 then concat(' | Труды Поволжья ', cast(o_orderkey % 89 as varchar(9)), '.pdf') else '' end,
    case when o_orderkey % 4 > 1 then ' | Кавказский сборник.djvu' else '' end) as sources,
  concat('Скв. ', cast(o_orderkey % 7 as varchar(9)), ' и расчистка ', cast(o_orderkey % 23 as varchar(9)), ', ',
    case o_orderkey % 3 when 0 then concat('Кр', {_LETTER.format(k='n_nationkey')}, 'мской области') when 1 then 'опорный разрез' else 'красноярская свита' end,
    ' || долина р. Д', {_LETTER.format(k='o_custkey % 25')}, 'сны, ',
    case when o_orderkey % 5 = 0 then concat('Лу', {_LETTER.format(k='n_nationkey')}, 'нского района') else 'в приднестровье' end) as evidence,
  case when o_orderkey % 5 = 4 then null else {_milli('41000 + o_custkey * 7919 % 41000')} end as lat,
  case when o_orderkey % 5 = 4 then null else {_milli('19000 + o_custkey * 104729 % 161000')} end as lon,
  case when o_orderkey % 13 = 0 then 'uncertain' else 'ok' end as loc_confidence
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""

VIEWS["fx_gazetteer"] = f"""
select concat('Красный ', {_PLACE.format(k='c_custkey')}, ' ', cast(c_custkey % 200 as varchar(9))) as name,
  n_name as admin, case c_custkey % 10 when 9 then 'waterway' when 8 then 'boundary' else 'place' end as class,
  case c_custkey % 5 when 0 then 'village' when 1 then 'town' when 2 then 'hamlet' when 3 then 'river' else 'city' end as type,
  {_milli('41000 + c_custkey * 7919 % 41000')} as lat, {_milli('19000 + c_custkey * 104729 % 161000')} as lon, c_custkey as rank
from customer join nation on c_nationkey = n_nationkey"""

# areas named in prose: regions of the nations, and one district in each
VIEWS["fx_area_boxes"] = f"""
select name, class, rank, cast(lat0 as double) as lat0, cast(lat0 + dlat as double) as lat1,
  cast(lon0 as double) as lon0, cast(lon0 + dlon as double) as lon1 from (
  select concat('Кр', {_LETTER.format(k='n_nationkey')}, 'мская область') as name, 'boundary' as class, n_nationkey as rank,
    41 + n_nationkey * 3 % 25 as lat0, 15 as dlat, 20 + n_nationkey * 11 % 60 as lon0, 60 as dlon from nation
  union all
  select concat('Лу', {_LETTER.format(k='n_nationkey')}, 'нский район, Кр', {_LETTER.format(k='n_nationkey')}, 'мская область'), 'place', n_nationkey,
    43 + n_nationkey * 3 % 25, 8, 30 + n_nationkey * 11 % 60, 25 from nation) t"""

VIEWS["fx_waterways"] = f"""
select concat('Д', {_LETTER.format(k='s_suppkey % 25')}, 'сна') as name, case s_suppkey % 7 when 0 then 'place' when 1 then 'natural' else 'waterway' end as class,
  case s_suppkey % 2 when 0 then 'water' else 'river' end as type, s_suppkey as rank,
  cast(41 + s_suppkey % 25 as double) as lat0, cast(41 + s_suppkey % 25 + case when s_suppkey % 25 < 8 then 12 else 5 end as double) as lat1,
  cast(20 + s_suppkey * 17 % 100 as double) as lon0, cast(20 + s_suppkey * 17 % 100 + case when s_suppkey % 25 < 8 then 18 else 6 end as double) as lon1
from supplier"""

VIEWS["fx_existing_points"] = f"""
select c_custkey as ord, c_mktsegment as name, {_milli('45000 + c_custkey * 37 % 9000')} as lat,
  {_milli('30000 + c_custkey * 53 % 9000')} as lon from customer"""

VIEWS["fx_new_points"] = """
select c_custkey as ord, case when c_custkey % 3 = 0 then c_mktsegment else c_name end as name,
  cast(450000 + (c_custkey * 37 % 9000) * 10 + c_custkey % 28 as double) / cast(10000 as double) as lat,
  cast(300000 + (c_custkey * 53 % 9000) * 10 + c_custkey % 5 as double) / cast(10000 as double) as lon
from customer"""

# candidates of sub-sites: dense enough that accepted points shadow later ones
VIEWS["fx_dense_points"] = """
select o_orderkey as ord, cast(o_custkey % 400 as bigint) as cluster,
  cast(450000 + (o_custkey % 400) * 200 + o_orderkey * 7 % 97 as double) / cast(10000 as double) as lat,
  cast(300000 + (o_custkey % 400) * 130 + o_orderkey * 13 % 89 as double) / cast(10000 as double) as lon
from orders"""

VIEWS["fx_pages"] = "select lang as publication, doc_id as idx, doc_id as ord, text from documents"

# quotes out of the pages: whole ones, ones that go on differently after some characters or words, and ones in another order
VIEWS["fx_evidence"] = """
select doc_id as item_id, lang as publication, case doc_id % 6 when 0 then substring(text, 41, 200)
  when 1 then concat(substring(text, 41, 75), ' zzq vvk') when 2 then concat(substring(text, 41, 56), ' zzq vvk')
  when 3 then concat(substring(text, 41, 40), ' zzq vvk') when 4 then concat(substring(text, 41, 27), ' zzq vvk zzq')
  else concat('zzq ', substring(text, 121, 60), ' vvk ', substring(text, 41, 60)) end as evidence from documents"""

VIEWS["fx_doc_pages"] = """
select concat('/архив/', source, '/том ', cast(doc_id % 7 as varchar(3)), '.pdf') as path, source as run,
  doc_id as idx, doc_id as ord, text from documents"""

VIEWS["fx_status"] = """
select concat('job', cast(c_custkey as varchar(9))) as job_id, concat(c_name, '.pdf') as filename,
  case c_custkey % 5 when 0 then 'queued' when 1 then 'processing' when 2 then 'error' else 'ready' end as status,
  c_custkey * 60 as created, concat('msg ', cast(c_custkey % 11 as varchar(9))) as msg,
  case c_custkey % 4 when 0 then 'автопоиск' else 'anon' end as submitter from customer"""

VIEWS["fx_proposals"] = f"""
select concat('job', cast(o_custkey as varchar(9))) as job_id,
  row_number() over (partition by o_custkey order by o_orderkey) - 1 as i,
  concat('Красный Яр ', cast(o_orderkey % 200 as varchar(9))) as locality,
  case when o_orderkey % 3 = 0 then 'ND' else o_orderpriority end as admin,
  concat('studied: ', cast(o_orderkey % 40 as varchar(9)), ' м') as thickness,
  concat(cast(o_orderkey % 300 as varchar(9)), '-', cast(o_orderkey % 300 + 5 as varchar(9))) as elevation,
  case when o_orderkey % 4 = 0 then null else {_milli('45000 + o_orderkey * 37 % 9000')} end as lat,
  case when o_orderkey % 4 = 0 then null else {_milli('30000 + o_orderkey * 53 % 9000')} end as lon
from orders"""

VIEWS["fx_decisions"] = """
select concat('job', cast(user_id as varchar(9))) as job_id, event_id % 7 as i,
  case when event_type in ('purchase', 'signup') then 'accept' when event_type = 'error' then 'reject' else 'view' end as verdict,
  concat('u', cast(user_id % 9 as varchar(9))) as reviewer, event_id as ts from events"""

VIEWS["fx_marker_points"] = """
select c_custkey as ord, concat(cast(40 + c_custkey * 7 % 30 as varchar(9)), '.', cast(100000 + c_custkey as varchar(9))) as lat_text,
  concat(cast(30 + c_custkey % 60 as varchar(9)), '.', cast(200000 + c_custkey as varchar(9))) as lon_text, c_name as name from customer"""

VIEWS["fx_corrections"] = """
select event_id as ord,
  concat(cast(40 + user_id * 7 % 30 as varchar(9)), '.', cast(100000 + user_id as varchar(9)), cast(30 + user_id % 60 as varchar(9)), '.', cast(200000 + user_id as varchar(9))) as marker_key,
  case event_type when 'click' then 'correct' when 'view' then 'partial' else 'incorrect' end as verdict,
  case when event_id % 3 = 0 then concat('Правильные координаты. ', cast(40 + event_id % 20 as varchar(9)), '.', cast(100000 + event_id as varchar(9)), ', ', cast(30 + event_id % 60 as varchar(9)), '.', cast(200000 + event_id as varchar(9)))
    when event_id % 3 = 1 then concat('Разрез Customer#', lpad(cast(user_id as varchar(9)), 9, '0'), ' находится в Тамбовской области') else '' end as comment,
  case event_id % 6 when 0 then 'система' else 'anon' end as reviewer, event_id as ts from events"""

# pages of about thirty lines; pub3 lies sideways, pub5 upside down
VIEWS["fx_scan_lines"] = f"""
select slug, page, 1000 as w, 2000 as h, n, text, x0,
  case when slug = 'pub5' then 1900 - n * 50 else n * 50 end as y0,
  x0 + case when slug = 'pub3' then 20 else 400 end as x1,
  case when slug = 'pub5' then 1900 - n * 50 else n * 50 end + case when slug = 'pub3' then 300 else 18 end as y1
from (select concat('pub', cast(cast(floor(l_orderkey / 8) as bigint) % 10 as varchar(9))) as slug,
    cast(floor(l_orderkey / 80) as bigint) as page, l_linenumber * 10 as x0,
    concat(p_name, case when l_partkey % 29 = 0 then ' строение разреза' else '' end) as text,
    row_number() over (partition by cast(floor(l_orderkey / 8) as bigint) order by {_LINE_ALL}) - 1 as n
  from lineitem join part on l_partkey = p_partkey) t"""

VIEWS["fx_catalog"] = """
select concat('/', source, '/doc_', cast(doc_id as varchar(9)), case doc_id % 5 when 0 then '.pdf' when 1 then '.PDF' when 2 then '.djvu' when 3 then '.jpg' else '' end) as path,
  n_chars * 1000 as size, case doc_id % 5 when 3 then 'image' else 'document' end as media_type, source as top from documents"""

VIEWS["fx_listing_html"] = """
select doc_id, concat('<a href="/article/n/doc-', cast(doc_id as varchar(9)), '"> <div class="title">', case doc_id % 4 when 0 then 'Лёссы и погребенные почвы' when 1 then 'Конодонты девона' when 2 then 'Разрез, скважина, мощность аллювия' else 'Экономика' end,
  '</div> <p>', text, '</p> <span>2020 / <b>A</b></span></a><a href="/article/n/x-', cast(doc_id as varchar(9)), '"><div class="title">Юрские отложения</div><p>т</p><span>m</span></a>') as html from documents"""

VIEWS["fx_article_html"] = """
select page_id, concat('<meta name="citation_title" content="T', cast(page_id as varchar(9)), '"><meta name="citation_author" content="A"><meta name="citation_author" content="B"><div itemprop="articleBody">', html) as html from pages"""

# page links: marker → publication page
VIEWS["fx_links"] = """
select concat('m', cast(l_suppkey as varchar(9))) as marker,
  concat('Отчёт ', cast(l_partkey % 60 as varchar(9)), '.pdf', case when l_partkey % 5 = 0 then ' (загружено пользователем)' else '' end) as src,
  cast(l_quantity as int) as page, l_linenumber % 2 = 0 as approx from lineitem"""

VIEWS["fx_scan_index"] = """
select distinct concat('Отчёт ', cast(p_partkey % 45 as varchar(9)), '.pdf') as publication, p_size as page,
  concat('scans/', cast(p_partkey % 45 as varchar(9)), '/p', cast(p_size as varchar(9)), '.jpg') as scan_key from part"""

# sub-sites: a chain k → k div 2 inside each job, the first links of which have coordinates
VIEWS["fx_subsites"] = """
select c_custkey as ord, concat('job', cast(c_nationkey as varchar(9))) as job_id,
  concat('Площадка ', cast(c_custkey as varchar(9))) as name,
  case c_custkey % 9 when 5 then 'то же самое место' when 7 then 'самостоятельный объект' else 'часть другого объекта' end as relation,
  case when c_custkey < 4 then 'Сводный разрез' when c_custkey % 4 = 3 then '' else concat('Площадка ', cast(cast(floor(c_custkey / 2) as bigint) as varchar(9))) end as parent,
  case when c_custkey > 3 and c_custkey % 4 = 3 then concat('Площадка ', cast(cast(floor(c_custkey / 2) as bigint) as varchar(9))) else '' end as anchor,
  case when c_custkey % 4 = 3 then cast(c_custkey % 5 as double) else cast(0 as double) end as offset_km,
  case c_custkey % 4 when 3 then 'юг' else 'нет' end as direction,
  concat(case when c_custkey % 10 = 0 then 'вероятно, ' else '' end, 'у северной окраины села, Якорь ', cast(c_custkey % 40 as varchar(9))) as why,
  case when c_custkey < 8 then 50 + cast(c_custkey as double) / cast(100 as double) end as lat,
  case when c_custkey < 8 then 40 + cast(c_custkey as double) / cast(100 as double) end as lon,
  cast(case when c_custkey < 8 then 1500 end as bigint) as accuracy from customer"""


def needed_views(sql: str) -> list[str]:
    """Views a statement mentions, each after the views it is built on."""
    out: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_[a-z_0-9]+\b", text):
            if name in VIEWS and name not in out:
                visit(VIEWS[name])
                if name not in out:
                    out.append(name)
    visit(sql)
    return out


def with_views(sql: str) -> str:
    names = needed_views(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    body = sql.lstrip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
