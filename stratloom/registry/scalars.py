"""Column functions over whole views."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import numbers as n
from ..functions import text as t
from . import duck as d
from .core import query

J = " || "


def _join(c):
    return F.array_join(c, "|")


# ------------------------------------------------------------------ §2.2 projections and predicates
@query("nd_normalise", f"""
select ord, case when lower({d.strip('v')}) in ('none', 'nan', '', 'nd', 'no data', 'null') then 'ND' else {d.strip('v')} end as v
from (select ord, concat(' ', administrative_unit, ' ') as v from fx_sections)""")
def _(v):
    return v.sections.select("ord", t.nd_normalise(F.concat(F.lit(" "), "administrative_unit", F.lit(" "))).alias("v"))


@query("scrub_control_chars", """
select doc_id, regexp_replace(chr(7) || text || chr(31), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') as text from documents""")
def _(v):
    return v.table("documents").select("doc_id", t.scrub_control_chars(
        F.concat(F.lit("\x07"), "text", F.lit("\x1f"))).alias("text"))


_FOREIGN = f"(regexp_matches(loc, '[A-Za-z]') or {d.any_word('lower(loc)', vocab.FOREIGN_NAMES)})"


@query("split_foreign", f"""
select ord, loc, case when {_FOREIGN} then 'international' else 'domestic' end as part from
  (select ord, {d.norm_locality('nearest_locality')} as loc from fx_raw_records where nearest_locality <> 'ND')""")
def _(v):
    from ..operators.sections import with_origin
    return with_origin(v.raw_records).select("ord", "loc", F.when(F.col("foreign"), "international").otherwise("domestic").alias("part"))


@query("skip_geocode_foreign", f"""
select ord, {d.any_word('lower(nearest_locality)', vocab.FOREIGN_GEOCODE)} as skip from fx_sections""")
def _(v):
    return v.sections.select("ord", t.skip_geocode_foreign(F.col("nearest_locality")).alias("skip"))


_NAMES = """(select ord, case ord % 7 when 0 then concat(cast(ord % 90 as varchar(9)), ' км') when 1 then concat('АМК-', cast(ord % 9000 + 10 as varchar(9)))
  when 2 then concat('скв ', cast(ord % 9 as varchar(9))) when 3 then 'Азовское море' when 4 then 'Лужский район'
  when 5 then concat('Я', cast(ord % 9 as varchar(9))) else nearest_locality end as name from fx_sections)"""
_W = d.WORD


@query("not_place_reason", f"""
select ord, name, case when regexp_matches(name, '(?i)^\\s*\\d+[\\s,.]*км') then 'расстояние по трассе'
  when regexp_matches(name, '^[A-ZА-Я]{{2,5}}[-–]?\\d{{2,}}') then 'номер выработки'
  when regexp_matches(name, '(?i)^(скв|обн|шурф|расчистк|разрез|profile|core)($|[^{_W}])') then 'обозначение выработки'
  when regexp_matches(name, '(?i)(^|[^{_W}])(море|озеро|залив|пролив|хребет|плато|равнин|низменност|возвышенност|бассейн|междуречь)') then 'объект-площадь, а не точка'
  when regexp_matches(name, '(?i)(^|[^{_W}])(район|область|край|округ|республик|уезд|губерни)($|[^{_W}])') then 'административная единица'
  when not regexp_matches(name, '[А-Яа-яЁёA-Za-z]{{4,}}') then 'нет словесной основы' end as why from {_NAMES} x""")
def _(v):
    return v.sql(f"select * from {_NAMES} x").select("ord", "name", t.not_place_reason("name").alias("why"))


@query("is_internal_label", f"""
select ord, name, regexp_matches(name, '(?i)^\\s*(site|участок|площадк[{_W}]*|section|разрез|скв[{_W}]*|borehole|pit|шурф)?\\s*[\\-{_W}]{{0,3}}[\\-\\s]?\\d+[\\-{_W}]*\\s*$') as label
from {_NAMES} x""")
def _(v):
    return v.sql(f"select * from {_NAMES} x").select("ord", "name", t.is_internal_label("name").alias("label"))


@query("is_hedged", """
select ord, regexp_matches(why, '(?i)вероятн|возможно|скорее всего|по-видимому|предполож|наверное|может быть') as hedged from fx_subsites""")
def _(v):
    return v.subsites.select("ord", t.is_hedged("why").alias("hedged"))


@query("valid_coord", """
select ord, lat between 41 and 82 and lon between 19 and 180 as ok, lat - 8 between 35 and 82 and lon between 19 and 180 as ok_fix
from fx_sections where lat is not null""")
def _(v):
    lat, lon = F.col("lat"), F.col("lon")
    return v.sections.filter("lat is not null").select(
        "ord", g.valid_coord(lat, lon).alias("ok"), g.valid_coord(lat - 8, lon, 35).alias("ok_fix"))


# ------------------------------------------------------------------ §2.8 numbers
_LO, _HI = d.num_lo_hi("thickness_studied")


@query("parse_num", f"select ord, {_LO} as lo, {_HI} as hi from fx_raw_records")
def _(v):
    return v.raw_records.select("ord", n.parse_num("thickness_studied").alias("r")).select("ord", "r.lo", "r.hi")


_JL, _JH = d.joined_lo_hi("s")


@query("parse_joined", f"""
select ord, {_JL} as lo, {_JH} as hi from (select ord, concat(thickness_visible, '; ', thickness_borehole_depth, ';', thickness_studied) as s from fx_raw_records)""")
def _(v):
    s = F.concat("thickness_visible", F.lit("; "), "thickness_borehole_depth", F.lit(";"), "thickness_studied")
    return v.raw_records.select("ord", n.parse_joined(s).alias("r")).select("ord", "r.lo", "r.hi")


@query("format_range", f"""
select ord, {d.fmt_range('lo', 'hi')} as text from
 (select ord, case when ord % 5 = 0 then null else cast(ord as double) / cast(8 as double) end as lo,
   case when ord % 7 = 0 then null when ord % 3 = 0 then cast(ord as double) / cast(8 as double) else cast(ord as double) / cast(4 as double) end as hi from fx_sections)""")
def _(v):
    o = F.col("ord")
    lo = F.when(o % 5 != 0, o / F.lit(8.0))
    hi = F.when(o % 7 == 0, None).when(o % 3 == 0, o / F.lit(8.0)).otherwise(o / F.lit(4.0))
    return v.sections.select("ord", n.format_range(lo, hi).alias("text"))


@query("fmt_g", """
select ord, printf('%g', x) as g from
 (select o_orderkey as ord, o_totalprice * case o_orderkey % 6 when 0 then 1 when 1 then -0.001 when 2 then 0.0000001 when 3 then 10000 when 4 then 0 else 0.01 end as x from orders)""")
def _(v):
    x = F.expr("o_totalprice * case o_orderkey % 6 when 0 then 1D when 1 then -0.001D when 2 then 0.0000001D "
               "when 3 then 10000D when 4 then 0D else 0.01D end")
    return v.table("orders").select(F.col("o_orderkey").alias("ord"), n.fmt_g(x).alias("g"))


_RL, _RH = d.range_lo_hi("thickness_studied")


@query("parse_range", f"select ord, {_RL} as lo, {_RH} as hi from fx_sections")
def _(v):
    return v.sections.select("ord", n.parse_range("thickness_studied").alias("r")).select("ord", "r.lo", "r.hi")


@query("clean_thickness", r"""
select ord, case when len(list_filter(toks, lambda t: """ + (_BAD := r"""regexp_matches(t, '^\d') and ((try_cast(replace(t, ',', '.') as double) between 1900 and 2030 and try_cast(replace(t, ',', '.') as double) = floor(try_cast(replace(t, ',', '.') as double))) or try_cast(replace(t, ',', '.') as double) > 300)""") + r""")) = 0 then s
  when len(kept) = 0 then 'ND' else array_to_string(kept, '; ') end as cleaned
from (select ord, s, toks, list_filter(list_transform(string_split(array_to_string(list_transform(toks, lambda t: case when """ + _BAD + r""" then '' else t end), ''), ';'),
    lambda p: trim(trim(p, ' -–—;,'), ' -–—')), lambda p: regexp_matches(p, '\d')) as kept
  from (select ord, s, regexp_extract_all(s, '\d+(?:[.,]\d+)?|\D+') as toks from
    (select ord, thickness_borehole_depth as s from fx_sections union all select ord + 100000000, thickness_unspecified from fx_sections)))""")
def _(v):
    s = v.sections
    both = s.select("ord", F.col("thickness_borehole_depth").alias("s")).unionAll(
        s.select(F.col("ord") + 100000000, "thickness_unspecified"))
    return both.select("ord", n.clean_thickness("s", 300).alias("cleaned"))


@query("kind_value", """
select job_id, i, trim(trim(regexp_extract(thickness, '^\\s*([a-z_]+)\\s*:\\s*(.+?)\\s*м?\\s*$', 2))) as studied, '' as visible from fx_proposals""")
def _(v):
    arr = F.array("thickness")
    return v.proposals.select("job_id", F.col("i").cast("bigint").alias("i"), n.kind_value(arr, "studied").alias("studied"),
                              n.kind_value(arr, "visible").alias("visible"))


@query("elev_bounds", """
select job_id, i, coalesce(replace(x[1], ',', '.'), '') as first, coalesce(replace(x[-1], ',', '.'), '') as last from
 (select job_id, i, regexp_extract_all(elevation, '-?\\d+(?:[.,]\\d+)?') as x from fx_proposals)""")
def _(v):
    return v.proposals.select("job_id", F.col("i").cast("bigint").alias("i"), n.elev_bounds("elevation").alias("e")
                              ).select("job_id", "i", "e.first", "e.last")


@query("bins", """
with v as (select ord, try_cast(elevation_min_m as double) as lo, try_cast(elevation_max_m as double) as hi, n_records * 777 as acc from fx_sections)
select ord, cast(cast(floor(lo / 20) * 20 as bigint) as varchar) || '–' || cast(cast(floor(lo / 20) * 20 as bigint) + 20 as varchar) || ' m' as b20,
 cast(cast(floor(hi / 5) * 5 as bigint) as varchar) || '–' || cast(cast(floor(hi / 5) * 5 as bigint) + 5 as varchar) || ' m' as b5,
 case when lo is null and hi is null then '' else array_to_string(list_transform(generate_series(cast(floor(least(lo, hi) / 20) * 20 as bigint), cast(floor(greatest(lo, hi) / 20) * 20 as bigint), 20), lambda x: cast(x as varchar) || '–' || cast(x + 20 as varchar) || ' m'), '|') end as span,
 case when acc < 20 then '0–20 m' when acc < 100 then '20–100 m' when acc < 500 then '100–500 m' when acc < 1000 then '500–1,000 m' when acc < 2000 then '1–2 km' when acc < 5000 then '2–5 km' else '≥5 km' end as acc
from v""")
def _(v):
    lo, hi = F.col("elevation_min_m").try_cast("double"), F.col("elevation_max_m").try_cast("double")
    return v.sections.select("ord", n.bin20(lo).alias("b20"), n.bin5(hi).alias("b5"),
                             _join(n.bins_span(lo, hi, 20)).alias("span"), n.acc_bin(F.col("n_records") * 777).alias("acc"))


@query("bin_label_order", """
select label, row_number() over (order by low, label) as pos from (select distinct label, case when label = 'ND' then 1000000000 else coalesce(try_cast(split_part(label, '–', 1) as int), 0) end as low
 from (select case when elevation_min_m = 'ND' then 'ND' else cast(cast(floor(cast(elevation_min_m as int) / 20) * 20 as bigint) as varchar) || '–' || cast(cast(floor(cast(elevation_min_m as int) / 20) * 20 as bigint) + 20 as varchar) || ' m' end as label from fx_sections))""")
def _(v):
    from ..operators.tools import ordinal
    lo = F.col("elevation_min_m").try_cast("double")
    labels = v.sections.select(F.coalesce(n.bin20(lo), F.lit("ND")).alias("label")).distinct()
    return ordinal(labels.withColumn("low", n.bin_low(F.col("label"))), [], ["low", "label"], "pos", start=1).select("label", "pos")


# ------------------------------------------------------------------ §2.8 text
@query("norm_locality", f"select ord, {d.norm_locality('nearest_locality')} as loc from fx_raw_records")
def _(v):
    return v.raw_records.select("ord", t.norm_locality("nearest_locality").alias("loc"))


@query("norm_admin", f"select ord, {d.norm_admin('administrative_unit')} as adm from fx_raw_records")
def _(v):
    return v.raw_records.select("ord", t.norm_admin("administrative_unit").alias("adm"))


@query("split_tags", f"select ord, array_to_string({d.split_tags('type_of_deposits')}, '|') as tags, cast(len({d.split_tags('stratigraphic_position')}) as int) as n from fx_raw_records")
def _(v):
    return v.raw_records.select("ord", _join(t.split_tags("type_of_deposits")).alias("tags"),
                                F.size(t.split_tags("stratigraphic_position")).alias("n"))


@query("norm_search", f"select doc_id, {d.norm_search('text')} as norm from documents")
def _(v):
    return v.table("documents").select("doc_id", t.norm_search("text").alias("norm"))


@query("norm_pubname", f"select marker, page, {d.squash('lower(' + d.strip(chr(114)) + ')')} as pub from (select marker, page, regexp_replace(src, '(?i)\\s*\\(загружено пользователем\\)\\s*$', '') as r from fx_links)")
def _(v):
    return v.links.select("marker", "page", t.norm_pubname("src").alias("pub"))


@query("strip_marks", """
select doc_id, translate(regexp_replace(x, '\\p{Mn}', '', 'g'), 'йЙёЁ', 'иИеЕ') as plain from (select doc_id, text || ' Отка' || chr(769) || 'зное, Ёжик Йод' as x from documents)""")
def _(v):
    return v.table("documents").select("doc_id", t.strip_marks(
        F.concat("text", F.lit(" Отка́зное, Ёжик Йод"))).alias("plain"))


@query("nfd_strip", "select doc_id, regexp_replace(nfd_free, '\\p{Mn}', '', 'g') as plain from (select doc_id, strip_accents(text || ' Отказной Ёж') as nfd_free from documents)")
def _(v):
    from ..functions.python import nfd_strip
    return v.table("documents").select("doc_id", nfd_strip(F.concat("text", F.lit(" Отказной Ёж"))).alias("plain"))


@query("pub_slug", "select path, substring(trim(regexp_replace(regexp_replace(path, '\\.[^.]*$', ''), '[^0-9A-Za-zА-Яа-яЁё]+', '_', 'g'), '_'), 1) || '_' || substring(md5(path), 1, 6) as slug from fx_catalog")
def _(v):
    return v.catalog.select("path", t.pub_slug("path").alias("slug"))


@query("safe_name", "select path, substring(regexp_replace(split_part(path, '/', -1), '[ ?*:<>|\"\\\\/\\t\\n\\r]', '_', 'g'), 1) as safe, substring(regexp_replace(path, '[^0-9A-Za-z\\-_]', '', 'g'), 1) as job from fx_doc_pages")
def _(v):
    return v.doc_pages.select("path", t.safe_name("path").alias("safe"), t.safe_job_id("path").alias("job"))


@query("file_ext", "select path, case when contains(nm, '.') then '.' || lower(split_part(nm, '.', -1)) else '(no ext)' end as ext from (select path, split_part(path, '/', -1) as nm from fx_catalog)")
def _(v):
    return v.catalog.select("path", t.file_ext("path").alias("ext"))


@query("natural_key", "select path, array_to_string(list_transform(regexp_extract_all(path, '\\d+|\\D+'), lambda t: case when regexp_matches(t, '^\\d') then lpad(cast(length(ltrim(t, '0')) as varchar), 10, '0') || ltrim(t, '0') else lower(t) end), '|') as k from fx_catalog")
def _(v):
    return v.catalog.select("path", _join(t.natural_key("path")).alias("k"))


_WS = (f"(скв(?:ажин[{_W}]*|\\.)?\\s*№?\\s*[\\dIVX][\\d/IVX]{{0,4}}|шурф[{_W}]*\\s*№?\\s*\\d[\\d/]{{0,4}}|расчистк[{_W}]*\\s*№?\\s*\\d[\\d/]{{0,4}}"
       f"|обн(?:ажени[{_W}]*|\\.)\\s*№?\\s*\\d[\\d/]{{0,3}}|разрез\\s*№\\s*\\d[\\d/]{{0,3}}|Site\\s*\\d{{1,3}}|[A-Z]{{2}}-\\d{{2}}[A-Z\\d\\-]{{0,6}})")
_QUOTES = d.split_list("evidence", "||")
_EVQ = """(select ord, concat(evidence, ' || Site 4 и OT-22V, скв. ', cast(1970 + ord % 9 as varchar(9)), ' || расчистки ', cast(ord % 23 as varchar(9)), ', скважина ', cast(ord % 5 as varchar(9))) as evidence, nearest_locality from fx_sections)"""
_IDS = f"""(select ord, evidence, list_transform(list_filter(fs, lambda p, i: list_position(ks, p.k) = i), lambda p: p.v) as ids from
 (select *, list_transform(fs, lambda p: p.k) as ks from
  (select ord, evidence, list_transform(list_filter(list_transform(flatten(list_transform({_QUOTES}, lambda q: regexp_extract_all(q, '(?i){_WS}'))), lambda z: trim({d.squash('z')}, ' .,;')),
     lambda z: not regexp_matches(z, '(^|[^{_W}])(1[89]\\d{{2}}|20[0-3]\\d)($|[^{_W}])')),
    lambda z: {{'k': substring(regexp_replace(regexp_extract(lower(z), '^([^\\d]*)', 1), '[^a-zа-я]', '', 'g'), 1, 5) || '|' || {d.strip("regexp_extract(lower(z), '^[^\\d]*(.*)$', 1)")}, 'v': z}}) as fs from {_EVQ} e)))"""


@query("working_ids", f"select ord, array_to_string(ids, '|') as ids from {_IDS} w")
def _(v):
    return v.sql(f"select * from {_EVQ} e").select("ord", _join(t.working_ids(t.split_quotes("evidence"))).alias("ids"))


@query("object_level", f"""
select ord, case when ord % 10 = 0 then 'регион в целом' when regexp_matches(evidence, '(?i)(сводн[{_W}]+\\s+(разрез|колонк)|обобщ[её]нн[{_W}]+\\s+разрез|типов[{_W}]+\\s+разрез|опорн[{_W}]+\\s+разрез)') then 'сводный разрез'
 when len(ids) > 0 then 'конкретные выработки' else '' end as level from {_IDS} w""")
def _(v):
    e = v.sql(f"select * from {_EVQ} e").withColumn("q", t.split_quotes("evidence"))
    verdict = F.when(F.col("ord") % 10 == 0, "регион в целом")
    return e.select("ord", t.object_level(verdict, F.col("q"), t.working_ids(F.col("q"))).alias("level"))


def _duck_stem(e):
    low = f"replace(lower({e}), 'ё', 'е')"
    arms = " ".join(f"when suffix({low}, '{s}') then left({low}, length({low}) - {len(s)})" for s in t._SUFFIXES)
    return f"case {arms} else {low} end"


@query("unit_name_warning", f"""
select ord, unit <> '' and length(a) >= 5 and length(b) >= 5 and left(a, 6) = left(b, 6) as warn from
 (select ord, unit, {_duck_stem('title')} as a, {_duck_stem('unit')} as b from
  (select ord, case when ord % 2 = 0 then 'Красноярское' else nearest_locality end as title,
    regexp_extract(evidence, '(?i)([А-ЯЁ][а-яё]+ск)(?:ий|ая|ое|ого|ой|ом|ую)\\s+(?:лесс|лёсс|свит|горизонт|почв|толщ|слои)', 1) as unit from fx_sections))""")
def _(v):
    title = F.when(F.col("ord") % 2 == 0, "Красноярское").otherwise(F.col("nearest_locality"))
    return v.sections.select("ord", t.unit_name_warning(title, F.col("evidence")).alias("warn"))


def _duck_area(e):
    obl = f"regexp_extract({e}, '([А-ЯЁ][а-яё\\-]+ск)(?:ая|ой|ую|ом)\\s+(?:област[ьия]|обл\\.)', 1)"
    krai = f"regexp_extract({e}, '([А-ЯЁ][а-яё\\-]+ск)(?:ий|ого|ом)\\s+кра[йея]', 1)"
    resp = f"regexp_extract({e}, '[Рр]еспублик[аиеу]\\s+([А-ЯЁ][а-яё\\-]+)', 1)"
    rai = f"regexp_extract({e}, '([А-ЯЁ][а-яё\\-]+ск)(?:ий|ого|ом)\\s+район', 1)"
    rai2 = f"regexp_extract({e}, '([А-ЯЁ][а-яё\\-]+н)(?:ского)\\s+район', 1)"
    _ = rai2
    return (f"case when {obl} <> '' then {obl} || 'ая область' when {krai} <> '' then {krai} || 'ий край' "
            f"when {resp} <> '' then 'Республика ' || {resp} end", f"case when {rai} <> '' then {rai} || 'ий район' end")


_REG, _DIS = _duck_area("e")


@query("admin_from_text", f"""
select ord, {_REG} as region, {_DIS} as district from (select ord, concat(evidence_locality, case when doc_no % 3 = 0 then ' и Республике Карелия, Лужского района' else '' end) as e from fx_raw_records)""")
def _(v):
    e = F.concat("evidence_locality", F.when(F.col("doc_no") % 3 == 0, " и Республике Карелия, Лужского района").otherwise(""))
    return v.raw_records.select("ord", t.admin_from_text(e).alias("a")).select("ord", "a.region", "a.district")


def duck_river(e):
    a = (f"regexp_extract({e}, '(?:р\\.|реки|реке|рекой|река|бассейн[{_W}]*\\s+р(?:еки|\\.)|долин[{_W}]*\\s+р(?:еки|\\.)|берег[{_W}]*\\s+р(?:еки|\\.))\\s*([А-ЯЁ][а-яё\\-]{{2,}})', 1)")
    b = f"regexp_extract({e}, '(?:^|[^{_W}])на\\s+([А-ЯЁ][а-яё\\-]{{3,}}[еиы])(?:$|[^{_W}])', 1)"
    return f"case when {a} <> '' then {a} when {b} <> '' then {b} end"


@query("river_from_text", f"select ord, {duck_river('e')} as river from (select ord, case when ord % 4 = 0 then 'разрез на Десне вскрыт' else evidence end as e from fx_sections)")
def _(v):
    e = F.when(F.col("ord") % 4 == 0, "разрез на Десне вскрыт").otherwise(F.col("evidence"))
    return v.sections.select("ord", t.river_from_text(e).alias("river"))


def duck_variants(w):
    cut, two = f"left({w}, length({w}) - 1)", f"left({w}, length({w}) - 2)"
    raw = (f"list_filter([{w}, case when length({w}) > 2 then {cut} || 'а' end, case when length({w}) > 2 then {cut} || 'я' end, "
           f"case when suffix({w}, 'ой') or suffix({w}, 'ей') then {two} || 'а' end], lambda z: z is not null)")
    return f"list_filter({raw}, lambda z, i: list_position(list_transform({raw}, lambda y: lower(y)), lower(z)) = i)"


@query("river_variants", f"select ord, array_to_string({duck_variants('w')}, '|') as forms from (select ord, case ord % 3 when 0 then 'Окой' when 1 then 'Десна' else {duck_river('evidence')} end as w from fx_sections)")
def _(v):
    w = F.when(F.col("ord") % 3 == 0, "Окой").when(F.col("ord") % 3 == 1, "Десна").otherwise(t.river_from_text("evidence"))
    return v.sections.select("ord", _join(t.river_variants(w)).alias("forms"))


_VN = "(select ord, case ord % 4 when 0 then 'Костенки I' when 1 then concat('с. Борщево-', cast(ord % 99 as varchar(9))) when 2 then 'д. Ям' else nearest_locality end as name from fx_sections)"


def duck_name_variants(e):
    bare = d.strip(f"regexp_replace({e}, '(?i)^\\s*(?:с|д|пос|г|ст|хут|пгт|аул|разрез|скв)\\.?\\s+', '')")
    short = d.strip("regexp_replace(b, '(?i)[\\s\\-–]+(?:[IVXLC]{1,5}|\\d{1,3}[а-яa-z]?)\\s*$', '')")
    return (f"(list_transform([{bare}], lambda b: list_filter([{e}, case when b <> {e} then b end, "
            f"case when {short} <> b and length({short}) >= 4 then {short} end], lambda z: z is not null and length(z) >= 3))[1])")


@query("name_variants", f"select ord, array_to_string({duck_name_variants('name')}, '|') as forms from {_VN} x")
def _(v):
    return v.sql(f"select * from {_VN} x").select("ord", _join(t.name_variants("name")).alias("forms"))


@query("unwrap_cell", f"""
select ord, case when array_to_string(list_filter({d.split_tags('type_of_deposits')}, lambda z, i: list_position({d.split_tags('type_of_deposits')}, z) = i), '; ') = '' then 'ND'
  else array_to_string({d.split_tags('type_of_deposits')}, '; ') end as deposits, case when nearest_locality = '' then 'ND' else nearest_locality end as loc from fx_raw_records""")
def _(v):
    cells = t.split_tags("type_of_deposits")
    doubled = F.concat(cells, cells, F.array(F.lit("ND")))
    return v.raw_records.select("ord", F.when(F.size(cells) == 0, "ND").otherwise(t.unwrap_cell(doubled, True)).alias("deposits"),
                                t.unwrap_cell(F.col("nearest_locality")).alias("loc"))


@query("evidence_cell", "select doc_id, text as quote from documents")
def _(v):
    return v.table("documents").select("doc_id", t.evidence_cell(F.col("text")).alias("quote"))


@query("thickness_by_kind", "select ord, thickness_studied as studied, case when thickness_visible = 'ND' then 'ND' else thickness_visible end as visible from fx_raw_records")
def _(v):
    def m(kind, c):
        return F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value_m"))
    arr = F.array(m("studied", "thickness_studied"), m("visible", "thickness_visible"), m("studied", "thickness_studied"))
    return v.raw_records.select("ord", t.thickness_by_kind(arr, "studied").alias("studied"),
                                t.thickness_by_kind(arr, "visible").alias("visible"))


@query("stratigraphic_order", """
select ord, array_to_string(list_transform(list_sort(list_transform(x, lambda z: {'p': case z when 'Lower Pleistocene' then 1 when 'Middle Pleistocene' then 2 when 'Upper Pleistocene' then 3 when 'Holocene' then 4 else 9 end, 'v': z})), lambda z: z.v), '|') as ages
from (select ord, """ + d.split_tags("stratigraphic_position") + """ as x from fx_sections)""")
def _(v):
    return v.sections.select("ord", _join(t.stratigraphic_order(t.split_tags("stratigraphic_position"))).alias("ages"))


@query("search_text", "select ord, lower(concat_ws(' ', cast(ord as varchar), nearest_locality, administrative_unit, type_of_deposits, sources)) as s from fx_sections")
def _(v):
    return v.sections.select("ord", t.search_text(F.col("ord").cast("string"), F.col("nearest_locality"),
                                                  F.col("administrative_unit"), F.col("type_of_deposits"), F.col("sources")).alias("s"))


@query("display_values", """
select ord, case when dating_methods = 'ND' then 'No' else 'Yes' end as chrono, coalesce(printf('%.5f, %.5f', lat, lon), 'ND') as coord, cast(n_records * 500 as varchar) || ' м' as radius from fx_sections""")
def _(v):
    from ..operators.viewer import display_values
    return display_values(v.sections.withColumn("radius_m", F.col("n_records") * 500)
                          .withColumn("chrono_raw", F.when(F.col("dating_methods") == "ND", "false").otherwise("true"))
                          ).select("ord", "chrono", "coord", "radius")


# ------------------------------------------------------------------ §2.8 geo
@query("haversine_km", f"select ord, round({d.haversine('lat', 'lon', '50.0', '40.0')}, 6) as km from fx_sections where lat is not null")
def _(v):
    return v.sections.filter("lat is not null").select(
        "ord", F.round(g.haversine_km(F.col("lat"), F.col("lon"), F.lit(50.0), F.lit(40.0)), 6).alias("km"))


@query("planar_m", f"select ord, round({d.planar('lat', 'lon', '50.0', '40.0')}, 3) as m, round({d.planar('lat', 'lon', '50.0', '40.0', '111.32')}, 6) as km from fx_sections where lat is not null")
def _(v):
    a = (F.col("lat"), F.col("lon"), F.lit(50.0), F.lit(40.0))
    return v.sections.filter("lat is not null").select("ord", F.round(g.planar_m(*a), 3).alias("m"),
                                                       F.round(g.planar_m(*a, metres=111.32), 6).alias("km"))


_DIRS = ["север", "юг", "восток", "северо-восток", "юго-запад", "нет"]
_DX = {k: vocab.DIRECTIONS[k] for k in _DIRS}


def _dcase(i):
    return "case " + " ".join(f"when direction = '{k}' then cast({w[i]} as double)" for k, w in _DX.items()) + " else 0.0 end"


_OFF = """(select ord, lat, lon, case ord % 6 when 0 then 'север' when 1 then 'юг' when 2 then 'восток' when 3 then 'северо-восток' when 4 then 'юго-запад' else 'нет' end as direction,
  cast(case when ord % 6 = 5 then 0 else ord % 20 end as double) as km, case ord % 3 when 0 then 'у северной окраины села' when 1 then 'near the western outskirts' else 'близ села' end as phrase from fx_sections where lat is not null)"""


@query("offset_point", f"""
select ord, round(lat + dy * km / 111.32, 5) as lat, round(lon + dx * km / (111.32 * cos(radians(lat))), 5) as lon, cast(1500 + km * 100 as bigint) as accuracy from
 (select ord, lat, lon, case when still then ey else dy end as dy, case when still then ex else dx end as dx, case when still then 1.0 else km end as km from
  (select *, km = 0 and dy = 0 and dx = 0 and ey is not null as still from
   (select ord, lat, lon, km, {_dcase(0)} as dy, {_dcase(1)} as dx, case ord % 3 when 0 then 1.0 when 1 then 0.0 end as ey, case ord % 3 when 0 then 0.0 when 1 then -1.0 end as ex from {_OFF} x)))""")
def _(v):
    return v.sql(f"select * from {_OFF} x").select("ord", g.offset_point(
        F.col("lat"), F.col("lon"), F.col("direction"), F.col("km"), F.col("phrase")).alias("p")).select("ord", "p.*")


@query("direction_of_outskirts", "select ord, case ord % 3 when 0 then 1.0::double when 1 then 0.0::double end as dy, case ord % 3 when 0 then 0.0::double when 1 then -1.0::double end as dx from fx_sections where lat is not null")
def _(v):
    return v.sql(f"select * from {_OFF} x").select("ord", g.direction_of_outskirts("phrase").alias("p")).select("ord", "p.*")


@query("marker_key", f"select ord, {d.marker_key('lat', 'lon')} as marker, replace({d.marker_key('lat', 'lon')}, ',', '') as file from fx_sections where lat is not null")
def _(v):
    k = g.marker_key(F.col("lat"), F.col("lon"))
    return v.sections.filter("lat is not null").select("ord", k.alias("marker"), g.storage_key(k).alias("file"))


@query("split_marker_key", """
select ord, array_to_string(list_transform(list_filter(list_transform(generate_series(2, length(k) - 3), lambda c: {'a': case when regexp_matches(left(k, c), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') then try_cast(left(k, c) as double) end, 'b': case when regexp_matches(substring(k, c + 1), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') then try_cast(substring(k, c + 1) as double) end}),
  lambda p: p.a between 35 and 82 and p.b between 19 and 180), lambda p: cast(p.a as varchar) || ',' || cast(p.b as varchar)), '|') as cuts from (select ord, concat(lat_text, lon_text) as k from fx_marker_points)""")
def _(v):
    cuts = g.split_marker_key(F.concat("lat_text", "lon_text"))
    return v.marker_points.select("ord", _join(F.transform(cuts, lambda p: F.concat(
        p["lat"].cast("string"), F.lit(","), p["lon"].cast("string")))).alias("cuts"))


@query("coords_from_comment", """
select ord, try_cast(regexp_extract(comment, '(-?\\d{2}\\.\\d{3,})\\s*[,;]\\s*(-?\\d{1,3}\\.\\d{3,})', 1) as double) as lat, try_cast(regexp_extract(comment, '(-?\\d{2}\\.\\d{3,})\\s*[,;]\\s*(-?\\d{1,3}\\.\\d{3,})', 2) as double) as lon from fx_corrections""")
def _(v):
    return v.corrections.select("ord", g.coords_from_comment("comment").alias("p")).select("ord", "p.lat", "p.lon")


@query("bbox_of_vertices", "select slug, page, n, cast(x0 as bigint) as x0, y0, cast(x1 as bigint) as x1, y1 from fx_scan_lines")
def _(v):
    def p(x, y):
        return F.struct(F.col(x).cast("string").alias("x"), F.col(y).cast("string").alias("y"))
    vs = F.array(p("x0", "y0"), p("x1", "y0"), p("x1", "y1"), p("x0", "y1"))
    return v.scan_lines.select("slug", "page", F.col("n").cast("bigint").alias("n"), g.bbox_of_vertices(vs).alias("b")).select(
        "slug", "page", "n", *[F.col(f"b.{c}").cast("bigint").alias(c) for c in ("x0", "y0", "x1", "y1")])


# ------------------------------------------------------------------ §2.8 web text
@query("html_list_items", f"""
select doc_id, 'doc-' || cast(doc_id as varchar) as slug, case doc_id % 4 when 0 then 'Лёссы и погребенные почвы' when 1 then 'Конодонты девона' when 2 then 'Разрез, скважина, мощность аллювия' else 'Экономика' end as title,
  {d.strip(d.squash("regexp_replace(text, '<[^>]+>', ' ', 'g')"))} as abstract, '2020 / A' as meta from documents
union all select doc_id, 'x-' || cast(doc_id as varchar), 'Юрские отложения', 'т', 'm' from documents""")
def _(v):
    return v.listing_html.select("doc_id", F.explode(t.html_list_items(F.col("html"))).alias("i")).select("doc_id", "i.*")


@query("strip_tags_html", f"select page_id, {d.strip(d.squash(chr(114)))} as text from (select page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') as r from pages)")
def _(v):
    return v.table("pages").select("page_id", t.strip_html(F.col("html")).alias("text"))


_ART = d.strip(d.squash("regexp_replace(substring(html, position('itemprop=\"articleBody\"' in html) + 22), '<[^>]+>', ' ', 'g')"))


@query("html_article", f"select page_id, 'T' || cast(page_id as varchar) as title, 'A|B' as authors, '' as year, {_ART} as text from fx_article_html")
def _(v):
    return v.article_html.select("page_id", t.html_article(F.col("html")).alias("a")).select(
        "page_id", "a.title", _join(F.col("a.authors")).alias("authors"), "a.year", "a.text")


@query("chunk_text", f"""
select doc_id, cast(i as int) as idx, part from (select doc_id, i, substring(text, i * 5000 + 1, 5000) as part from documents, generate_series(0, 100000) g(i) where i * 5000 < length(text))
where length({d.strip('part')}) > 200""")
def _(v):
    return v.table("documents").select("doc_id", F.explode(t.chunk_text(F.col("text"))).alias("c")).select(
        "doc_id", "c.idx", F.col("c.text").alias("part"))


def _halves(e):
    half = f"cast(floor(length({e}) / 2) as bigint)"
    back = f"strpos(reverse(left({e}, {half})), chr(10))"
    cut = f"case when {back} > 0 and {half} - {back} > 0 then {half} - {back} else {half} end"
    return f"case when length({e}) < 900 then [{e}] else [left({e}, {cut}), substring({e}, {cut} + 1)] end"


@query("split_on_line", f"select doc_id, cast(len(p) as int) as n, array_to_string(p, '¶') as parts from (select doc_id, flatten(list_transform({_halves('text')}, lambda x: {_halves('x')})) as p from documents)")
def _(v):
    p = t.split_deep(F.col("text"))
    return v.table("documents").select("doc_id", F.size(p).alias("n"), F.array_join(p, "¶").alias("parts"))


@query("stable_job_id", "select path, 'cl-' || left(md5(path), 12) as job from fx_catalog")
def _(v):
    return v.catalog.select("path", t.stable_job_id("path").alias("job"))

