"""Pages, documents, consolidation, customer table and viewer."""

from pyspark.sql import functions as F

from .. import vocab
from ..functions import text as t
from ..operators import records as r
from ..operators import sections as s
from ..operators import tools
from ..operators import viewer as w
from ..sources import readers, writers
from . import duck as d
from .core import query


def nested_docs(v):
    """One extraction result per order: its lines as nested records. Orders are small by nature.

    The lines travel as flat columns and are nested where their order is put together: nested fields take about twice the bytes.
    """
    def record(x):
        def f(c, quote=None, many=False):
            value = t.split_tags(x[c]) if many else F.when(x[c] != "ND", x[c])
            return F.struct(value.alias("value"), (x[quote] if quote else F.lit("")).alias("evidence")).alias(c)

        def th(kind):
            return F.struct(F.lit(kind).alias("kind"), x[f"thickness_{kind}"].alias("value_m"), F.lit("").alias("evidence"))

        return F.struct(
            f("nearest_locality", "evidence_locality"), f("administrative_unit"), f("excavation_type"),
            f("geomorphic_position", "evidence_geomorph"), f("deposit_raw_terms", many=True),
            f("type_of_deposits", "evidence_deposit", True), F.array(*[th(k) for k in vocab.THICKNESS_KINDS]).alias("thickness"),
            f("absolute_elevation_m"), f("stratigraphic_position", many=True), f("dating_methods", many=True),
            x["source_kind"].alias("source_kind"))

    raw = v.raw_records.drop("source_file")
    docs = raw.groupBy("doc_no").agg(F.collect_list(F.struct(*[c for c in raw.columns if c != "doc_no"])).alias("z"))
    nested = F.sort_array(F.transform("z", lambda x: F.struct(x["ord"].alias("ord"), record(x).alias("r"))))
    return tools.once(docs, "records", F.transform(nested, lambda x: x["r"])).select(
        "doc_no", F.format_string("/архив/том %d.pdf", "doc_no").alias("path"), "records")


def _docs(sql_extra=""):
    return ("(select doc_no, concat('/архив/том ', cast(floor(doc_no / 3) as bigint), '.pdf') as path, count(*) as n_records "
            f"from fx_raw_records group by doc_no {sql_extra})")


# ------------------------------------------------------------------ pages
@query("scan_ocr_pages", "select run, path, idx, text from (select run, path, cast(idx as int) as idx, text from fx_doc_pages)")
def _(v):
    pages = v.doc_pages
    chunks = pages.groupBy("run", "path", F.floor(F.col("idx") / 20).alias("c")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "text"))).alias("pages"))
    out = tools.scratch_path(v.spark, "ocr")
    chunks.select("run", "path", F.col("c").cast("int").alias("page_from"), F.size("pages").alias("n_pages"),
                  F.size("pages").alias("n_kept"), "pages").write.partitionBy("run").json(out)
    return readers.read_ocr_pages(v.spark, out, multi_line=False).select("run", "path", "idx", "text")


@query("keep_text_pages", f"select path, idx from fx_doc_pages where length({d.strip('text')}) > 200")
def _(v):
    return r.keep_text_pages(v.doc_pages).select("path", "idx")


@query("dedupe_pages", """
select path, idx, text from (select *, row_number() over (partition by path, idx order by ord) as rn from
  (select path, floor(idx / 2) as idx, ord, text from fx_doc_pages)) where rn = 1""")
def _(v):
    return r.dedupe_pages(v.sql("select path, cast(floor(idx / 2) as double) as idx, ord, text from fx_doc_pages")).select("path", "idx", "text")


@query("page_ordinal", """
select publication as path, idx, row_number() over (partition by publication order by idx) - 1 as i, count(*) over (partition by publication) as n from fx_pages""")
def _(v):
    return r.page_ordinal(v.pages.withColumnRenamed("publication", "path"))


@query("page_chunks", """
select path, cast(g as int) as page_from, cast(least(g + 20, n) as int) as page_to from (select path, n_pages as n from (select path, size / 1000 as n_pages from fx_catalog)), generate_series(0, (select max(size) / 1000 from fx_catalog)::bigint, 20) t(g) where g < n""")
def _(v):
    return r.page_chunks(v.sql("select path, cast(size / 1000 as bigint) as n_pages from fx_catalog"))


_GATE = """
with p as (select path, idx, i, n, (case when n > 20 then cast(i < 15 as int) + cast(i = floor(n / 2) as int) + cast(i = floor(n * 3 / 4) as int) else 1 end) as weight, coalesce(q, 0) as q from
  (select path, idx, row_number() over (partition by path order by idx) - 1 as i, count(*) over (partition by path) as n, quality as q from fx_doc_pages left join labels on idx = doc_id)),
 docs as (select path, max(n) as n_pages, sum(q * weight) as probe from p group by path)"""


@query("relevance_gate", _GATE + """
select path, n_pages, case when n_pages > 20 then cast(probe as bigint) end as probe_records, n_pages > 20 and probe < 3 as skipped,
 cast(case when n_pages > 20 and probe < 3 then 17 else n_pages end as bigint) as n_extracted from docs""")
def _(v):
    return r.relevance_gate(v.doc_pages, _rec_counts(v), gate_min=3)[0]


@query("relevance_gate_pages", _GATE + """
select p.path, p.idx from p join docs using (path) where not (n_pages > 20 and probe < 3) or weight > 0""")
def _(v):
    return r.relevance_gate(v.doc_pages, _rec_counts(v), gate_min=3)[1]


def _rec_counts(v):
    return v.doc_pages.select("path", "idx").join(v.table("labels"), F.col("idx") == F.col("doc_id")).select(
        "path", "idx", F.col("quality").cast("bigint").alias("n_rec"))


@query("path_filter", "select path, idx, run from fx_doc_pages where contains(lower(path), 'том 3') or run = 'source1'")
def _(v):
    pages = v.doc_pages
    hit = r.path_filter(pages, text="Том 3")
    return hit.unionByName(pages.filter("run = 'source1'")).select("path", "idx", "run").distinct()


@query("union_runs", "select 'arch' as run, path, idx from fx_doc_pages union all select 'img', path, idx from fx_doc_pages")
def _(v):
    p = v.doc_pages.select("path", "idx")
    return r.union_runs({"arch": p, "img": p}).select("run", "path", "idx")


@query("resume_anti", "select path, idx from fx_doc_pages where idx not in (select doc_id from labels)")
def _(v):
    return r.resume_anti(v.doc_pages.select("path", "idx"), v.table("labels").withColumnRenamed("doc_id", "idx"), ["idx"]).select("path", "idx")


@query("weighted_assignment", "select doc_id, case (row_number() over (order by doc_id) - 1) % 4 when 1 then 'b' else 'a' end as label from documents")
def _(v):
    return r.weighted_assignment(v.table("documents").select("doc_id"), "a:3,b:1", ["doc_id"])


# ------------------------------------------------------------------ responses and documents
@query("ingest_responses", """
select doc_no as doc, case when doc_no % 5 = 0 or doc_no % 7 = 0 then 0 else count(*) end as n_records, not (doc_no % 5 = 0 or doc_no % 7 = 0) as ok from fx_raw_records group by doc_no""")
def _(v):
    text = F.to_json(F.struct("records"))
    content = F.when(F.col("doc_no") % 7 == 0, None).when(
        F.col("doc_no") % 5 == 0, F.substr(text, F.lit(1), F.length(text) - 9)).otherwise(text)
    resp = nested_docs(v).select(F.col("doc_no").alias("doc"), F.lit(0).alias("idx"), content.alias("content"))
    return r.ingest_responses(resp).select("doc", F.size("records").cast("bigint").alias("n_records"), "ok")


@query("scan_doc_results", f"select path, cast(sum(n_records) as bigint) as n_records, count(*) as n_files from {_docs()} x group by path")
def _(v):
    out = tools.scratch_path(v.spark, "docs")
    docs = nested_docs(v).select(F.concat(F.lit("/архив/том "), F.floor(F.col("doc_no") / 3).cast("string"), F.lit(".pdf")).alias("path"),
                                 F.size("records").alias("n_records"), "records")
    docs.write.option("compression", "gzip").json(out)
    back = readers.read_doc_results(v.spark, out, multi_line=False)
    return back.groupBy("path").agg(F.sum(F.size("records")).alias("n_records"), F.count(F.lit(1)).alias("n_files"))


@query("best_doc_version", f"select path, n_records, doc_no from (select *, row_number() over (partition by path order by n_records desc, doc_no) as rn from {_docs()} x) where rn = 1 and doc_no % 11 <> 0")
def _(v):
    docs = nested_docs(v).select("doc_no", F.col("doc_no").alias("ord"), F.size("records").cast("bigint").alias("n_records"), "records",
                                 F.concat(F.lit("/архив/том "), F.floor(F.col("doc_no") / 3).cast("string"), F.lit(".pdf")).alias("path"),
                                 F.when(F.col("doc_no") % 11 == 0, "broken").alias("error"))
    return r.best_doc_version(docs).select("path", "n_records", "doc_no")


def _flat(c, sep="'; '"):
    lst = d.split_tags(c)
    lst = f"list_filter({lst}, lambda z, i: list_position({lst}, z) = i)"
    return f"array_to_string({lst}, {sep}) as {c}"


@query("flatten_records", f"""
select concat('том ', cast(doc_no as varchar), '.pdf') as source_file, nearest_locality, administrative_unit, excavation_type, geomorphic_position, {_flat('type_of_deposits')},
  {_flat('deposit_raw_terms')}, thickness_studied, thickness_visible, thickness_borehole_depth, thickness_unspecified, absolute_elevation_m, {_flat('stratigraphic_position')}, {_flat('dating_methods')},
  source_kind, evidence_locality, evidence_deposit, evidence_geomorph from fx_raw_records""")
def _(v):
    return r.flatten_records(nested_docs(v)).drop("path", "pos")


@query("doc_site_summary", """
with x as (select concat('/архив/том ', cast(doc_no as varchar), '.pdf') as path, nearest_locality as l from fx_raw_records)
select path, count(*) as n_records, count(distinct case when l not in ('ND', '') then l end) as n_sites, coalesce(array_to_string(list_sort(list_distinct(list(l) filter (l not in ('ND', '')))), '|'), '') as sites from x group by path""")
def _(v):
    recs = v.sql("select concat('/архив/том ', cast(doc_no as varchar(20)), '.pdf') as path, nearest_locality from fx_raw_records")
    return r.doc_site_summary(recs).withColumn("sites", F.array_join("sites", "|"))


@query("extraction_measures", """
select count(*) as docs, cast(sum(size / 1000) as bigint) as pages, cast(sum(len) as bigint) as records, cast(sum(size) as bigint) as tokens, sum(size) / sum(size / 1000) as tokens_per_page, sum(len) / sum(size / 1000) as records_per_page
from (select size, length(path) as len from fx_catalog)""")
def _(v):
    return r.extraction_measures(v.sql("select cast(size / 1000 as bigint) as n_pages, cast(length(path) as bigint) as n_records, size as tokens from fx_catalog"))


@query("top_docs", f"select path, n_records from (select concat('том ', cast(doc_no as varchar)) as path, count(*) as n_records from fx_raw_records group by doc_no) order by n_records desc, path limit 40")
def _(v):
    docs = v.sql("select concat('том ', cast(doc_no as varchar(20))) as path, count(*) as n_records from fx_raw_records group by doc_no")
    return r.top_docs(docs)


@query("validate_record", f"""
select ord, concat_ws('|', case when excavation_type not in ('outcrop', 'borehole', 'pit', 'trench', 'clearing', 'quarry', 'unspecified') then 'excavation_type' end, case when nearest_locality = 'ND' then 'nearest_locality' end) as problems
from fx_raw_records where excavation_type = 'ND' or nearest_locality = 'ND'""")
def _(v):
    many = {"type_of_deposits", "stratigraphic_position", "dating_methods"}
    rules = r.record_rules(lambda c: t.split_tags(c) if c in many else F.col(c))
    return r.validate(v.raw_records, rules)[1].select("ord", F.array_join("problems", "|").alias("problems"))


@query("validate_review", "select ord, case when verdict in ('correct', 'partial') then 'ok' else 'bad' end as state, comment from fx_corrections")
def _(v):
    ok, bad = r.validate_review(v.corrections, ["correct", "partial"])
    return ok.select("ord", F.lit("ok").alias("state"), "comment").unionByName(bad.select("ord", F.lit("bad").alias("state"), "comment"))


# ------------------------------------------------------------------ consolidation
def _dom(words):
    return f"""(select *, lower(loc) as lk, lower(adm) as ak from (select *, {d.norm_locality('nearest_locality')} as loc, {d.norm_admin('administrative_unit')} as adm from fx_raw_records where nearest_locality not in ('ND', '', 'None'))
  where not (regexp_matches(loc, '[A-Za-z]') or {d.any_word('lower(loc)', words)}))"""


def _tagset(c, name):
    return f"coalesce(nullif(array_to_string(list_sort(list_distinct(flatten(list({d.split_tags(c)})))), '; '), ''), 'ND') as {name}"


_TH = ""
for _k in vocab.THICKNESS_KINDS:
    _lo, _hi = d.joined_lo_hi(f"thickness_{_k}")
    _TH += f", min({_lo}) as {_k}_lo, max({_hi}) as {_k}_hi"
_EL = d.num_lo_hi("absolute_elevation_m")
_CONS2 = f"""
select min(ord) as ord, first(loc order by ord, loc) as nearest_locality, first(adm order by ord, adm) as administrative_unit,
  coalesce(nullif(array_to_string(list_sort(list_distinct(list(excavation_type) filter (excavation_type not in ('ND', '', 'unspecified', 'None')))), '; '), ''), 'ND') as excavation_type,
  list(geomorphic_position order by ord, geomorphic_position) filter (geomorphic_position not in ('ND', '')) as geo, list(evidence_locality order by ord, evidence_locality) as ev,
  {_tagset('type_of_deposits', 'type_of_deposits')}, {_tagset('deposit_raw_terms', 'deposit_raw_terms')}, {_tagset('stratigraphic_position', 'stratigraphic_position')}, {_tagset('dating_methods', 'dating_methods')},
  {_tagset('source_kind', 'source_kinds')}, count(*) as n_records, count(distinct source_file) as n_sources, array_to_string(list_sort(list_distinct(list(source_file))), ' | ') as sources,
  min({_EL[0]}) as el_lo, max({_EL[1]}) as el_hi {_TH} from {_dom(vocab.FOREIGN_NAMES)} d group by lk, ak"""


def _uniq(c, sep):
    return f"coalesce(nullif(array_to_string(list_filter({c}, lambda z, i: list_position({c}, z) = i), {d.q(sep)}), ''), 'ND')"


@query("consolidate_v2", f"""
select ord, nearest_locality, administrative_unit, excavation_type, {_uniq('geo', '; ')} as geomorphic_position, type_of_deposits, deposit_raw_terms,
 {', '.join(d.fmt_range(k + '_lo', k + '_hi') + ' as thickness_' + k for k in vocab.THICKNESS_KINDS)},
 coalesce(cast(el_lo as varchar), 'ND') as elevation_min_m, coalesce(cast(el_hi as varchar), 'ND') as elevation_max_m, stratigraphic_position, dating_methods, source_kinds, n_records, n_sources, sources,
 {_uniq('ev', ' || ')} as evidence from ({_CONS2})""")
def _(v):
    return s.consolidate_v2(v.raw_records)


_TH1 = d.num_lo_hi("thickness_studied")
_CONS1 = f"""
select min(ord) as ord, last(loc order by ord, loc) as nearest_locality, last(adm order by ord, adm) as administrative_unit,
 coalesce(cast(round(least(min({_TH1[0]}), min({_TH1[1]})), 2) as varchar), 'ND') as thickness_min_m, coalesce(cast(round(greatest(max({_TH1[0]}), max({_TH1[1]})), 2) as varchar), 'ND') as thickness_max_m,
 coalesce(cast(round(min({_EL[0]}), 2) as varchar), 'ND') as elevation_min_m, coalesce(cast(round(max({_EL[1]}), 2) as varchar), 'ND') as elevation_max_m,
 array_to_string(list_sort(list_distinct(flatten(list({d.split_tags('type_of_deposits')})))), '; ') as type_of_deposits,
 array_to_string(list_transform(list_sort(list_transform(list_distinct(flatten(list({d.split_tags('stratigraphic_position')}))), lambda z: {{'p': case z when 'Lower Pleistocene' then 1 when 'Middle Pleistocene' then 2 when 'Upper Pleistocene' then 3 when 'Holocene' then 4 else 9 end, 'v': z}})), lambda z: z.v), '; ') as stratigraphic_position,
 array_to_string(list_sort(list_distinct(flatten(list({d.split_tags('dating_methods')})))), '; ') as dating_methods, count(*) as n_records, count(distinct source_file) as n_sources,
 array_to_string(list_sort(list_distinct(list(source_file))), ' | ') as sources, array_to_string(list(evidence_locality order by ord, evidence_locality), ' || ') as evidence
from {_dom(vocab.FOREIGN_NAMES_V1)} d group by lk, ak"""


@query("consolidate_v1", _CONS1)
def _(v):
    return s.consolidate_v1(v.raw_records)


@query("order_by_support", "select ord, n_records from fx_sections")
def _(v):
    return s.order_by_support(v.sections).select("ord", "n_records")


@query("clean_thickness_columns", """
select ord, thickness_studied from fx_sections""")
def _(v):
    return s.clean_thickness_columns(v.sections).select("ord", "thickness_studied")


# ------------------------------------------------------------------ customer table
_GOLD_IN = ("(select ord + 1 as row_id, nearest_locality, administrative_unit, type_of_deposits, stratigraphic_position, dating_methods, n_sources, sources, evidence, lat, lon, "
            "thickness_visible as thickness_min_m, thickness_visible as thickness_max_m, elevation_min_m, elevation_max_m from fx_sections)")


def _nd(e):
    return f"case when lower({d.strip(e)}) in ('none', 'nan', '', 'nd', 'no data', 'null') then 'ND' else {d.strip(e)} end"


def _gold_sql(extra="", where=""):
    src = d.split_list("sources", "|")
    el = "case when elevation_min_m = 'ND' then 'ND' when elevation_min_m = elevation_max_m then elevation_min_m else elevation_min_m || '–' || elevation_max_m end"
    cells = ["row_id", "lat", "lon", "cast(case when lat is not null then 5000 end as int)", "thickness_min_m", el, "'ND'", "'ND'", "'ND'",
             _nd("nearest_locality"), _nd("nearest_locality"), _nd("administrative_unit"), _nd("type_of_deposits"), _nd("stratigraphic_position"),
             "case when dating_methods in ('', 'ND') then 'No' else 'Yes' end", _nd("dating_methods"), "'ND'", "'ND'", "'ND'", "'ND'", "'ND'"]
    for k in range(1, 5):
        cells += [f"coalesce({src}[{k}], 'ND')", "'ND'"]
    cells += ["'ND'", f"'консолидировано из ' || cast(n_sources as varchar) || ' источн.; ' || evidence", "'auto-extraction'"]
    return "select " + ", ".join(f'{c} as "{n}"' for c, n in zip(cells, vocab.GOLD_COLUMNS)) + f"{extra} from {_GOLD_IN} z {where}"


@query("gold_projection", _gold_sql())
def _(v):
    return s.gold_projection(v.sql(f"select * from {_GOLD_IN} z"))


@query("write_results_csv", "select cast(row_id as varchar) as id, cast(lat as varchar) as lat, sources, cast(n_sources as varchar) as n_sources from (select row_id, lat, " + d.split_list("sources", "|") + f"[1] as sources, n_sources from {_GOLD_IN} z where lat is not null)")
def _(v):
    out = tools.scratch_path(v.spark, "results")
    src = v.sql(f"select * from {_GOLD_IN} z")
    writers.write_results_csv(src, out)
    back = readers.read_results_csv(v.spark, out, vocab.GOLD_COLUMNS + ["n_sources"])
    return back.select(F.col("ID").alias("id"), F.col("N").alias("lat"), F.col("`Publication 1`").alias("sources"), "n_sources")


@query("scan_results_csv", "select cast(ord as varchar) as ord, evidence from fx_sections")
def _(v):
    out = tools.scratch_path(v.spark, "csv")
    v.sections.select(F.col("ord").cast("string").alias("ord"), "evidence").write.option("header", True).csv(out)
    return readers.read_results_csv(v.spark, out, ["ord", "evidence"])


@query("scan_records_table", "select ord, nearest_locality, evidence from fx_sections")
def _(v):
    out = tools.scratch_path(v.spark, "master")
    writers.write_table(v.sections, out)
    return readers.read_table(v.spark, out).select("ord", "nearest_locality", "evidence")


@query("header_rename", 'select lat, lon, "Thickness, m" as thickness, "Administrative unit" as region, "Publication 1" as pub from (select "N" as lat, "E" as lon, * from (' + _gold_sql() + "))")
def _(v):
    gold = s.gold_projection(v.sql(f"select * from {_GOLD_IN} z"))
    return w.header_rename(gold).select("lat", "lon", "thickness", "region", "pub")


def _tier_sql():
    nd = lambda c: f"\"{c}\" in ('', 'ND', 'No', 'None')"
    geo = '"N" is not null'
    rich = f"not {nd('Thickness, m')} and not {nd('Dating method')} and not {nd('Stratigraphic position')}"
    data = f"not {nd('Type of deposits')} and not {nd('Stratigraphic position')}"
    return (f"select \"ID\" as id, n_sources, case when {geo} and (n_sources >= 2 or ({rich})) then 'A' when {geo} then 'B' when {data} then 'C' else 'D' end as tier "
            "from (" + _gold_sql(", cast(n_sources as int) as n_sources") + ")")


def _tiers(v):
    return s.confidence_tier(s.gold_projection(v.sql(f"select * from {_GOLD_IN} z"), with_n_sources=True))


@query("confidence_tier", _tier_sql())
def _(v):
    return _tiers(v).select(F.col("ID").alias("id"), "n_sources", F.col("confidence_tier").alias("tier"))


@query("tier_counts", f"select tier as confidence_tier, count(*) as n from ({_tier_sql()}) group by tier")
def _(v):
    return s.tier_counts(_tiers(v))


@query("write_delivery", f"select id, tier, tier = 'A' as core from ({_tier_sql()})")
def _(v):
    out = tools.scratch_path(v.spark, "delivery")
    tiers = _tiers(v)
    plain = tiers.toDF(*[c.replace(" ", "_").replace(",", "").replace("(", "").replace(")", "") for c in tiers.columns])
    writers.write_delivery(plain, s.split_foreign(v.raw_records)[1], out)
    core = writers.read_core(v.spark, out).select("ID", F.lit(True).alias("core"))
    return v.spark.read.parquet(f"{out}/full").join(core, "ID", "left").select(
        F.col("ID").alias("id"), F.col("confidence_tier").alias("tier"), F.coalesce("core", F.lit(False)).alias("core"))


@query("aligned_join", "select row_id as \"ID\", n_sources, evidence from " + _GOLD_IN + " z")
def _(v):
    src = v.sql(f"select * from {_GOLD_IN} z").withColumnRenamed("row_id", "ID")
    return s.aligned_join(src.select("ID", "n_sources"), src.select("ID", "evidence"))


@query("export_filtered_csv", "select cast(ord as varchar) as ord, sources from fx_sections")
def _(v):
    out = tools.scratch_path(v.spark, "export")
    writers.export_filtered_csv(v.sections, ["ord", "no_such_column", "sources"], out)
    return v.spark.read.option("header", True).schema("ord string, sources string").csv(out)


# ------------------------------------------------------------------ viewer
_VIEW = "(select ord, administrative_unit as region, type_of_deposits as deposits, case when ord % 6 = 0 then null else n_records * 500 end as radius_m, n_sources, lat, lon, case when dating_methods = 'ND' then 'No' else 'Yes' end as chrono from fx_sections)"


@query("viewer_filter", f"""
select ord from {_VIEW} x where region in ('NATION_3', 'NATION_7', 'NATION_11', '') and (deposits = 'ND' or list_has_any({d.split_tags('deposits')}, ['till', 'paleosol'])) and (radius_m is null or radius_m in (500, 1500, 4000)) and n_sources >= 2""")
def _(v):
    return w.viewer_filter(v.sql(f"select * from {_VIEW} x"), ["NATION_3", "NATION_7", "NATION_11", ""], ["till", "paleosol"], [500, 1500, 4000], 2).select("ord")


@query("map_filter", f"select ord, region from {_VIEW} x where n_sources >= 3 and region = 'NATION_3'")
def _(v):
    return w.map_filter(v.sql(f"select * from {_VIEW} x"), 3, "NATION_3").select("ord", "region")


@query("facet_counts", f"select value, count(*) as n from (select unnest({d.split_tags('deposits')}) as value from {_VIEW} x) group by value")
def _(v):
    return w.facet_counts(v.sql(f"select * from {_VIEW} x"), "deposits", ";", None)


@query("facet_counts_region", f"select region as value, count(*) as n from {_VIEW} x where region not in ('', 'ND') group by region order by n desc, value limit 30")
def _(v):
    return w.facet_counts(v.sql(f"select * from {_VIEW} x"), "region")


@query("kpi_metrics", f"select count(*) as total, count(lat) as with_coordinates, count(*) filter (chrono = 'Yes') as with_dating, max(n_sources) as max_sources from {_VIEW} x")
def _(v):
    return w.kpi_metrics(v.sql(f"select * from {_VIEW} x"))


@query("category_colour", f"select ord, region, (dense_rank() over (order by region) - 1) % 12 as slot from {_VIEW} x")
def _(v):
    return w.category_colour(v.sql(f"select * from {_VIEW} x"), "region").select("ord", "region", F.col("slot").alias("slot"))


@query("same_point_records", "select s.ord, s.lat, s.lon from fx_sections s where s.lat = (select max(lat) from fx_sections) and s.lon = (select min(lon) from fx_sections where lat = (select max(lat) from fx_sections))")
def _(v):
    sec = v.sections
    top = sec.agg(F.max_by(F.struct("lat", "lon"), F.struct("lat", -F.col("lon"))).alias("p")).first()["p"]
    return w.same_point_records(sec, top["lat"], top["lon"]).select("ord", "lat", "lon")


@query("sequential_id", "select ord, row_number() over (order by ord) as id from fx_sections where lat is not null")
def _(v):
    return tools.ordinal(v.sections.filter("lat is not null").select("ord"), [], ["ord"], "id", start=1)


@query("ordered_capped_unique", f"""
select doc_no, array_to_string(list_filter(l, lambda z, i: list_position(l, z) = i)[1:3], '|') as vals from (select doc_no, list(geomorphic_position || type_of_deposits order by ord, geomorphic_position || type_of_deposits) filter (geomorphic_position <> 'ND') as l from fx_raw_records group by doc_no) where l is not null""")
def _(v):
    val = F.when(F.col("geomorphic_position") != "ND", F.concat("geomorphic_position", "type_of_deposits"))
    m = tools.keep_first(tools.melt_values(v.raw_records, ["doc_no"], {"x": tools.one_or_none(val)}), ["doc_no"], 3)
    return m.groupBy("doc_no").agg(tools.values_seen("x", 3).alias("vals")).withColumn("vals", F.array_join("vals", "|"))


@query("first_non_null", "select doc_no, first(administrative_unit order by ord, administrative_unit) filter (administrative_unit <> 'ND') as adm from fx_raw_records group by doc_no")
def _(v):
    adm = F.when(F.col("administrative_unit") != "ND", F.col("administrative_unit"))
    return v.raw_records.groupBy("doc_no").agg(F.min(F.when(adm.isNotNull(), F.struct(F.col("ord"), adm.alias("v"))))["v"].alias("adm"))


@query("source_overlap", f"""
select ord, list_has_any(a, b) as overlap, array_to_string(list_filter(a, lambda z: not list_contains(b, z)), '|') as only_a from (select ord, {d.split_list('sources', '|')} as a, {d.split_list("concat('Кавказский сборник.djvu | ', nearest_locality)", '|')} as b from fx_sections)""")
def _(v):
    a = t.split_sources("sources")
    b = t.split_sources(F.concat(F.lit("Кавказский сборник.djvu | "), "nearest_locality"))
    return v.sections.select("ord", F.arrays_overlap(a, b).alias("overlap"), F.array_join(F.array_except(a, b), "|").alias("only_a"))

