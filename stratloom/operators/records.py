"""Pages, extraction responses and nested records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas, vocab
from ..functions import text as t
from ..functions.common import not_missing, strip
from . import tools


# ---------------------------------------------------------------- pages
def keep_text_pages(pages: DataFrame, n: int = 200) -> DataFrame:
    return pages.filter(F.length(strip("text")) > n)


def dedupe_pages(pages: DataFrame) -> DataFrame:
    """One text per (path, idx): the one seen first."""
    return tools.first_rows(pages, ["path", "idx"], [F.col("ord")])


def page_ordinal(pages: DataFrame) -> DataFrame:
    """0-based position ``i`` of a page in its document and page count ``n``; the text does not travel."""
    return tools.ordinal(pages.select("path", "idx"), ["path"], ["idx"], "i", total="n")


def page_chunks(docs: DataFrame, size: int = 20, cap: int | None = None) -> DataFrame:
    """Fixed-size page ranges [page_from, page_to) of documents with ``n_pages``."""
    n = (F.col("n_pages") if cap is None else F.least(F.col("n_pages"), F.lit(cap))).cast("int")
    starts = docs.filter("n_pages > 0").select(
        "path", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1, F.lit(size))).alias("page_from"))
    return starts.select("path", "page_from", F.least(F.col("page_from") + size, F.col("n")).alias("page_to"))


def relevance_gate(pages: DataFrame, rec_counts: DataFrame, peek: int = 15,
                   gate_min: int = 1) -> tuple[DataFrame, DataFrame]:
    """Probe long documents and skip the rest of those whose probe has too few records.

    A document of more than ``peek + 5`` pages is probed on its first ``peek`` pages and the pages at one
    half and three quarters. Returns document flags and the pages to extract.
    """
    pos = page_ordinal(pages)
    i, n = F.col("i"), F.col("n")
    half, late = F.floor(n / 2), F.floor(n * 3 / 4)
    # a middle page that is also among the first ones is probed twice, and its records count twice
    weight = (i < peek).cast("int") + (i == half).cast("int") + (i == late).cast("int")
    pos = pos.withColumn("long", n > peek + 5).withColumn("weight", F.when(n > peek + 5, weight).otherwise(1))
    counted = pos.join(rec_counts.groupBy("path", "idx").agg(F.sum("n_rec").alias("n_rec")), ["path", "idx"], "left")
    docs = counted.groupBy("path").agg(
        F.max("n").alias("n_pages"), F.max("long").alias("long"),
        F.sum(F.coalesce("n_rec", F.lit(0)) * F.col("weight")).alias("probe_records"))
    skipped = F.col("long") & (F.col("probe_records") < gate_min)
    docs = docs.select("path", "n_pages", F.when(F.col("long"), F.col("probe_records")).alias("probe_records"),
                       skipped.alias("skipped"),
                       F.when(skipped, F.lit(peek + 2)).otherwise(F.col("n_pages")).cast("bigint").alias("n_extracted"))
    kept = pos.join(docs.select("path", "skipped"), "path").filter(~F.col("skipped") | (F.col("weight") > 0))
    return docs, kept.select("path", "idx")


def weighted_cycle(spec: str) -> list[str]:
    """"a:3,b:1" → interleaved labels a, b, a, a."""
    left = {name: int(w or 1) for name, _, w in (part.partition(":") for part in spec.split(","))}
    rounds = range(max(left.values()))
    return [name for k in rounds for name, w in left.items() if k < w]


def weighted_assignment(pages: DataFrame, spec: str, order: list[str]) -> DataFrame:
    """Give pages to labels in weighted round-robin."""
    cycle = weighted_cycle(spec)
    labels = F.array(*[F.lit(x) for x in cycle])
    numbered = tools.ordinal(pages, [], order, "_pos")
    return numbered.withColumn("label", F.get(labels, (F.col("_pos") % len(cycle)).cast("int"))).drop("_pos")


# ---------------------------------------------------------------- responses
def ingest_responses(responses: DataFrame) -> DataFrame:
    """(doc, idx, content) → (doc, idx, records, ok): cut or invalid JSON gives no records."""
    parsed = F.from_json("content", schemas.RESPONSE, {"mode": "PERMISSIVE"})
    out = responses.withColumn("_r", parsed["records"])
    ok = F.col("content").isNotNull() & (F.col("content") != "") & F.col("_r").isNotNull()
    return out.select("doc", "idx", F.coalesce("_r", F.array().cast(f"array<{schemas.RECORD}>")).alias("records"),
                      ok.alias("ok"))


def extract_hook(pages: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a user function to batches of pages; Spark partitions the work and streams the batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return pages.mapInPandas(run, schema)


def responses_of(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """Default extraction: stored responses of the gated pages."""
    return pages.join(responses, ["path", "idx"], "left")


# ---------------------------------------------------------------- documents
def best_doc_version(docs: DataFrame) -> DataFrame:
    """One result per path: most records, first on ties; failed results drop out afterwards."""
    best = tools.first_rows(docs, ["path"], [F.coalesce("n_records", F.lit(0)).desc(), F.col("ord")])
    return best.filter(F.col("error").isNull()) if "error" in docs.columns else best


def flatten_records(docs: DataFrame) -> DataFrame:
    """Nested records → the flat record table (18 text columns)."""
    r = docs.select("path", F.posexplode("records").alias("pos", "r"))
    cell, ev = t.unwrap_cell, t.evidence_cell
    cols = {
        "source_file": t.basename_slash("path"),
        "nearest_locality": cell(F.col("r.nearest_locality.value")),
        "administrative_unit": cell(F.col("r.administrative_unit.value")),
        "excavation_type": cell(F.col("r.excavation_type.value")),
        "geomorphic_position": cell(F.col("r.geomorphic_position.value")),
        "type_of_deposits": cell(F.col("r.type_of_deposits.value"), True),
        "deposit_raw_terms": cell(F.col("r.deposit_raw_terms.value"), True),
        **{f"thickness_{k}": t.thickness_by_kind(F.col("r.thickness"), k) for k in vocab.THICKNESS_KINDS},
        "absolute_elevation_m": cell(F.col("r.absolute_elevation_m.value")),
        "stratigraphic_position": cell(F.col("r.stratigraphic_position.value"), True),
        "dating_methods": cell(F.col("r.dating_methods.value"), True),
        "source_kind": cell(F.col("r.source_kind")),
        "evidence_locality": ev(F.col("r.nearest_locality.evidence")),
        "evidence_deposit": ev(F.col("r.type_of_deposits.evidence")),
        "evidence_geomorph": ev(F.col("r.geomorphic_position.evidence"))}
    return r.select("path", "pos", *[t.scrub_control_chars(c).alias(name) for name, c in cols.items()])


def doc_site_summary(recs: DataFrame, cap: int | None = None) -> DataFrame:
    """(path, n_records, n_sites, sites): distinct places of a document by name, the first ``cap`` if given."""
    sites = recs.groupBy("path", "nearest_locality").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("nearest_locality").isNotNull() & ~F.col("nearest_locality").isin("ND", "")
    counts = sites.groupBy("path").agg(F.sum("n").alias("n_records"), F.count_if(named).alias("n_sites"))
    listed = tools.first_rows(sites.filter(named), ["path"], [F.col("nearest_locality")], cap)
    listed = listed.groupBy("path").agg(F.sort_array(F.collect_list("nearest_locality")).alias("sites"))
    return counts.join(listed, "path", "left").withColumn(
        "sites", F.coalesce("sites", F.array().cast("array<string>")))


def extraction_measures(docs: DataFrame) -> DataFrame:
    sums = docs.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_pages").alias("pages"),
                    F.sum("n_records").alias("records"), F.sum("tokens").alias("tokens"))
    return sums.withColumn("tokens_per_page", F.try_divide("tokens", "pages")).withColumn(
        "records_per_page", F.try_divide("records", "pages"))


def top_docs(docs: DataFrame, by: str = "n_records", k: int = 40, tie: str = "path") -> DataFrame:
    return docs.orderBy(F.col(by).desc(), tie).limit(k)


# ---------------------------------------------------------------- contracts
def _outside(c: Column, allowed: list[str]) -> Column:
    return F.size(F.array_except(F.coalesce(c, F.array().cast("array<string>")),
                                 F.array(*[F.lit(a) for a in allowed]))) > 0


def record_rules(c: Callable[[str], Column]) -> dict[str, Column]:
    """Rule name → violated? ``c`` gives a field: lists as arrays, the rest as text."""
    return {
        "type_of_deposits": _outside(c("type_of_deposits"), vocab.DEPOSITS),
        "stratigraphic_position": _outside(c("stratigraphic_position"), vocab.AGES),
        "dating_methods": _outside(c("dating_methods"), vocab.DATING),
        "excavation_type": ~F.coalesce(c("excavation_type"), F.lit("?")).isin(vocab.EXCAVATIONS),
        "source_kind": ~F.coalesce(c("source_kind"), F.lit("?")).isin(vocab.SOURCE_KINDS),
        "nearest_locality": ~F.coalesce(not_missing(c("nearest_locality")), F.lit(False))}


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(ok, bad): ``problems`` of a bad row names the rules it breaks."""
    problems = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    marked = df.withColumn("problems", problems)
    return marked.filter(F.size("problems") == 0).drop("problems"), marked.filter(F.size("problems") > 0)


def validate_review(df: DataFrame, verdicts: list[str]) -> tuple[DataFrame, DataFrame]:
    """Reviewer entries: known verdicts only."""
    entries = df.withColumn("comment", F.coalesce("comment", F.lit(""))).withColumn(
        "reviewer", F.coalesce("reviewer", F.lit("anon"))).withColumn("verdict", F.lower("verdict"))
    return validate(entries, {"verdict": ~F.coalesce(F.col("verdict"), F.lit("?")).isin(verdicts)})


def path_filter(df: DataFrame, text: str | None = None, only: list[str] | None = None) -> DataFrame:
    """Paths containing a text, and/or publications whose file name holds one of ``only``.

    Uploaded runs always pass the publication filter: their names are job ids.
    """
    import re
    if text:
        df = df.filter(F.contains(F.lower("path"), F.lit(text.lower())))
    if only:
        starts = [re.sub(r"\s+", "_", re.sub(r"\s+", " ", name.strip().lower())) for name in only]
        name = F.regexp_replace(F.lower(t.basename_slash("path")), r"\s+", "_")
        hit = F.exists(F.array(*[F.lit(s) for s in starts]), lambda s: F.contains(name, s))
        df = df.filter((F.col("run") == "upload") | hit)
    return df


def union_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """Pages of several runs under one ``run`` column."""
    out = None
    for name, df in runs.items():
        tagged = df.withColumn("run", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def resume_anti(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose output does not exist yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")
