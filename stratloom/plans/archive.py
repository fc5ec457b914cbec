"""Archive batch: page texts and stored responses → sections → located sections → map dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..operators import links, markers, places, records, sections, tools
from ..sources import readers, writers


@dataclass
class Lookups:
    """Tables that stand for the outside services."""

    gazetteer: DataFrame
    areas: DataFrame
    waterways: DataFrame


def extract(spark: SparkSession, pages_root: str, responses: DataFrame, runs: list[str] | None = None) -> DataFrame:
    """Gated pages with their stored responses → flat records with a numeric position.

    ``responses``: path, idx, content.
    """
    pages = records.dedupe_pages(records.keep_text_pages(readers.read_ocr_pages(spark, pages_root, runs)))
    parsed = records.ingest_responses(responses.select(F.col("path").alias("doc"), "idx", "content"))
    counts = parsed.select(F.col("doc").alias("path"), "idx", F.size("records").cast("bigint").alias("n_rec"))
    _, kept = records.relevance_gate(pages, counts)
    rows = kept.join(parsed.withColumnRenamed("doc", "path"), ["path", "idx"])
    flat = records.flatten_records(rows.select("path", "idx", "records").withColumn("records", F.col("records")))
    return tools.ordinal(flat, [], ["path", "pos", *vocab.RAW_COLUMNS[1:3]], "ord")


def locate(secs: DataFrame, look: Lookups) -> DataFrame:
    """Sections → lat, lon, loc_confidence: look-up, region check, confidence."""
    keyed = secs.withColumn("name", F.trim("nearest_locality")).withColumn(
        "admin", F.when(F.col("administrative_unit").isin("ND", "None"), "").otherwise(F.col("administrative_unit")))
    from ..functions.text import skip_geocode_foreign
    found = places.geocode_join(keyed, look.gazetteer)
    skip = skip_geocode_foreign(F.col("name"))
    located = found.withColumn("lat", F.when(~skip, F.col("found.lat"))).withColumn("lon", F.when(~skip, F.col("found.lon"))).drop("found")
    fixed = places.homonym_region_fix(located, look.gazetteer).drop("outcome", "region")
    conf = places.location_confidence(fixed, places.ambiguous_names(look.gazetteer))
    return conf.withColumn("lat", F.round("lat", 5)).withColumn("lon", F.round("lon", 5)).drop("name", "admin")


def _apply(secs: DataFrame, fixes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace columns of the rows a repair stage returns."""
    f = fixes.select("ord", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = secs.join(f, "ord", "left")
    for c in columns:
        j = j.withColumn(c, F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)))
    return j.drop("_hit", *[f"_{c}" for c in columns])


def repair(secs: DataFrame, look: Lookups) -> DataFrame:
    """Namesakes, contradicted regions, contradicted rivers, implausible thicknesses; a table between stages."""
    point = ["lat", "lon", "loc_confidence"]
    secs = tools.materialise(_apply(secs, places.homonym_plan_apply(secs, look.gazetteer), point))
    secs = tools.materialise(_apply(secs, places.context_region_fix(secs, look.areas, look.gazetteer), [*point, "administrative_unit"]))
    secs = tools.materialise(_apply(secs, places.river_basin_fix(secs, look.waterways, look.gazetteer), point))
    return sections.clean_thickness_columns(secs)


def archive_batch(spark: SparkSession, pages_root: str, responses: DataFrame, look: Lookups, out: str) -> DataFrame:
    """Run the batch and write master, page links and map dataset under ``out``; returns the master."""
    raw = tools.materialise(extract(spark, pages_root, responses))
    secs = tools.materialise(sections.consolidate_v2(raw))
    master = repair(tools.materialise(locate(secs, look)), look)
    writers.write_table(master, f"{out}/master")
    master = readers.read_table(spark, f"{out}/master")
    pages = readers.read_ocr_pages(spark, pages_root)
    from ..functions.text import basename
    named = pages.withColumn("publication", basename("path"))
    writers.write_page_links(links.page_links(master, named), f"{out}/page_links")
    rec = markers.marker_records(master)
    m = tools.materialise(markers.build_markers(rec))
    writers.write_marker_dataset(m, rec, markers.facet_categories(m), markers.dataset_summary(m), f"{out}/map")
    return master
