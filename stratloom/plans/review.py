"""Uploads and crawl: jobs → proposals → decisions → merged and republished map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crawl, jobs, markers, places, tools
from ..sources import readers, writers
from ..streaming.jobs import MergeSink, run_once


class GuardError(RuntimeError):
    """The new version lost too many markers to be published."""


def proposals_with_points(recs: DataFrame, gaz: DataFrame) -> DataFrame:
    """Grouped proposals with a coordinate: with the admin unit, then by the bare name, then by shorter names."""
    p = jobs.build_proposals(recs).withColumn("name", F.col("locality")).withColumn(
        "admin", F.when(F.col("admin") == "ND", "").otherwise(F.col("admin")))
    first = places.geocode_with_fallback(p, gaz).withColumnRenamed("note", "_n1").withColumnRenamed("found", "_f1")
    both = places.geocode_ladder(first, gaz)
    pick = F.coalesce("_f1", "found")
    return both.withColumn("lat", pick["lat"]).withColumn("lon", pick["lon"]).withColumn(
        "geo_note", F.coalesce("_n1", F.when(F.col("_f1").isNull(), F.col("note")))).withColumn(
        "admin", F.when(F.col("admin") == "", "ND").otherwise(F.col("admin"))).drop("_f1", "_n1", "found", "note", "name")


def merge_reviewed(spark: SparkSession, accepted_stream: DataFrame, status: DataFrame, master: str, ledger: str,
                   checkpoint: str) -> None:
    """Merge a stream of accepted proposals into the master table, each (job, i) once."""
    run_once(accepted_stream, MergeSink(spark, master, ledger, lambda rows: jobs.master_rows(rows, status)), checkpoint)


def publish(spark: SparkSession, master: str, current: str, target: str, keep: float = 0.9, heights: DataFrame | None = None,
            compute_height=None, links: DataFrame | None = None, figures: DataFrame | None = None) -> DataFrame:
    """Rebuild the map dataset from the master and write it unless it lost more than a tenth of its markers.

    ``heights`` (lat, lon, v) holds what earlier runs computed: ``compute_height`` is asked for new coordinates
    alone, and the table with them is written beside the map. ``links`` and ``figures`` are keyed by marker.
    """
    rec = markers.marker_records(readers.read_table(spark, master))
    new, known = markers.build_markers(rec), None
    if heights is not None:
        known = tools.materialise(jobs.incremental_enrich(rec, heights, compute_height))
        at = known.select(F.col("lat").alias("lat5"), F.col("lon").alias("lon5"), "v")
        points = places.sidecar_join(rec.select("marker", "lat", "lon").distinct(), at, at.limit(0)).select("marker", "elev_dem")
        new = markers.enrich_markers(new, points, links, figures)
    elif links is not None or figures is not None:
        new = markers.enrich_markers(new, None, links, figures)
    new = tools.materialise(new)
    prev = spark.read.json(f"{current}/markers") if current else new.limit(0)
    verdict = jobs.publish_guard(new, prev, keep).first()
    if not verdict["publish"]:
        raise GuardError(f"{verdict['new_markers']} markers against {verdict['old_markers']} published")
    writers.write_marker_dataset(new, rec, markers.facet_categories(new), markers.dataset_summary(new), target)
    if known is not None:
        writers.write_table(known, f"{target}/heights")
    return new


def restore_orphans(corr: DataFrame, markers_now: DataFrame, moved: DataFrame) -> DataFrame:
    """Corrections with those of vanished markers added to the marker they belong to.

    ``markers_now``: marker, marker_key, name, lat, lon; ``moved``: marker_key, to. An added entry says where
    it comes from (``movedFrom``) and how its target was found (``origin``); repeated runs add nothing.
    """
    orphans = jobs.orphan_corrections(corr, markers_now.select("marker_key"))
    found = jobs.orphan_resolve(orphans, moved, markers_now).filter("target is not null")
    add = orphans.join(found, "marker_key").withColumn("movedFrom", F.col("marker_key")).withColumn("origin", F.col("why")).withColumn(
        "marker_key", F.col("target")).drop("target", "why")
    return jobs.append_corrections_dedup(corr, add)


def crawl_step(listing: DataFrame, articles: DataFrame, known: DataFrame, base_url: str = "") -> tuple[DataFrame, DataFrame]:
    return crawl.crawl_to_jobs(crawl.listing_items(listing), articles, known, base_url)
