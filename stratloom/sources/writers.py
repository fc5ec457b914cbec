"""Writers: tables as Parquet, customer files as CSV, map data as JSON lines."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..operators.sections import gold_projection


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


class SchemaDrift(ValueError):
    """A table does not have the columns its contract names."""


def check_master(df: DataFrame) -> DataFrame:
    """The master table must have exactly the contract's columns."""
    if [c for c in df.columns if c in vocab.MASTER_COLUMNS] != vocab.MASTER_COLUMNS:
        raise SchemaDrift(f"expected {len(vocab.MASTER_COLUMNS)} master columns in order, got {df.columns}")
    return df


def results_rows(sections: DataFrame) -> DataFrame:
    """Located sections in customer columns plus the number of sources."""
    return gold_projection(sections.filter(F.col("lat").isNotNull()), with_n_sources=True)


def write_results_csv(sections: DataFrame, path: str) -> None:
    rows = results_rows(sections)
    rows.select([F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]).write.mode("overwrite").option(
        "header", True).option("emptyValue", "").csv(path)


def export_filtered_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """Column-subset CSV of a selection: columns the table lacks are left out."""
    df.select(filtered_columns(df, columns)).write.mode("overwrite").option("header", True).csv(path)


def filtered_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


TIER_FILES = 16  # open files of one task; of a table with more tiers the rest is sorted by Spark, which gives the same files


@contextmanager
def _open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Partitioned writes keep up to ``n`` files open instead of sorting a task's whole rows by partition first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_delivery(tiers: DataFrame, international: DataFrame, folder: str) -> None:
    """Full table partitioned by tier (the core is tier A) and the international table."""
    with _open_files(tiers.sparkSession, TIER_FILES):
        tiers.write.mode("overwrite").partitionBy("confidence_tier").parquet(f"{folder}/full")
    international.write.mode("overwrite").parquet(f"{folder}/international")


def read_core(spark, folder: str) -> DataFrame:
    """Tier A of a delivery: a partition-pruned read of the full table."""
    return spark.read.parquet(f"{folder}/full").filter(F.col("confidence_tier") == "A")


def pack_page_links(links: DataFrame) -> DataFrame:
    """(marker, src, page, approx) rows → one map entry per marker, exact sources first.

    Pages are made distinct before they are collected, so an entry holds each page once.
    """
    pages = links.groupBy("marker", "src", "page").agg(F.bool_and("approx").alias("approx"))
    per_src = pages.groupBy("marker", "src").agg(
        F.sort_array(F.collect_list("page")).alias("pages"), F.bool_and("approx").alias("approx"))
    packed = per_src.groupBy("marker").agg(F.sort_array(F.collect_list(
        F.struct("approx", "src", "pages"))).alias("links"))
    return packed.withColumn("links", F.transform("links", lambda e: F.struct(
        e["src"].alias("src"), e["pages"].alias("pages"), e["approx"].alias("approx"))))


def write_page_links(links: DataFrame, path: str) -> None:
    """One JSON object per marker and line; the files together are the page-link map."""
    packed = pack_page_links(links)
    packed.select(F.to_json(F.create_map("marker", "links")).alias("value")).write.mode("overwrite").text(path)


def write_sidecar(df: DataFrame, key: str, path: str, json_path: str | None = None) -> None:
    """Keyed Parquet; optionally also a JSON map entry per line."""
    df.write.mode("overwrite").parquet(path)
    if json_path:
        rest = [c for c in df.columns if c != key]
        df.select(F.to_json(F.create_map(F.col(key), F.struct(*rest))).alias("value")).write.mode("overwrite").text(json_path)


def write_marker_dataset(markers: DataFrame, records: DataFrame, categories: DataFrame, summary: DataFrame,
                         folder: str) -> None:
    """Markers, their records, facet values and the summary as JSON lines.

    Records are rows keyed by ``marker`` rather than an array inside the marker: a place that many
    publications describe would otherwise grow into one row that no task can hold.
    """
    for name, df in (("markers", markers), ("records", records), ("categories", categories), ("summary", summary)):
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(f"{folder}/{name}")
