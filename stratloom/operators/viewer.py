"""Table viewer: headers, filters, facets, key figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.common import strip

# header rules in order, first match wins: (kind of test, words, canonical name) — fixed values
HEADER_RULES = [
    ("is", ["n"], "lat"), ("is", ["e"], "lon"), ("has", ["accuracy"], "radius_m"),
    ("has", ["name of geographic"], "feature"), ("has", ["nearest locality"], "locality"),
    ("has", ["administrative unit"], "region"), ("has", ["thickness"], "thickness"),
    ("has", ["absolute elevation"], "elevation"), ("has", ["type of excavation"], "excavation"),
    ("has", ["type of deposits"], "deposits"), ("has", ["stratigraphic position"], "strat"),
    ("has", ["chro", "available"], "chrono"), ("is", ["dating method"], "dating"),
    ("has", ["publication 1"], "pub"), ("has", ["doi / link 1"], "doi"), ("is", ["comments"], "comments")]


def header_rename(df: DataFrame) -> DataFrame:
    """Map arbitrary headers to canonical names by equality or substring; unknown headers stay."""
    def rule(name: str) -> str:
        low = name.lower()
        for kind, parts, target in HEADER_RULES:
            if low == parts[0] if kind == "is" else all(p in low for p in parts):
                return target
        return name

    return df.toDF(*[rule(c) for c in df.columns])


def display_values(df: DataFrame) -> DataFrame:
    """Chronology as Yes/No/ND, coordinate and radius as text."""
    return df.withColumn("chrono", t.display_chrono(F.col("chrono_raw"))).withColumn(
        "coord", F.when(F.col("lat").isNotNull(), F.format_string("%.5f, %.5f", "lat", "lon")).otherwise("ND")
    ).withColumn("radius", F.when(F.col("radius_m").isNotNull(), F.concat(
        F.col("radius_m").cast("bigint").cast("string"), F.lit(" м"))).otherwise("ND"))


def viewer_filter(df: DataFrame, regions: list[str] | None = None, deposits: list[str] | None = None,
                  radii: list[int] | None = None, min_sources: int = 1,
                  sources: list[str] | None = None) -> DataFrame:
    """Interactive selection; a missing radius and an ND deposit always pass their filter."""
    if regions is not None:
        df = df.filter(F.col("region").isin(regions))
    if sources is not None:
        df = df.filter(F.arrays_overlap(F.col("src_list"), F.array(*[F.lit(s) for s in sources])))
    if deposits is not None:
        tokens = F.transform(F.split("deposits", ";"), strip)
        df = df.filter(F.arrays_overlap(tokens, F.array(*[F.lit(x) for x in deposits]))
                       | (strip("deposits") == "ND"))
    if radii is not None:
        df = df.filter(F.col("radius_m").isin(radii) | F.col("radius_m").isNull())
    return df.filter(F.col("n_sources") >= min_sources)


def map_filter(df: DataFrame, min_sources: int = 1, region: str = "all") -> DataFrame:
    df = df.filter(F.col("n_sources") >= min_sources)
    return df if region == "all" else df.filter(F.col("region") == region)


def facet_counts(df: DataFrame, column: str, sep: str | None = None, k: int | None = 30) -> DataFrame:
    """Value counts of a column, ND removed, most frequent first."""
    value = F.explode(F.split(column, sep)) if sep else F.col(column)
    rows = df.select(value.alias("value")).select(strip("value").alias("value"))
    out = rows.filter(~F.col("value").isin("ND", "")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    out = out.orderBy(F.desc("n"), "value")
    return out.limit(k) if k else out


def kpi_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count("lat").alias("with_coordinates"),
                  F.count_if(F.col("chrono") == "Yes").alias("with_dating"),
                  F.max("n_sources").alias("max_sources"))


def category_colour(df: DataFrame, column: str, slots: int = 12) -> DataFrame:
    """Palette slot of each value: its rank among the distinct values, modulo the palette size."""
    from .tools import ordinal
    vals = df.select(F.coalesce(F.col(column), F.lit("ND")).alias(column)).distinct()
    ranked = ordinal(vals, [], [column], "_rank")
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("ND"))).join(
        ranked, column).withColumn("slot", F.col("_rank") % slots).drop("_rank")


def same_point_records(df: DataFrame, lat: float, lon: float) -> DataFrame:
    """All records at one coordinate."""
    return df.filter((F.col("lat") == lat) & (F.col("lon") == lon))
