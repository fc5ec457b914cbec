"""Lists of markers: order of fixed and other tags, and what a plan leaves out."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from stratloom.operators import markers as m


def sections(spark, rows):
    """Sections at one place: (ord, deposits, quotes)."""
    cells = {c: F.lit("ND") for c in ("administrative_unit", "excavation_type", "geomorphic_position", "deposit_raw_terms", "thickness_studied", "thickness_visible",
                                      "thickness_borehole_depth", "thickness_unspecified", "elevation_min_m", "elevation_max_m", "stratigraphic_position", "dating_methods")}
    df = spark.createDataFrame([(*r, 50.0, 40.0) for r in rows], "ord long, type_of_deposits string, evidence string, lat double, lon double")
    return df.withColumns({**cells, "nearest_locality": F.lit("Яр"), "source_kinds": F.lit("prose"), "sources": F.lit("a.pdf"), "n_sources": F.lit(1), "loc_confidence": F.lit("ok")})


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_fixed_and_other_tags_keep_their_order(spark):
    rows = [(2, "till; abc; loess", "q2"), (1, "loess; zzz; abc; paleosol", "q1"), (3, "ND", "q3")]
    b = m.build_markers(m.marker_records(sections(spark, rows))).first()
    assert b.deposit_type == ["loess", "zzz", "abc", "paleosol", "till", "ND"]
    assert b.dating_method == ["ND"] and b.chronological_data == ["No"] and b.source_kinds == ["prose"]


def test_long_lists_of_quotes_keep_their_order(spark):
    quotes = [f"q{(i * 7919) % 3000:04d}" for i in range(3000)]
    rec = m.marker_records(sections(spark, [(1, "loess", " || ".join(quotes))]))
    assert m.build_markers(rec).first().quotes == quotes
    assert m.collate_objects(rec).first().quotes.split("\n") == quotes


def test_lists_nobody_asks_for_are_not_made(spark):
    b = m.build_markers(m.marker_records(sections(spark, [(1, "loess", "q1")])))
    assert "Generate" not in plan(b.select("marker", "source_count"))
    assert "Generate" not in plan(m.dataset_summary(b))


def test_lists_are_made_without_sorting_the_rows(spark):
    rec = m.marker_records(sections(spark, [(1, "loess", "q1")]))
    for df in (m.build_markers(rec), m.collate_objects(rec), m.publication_thickness(rec)):
        assert "SortAggregate" not in plan(df)
