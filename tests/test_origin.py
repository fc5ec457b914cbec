"""Domestic and foreign records are told apart in one pass, and as by the plain test on the name."""

from pyspark.sql import functions as F

from stratloom import vocab
from stratloom.functions import text as t
from stratloom.operators import sections as s
from stratloom.registry import all_queries
from tests.test_marker_lists import plan


def test_query_reads_its_records_once(spark):
    text = plan(all_queries()["split_foreign"](spark, "/root/testdata/sf0.001"))
    assert text.count("lineitem.parquet") == 1


def test_origin_equals_the_plain_test(spark):
    names = ["Яр", "Lake", "КИТАЙСКИЙ Яр", "г. Бор", "ND", None, "", *[f"у {w.upper()} 3" for w in vocab.FOREIGN_NAMES]]
    raw = spark.createDataFrame([(i, v, "Тамбовская") for i, v in enumerate(names)], "ord int, nearest_locality string, administrative_unit string")
    got = {r.ord: r.foreign for r in s.with_origin(raw).collect()}
    rows = raw.filter("nearest_locality not in ('ND', '')")
    assert got == {r.ord: r.f for r in rows.select("ord", t.is_foreign(t.norm_locality(F.col("nearest_locality"))).alias("f")).collect()}
    dom, intl = s.split_foreign(raw)
    assert {r.ord for r in intl.collect()} == {i for i, f in got.items() if f} and dom.count() == sum(not f for f in got.values())
