"""Literal cases and properties of column functions."""

import random

from pyspark.sql import functions as F

from stratloom.functions import geo as g
from stratloom.functions import numbers as n
from stratloom.functions import text as t
from stratloom.functions.python import nfd_strip
from stratloom.operators.crawl import snippets
from stratloom.operators.records import weighted_cycle


def values(spark, rows, column, typ="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {typ}")
    return [r[1] for r in df.select("i", column(F.col("x"))).orderBy("i").collect()]


def test_parse_num(spark):
    rows = ["до 5 м", "свыше 3", "120 см", "2–4", "1,200", "до 5, свыше 3", "ND", "5 смена", "додо 7", None, "-"]
    got = [tuple(r) for r in values(spark, rows, n.parse_num)]
    assert got == [(None, 5), (3, None), (1.2, 1.2), (2, 4), (1.2, 1.2), (3, None), (None, None), (5, 5), (7, 7),
                   (None, None), (None, None)]


def test_parse_joined(spark):
    assert tuple(values(spark, ["2.24; 0.77–0.99"], n.parse_joined)[0]) == (0.77, 2.24)


def test_clean_thickness(spark):
    rows = ["0–2024", "0.5–10000", "12–40", "1974", "5; 1999; 7,5", "ND", ", 2000, 3"]
    assert values(spark, rows, lambda c: n.clean_thickness(c, 300)) == ["0", "0.5", "12–40", "ND", "5; 7,5", "ND", ", 3"]


def test_fmt_g(spark):
    rng = random.Random(5)
    rows = [0.0, 1.0, 12.5, 1250.125, 0.0001, 0.00001, 1e6, 999999.5, 123456.5, -2.5, 1e-7, 116.9845, 144.2685, 1e15]
    rows += [round(rng.uniform(0, 10 ** rng.randint(-5, 7)), rng.randint(0, 8)) for _ in range(3000)]
    rows += [rng.randint(10 ** 6, 10 ** 7) / 10 ** rng.randint(0, 9) for _ in range(3000)]
    assert values(spark, rows, n.fmt_g, "double") == [f"{x:g}" for x in rows]


def test_names(spark):
    assert values(spark, ["Костенки I", "с. Борщево-3", "Ям"], lambda c: F.array_join(t.name_variants(c), "|")) == [
        "Костенки I|Костенки", "с. Борщево-3|Борщево-3|Борщево", ""]
    assert values(spark, ["с.  Красный   Яр .", "Городище"], t.norm_locality) == ["Красный Яр", "Городище"]
    assert values(spark, ["Десне", "Окой"], lambda c: F.array_join(t.river_variants(c), "|")) == ["Десне|Десна|Десня", "Окой|Окоа|Окоя|Ока"]
    assert values(spark, ["Site 1", "OT-22V", "Отказное", "скв. 5"], t.is_internal_label) == [True, True, False, False]


def test_natural_order(spark):
    df = spark.createDataFrame([("IMG_10.jpg",), ("img_9.jpg",), ("IMG_09b.jpg",)], "x string")
    assert [r.x for r in df.orderBy(t.natural_key("x"), "x").collect()] == ["img_9.jpg", "IMG_09b.jpg", "IMG_10.jpg"]


def test_working_ids(spark):
    df = spark.createDataFrame([(["скв. 1974 и скв. I", "расчистка 217", "расчистки 217, шурф 9/96, Site 2"],)], "q array<string>")
    assert df.select(t.working_ids(F.col("q"))).first()[0] == ["скв. I", "расчистка 217", "шурф 9/96", "Site 2"]


def test_marks(spark):
    rows = ["Отка́зное", "Ёж Йод", "déjà"]
    assert values(spark, rows, nfd_strip) == ["Отказное", "Еж Иод", "deja"]
    assert values(spark, rows[:2], t.strip_marks) == ["Отказное", "Еж Иод"]


def test_split_on_line(spark):
    text = "a" * 400 + "\n" + "b" * 800
    parts = values(spark, [text, "короткий"], lambda c: F.array_join(t.split_on_line(c), "¶"))
    assert parts == [text[:400] + "¶" + text[400:], "короткий"]


def test_snippets(spark):
    gap = "ё" * 60
    rows = [(gap + "Отказное" + gap + "ОТКАЗНОЕ" + gap, "Отказное", [gap[:50] + "Отказное" + gap[:42], gap[:50] + "ОТКАЗНОЕ" + gap[:42]]),
            ("отказное" + gap, "Отказное", ["отказное" + gap[:42]]),
            (" ".join(["Отказное"] * 9), "Отказное", None),
            (gap + "Отказн" + gap, "Отказное-2", [gap[:50] + "Отказн" + gap[:44]]), ("ничего", "Отказное", []), ("ничего", "", [])]
    df = spark.createDataFrame([r[:2] for r in rows], "text string, name string")
    got = {(r.text, r.name): r.snippets for r in snippets(df, pad=50).collect()}
    assert all(got[a, b] == want for a, b, want in rows if want is not None)
    assert len(got[rows[2][:2]]) == 4


def test_natural_order_of_long_numbers(spark):
    long = ["p" + "9" * 24 + "8", "p" + "9" * 24 + "9", "p" + "9" * 22, "p0000000000000000000000000001", "p1" + "0" * 25]
    df = spark.createDataFrame([(x,) for x in long], "x string")
    assert [r.x for r in df.orderBy(t.natural_key("x")).collect()] == [long[3], long[2], long[0], long[1], long[4]]


def test_cycle_and_keys(spark):
    assert weighted_cycle("a:3,b:1") == ["a", "b", "a", "a"]
    key = spark.range(1).select(g.marker_key(F.lit(43.316635), F.lit(43.605317)).alias("k")).first().k
    assert key == "43.316635,43.605317"
    cuts = spark.range(1).select(g.split_marker_key(F.lit("43.31663543.605317")).alias("c")).first().c
    assert (43.316635, 43.605317) in [tuple(c) for c in cuts]
