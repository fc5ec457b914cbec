"""Operators with an exact plan for hot groups, against brute force."""

import math
import random

from pyspark.sql import functions as F

from stratloom.operators import links, places, sections, tools


def planar(a, b, c, d, m=111320.0):
    return math.hypot((c - a) * m, (d - b) * m * math.cos(math.radians(a)))


def points(rng, k, spread):
    return [(i, f"p{i % 5}", round(50 + rng.random() * spread, 5), round(40 + rng.random() * spread, 5)) for i in range(k)]


def test_too_close_anti(spark):
    rng = random.Random(1)
    new = points(rng, 400, 0.05)
    new += [(1000 + k, "dup", new[k][2], new[k][3]) for k in range(200)]          # copies of earlier points
    rng.shuffle(new)
    new = [(i, *r[1:]) for i, r in enumerate(new)]
    old = points(rng, 10, 0.05)
    kept = []
    for i, _, la, lo in new:
        if all(planar(la, lo, a, b) >= 300 for _, _, a, b in old) and all(planar(la, lo, a, b) >= 300 for _, a, b in kept):
            kept.append((i, la, lo))
    schema = "ord int, name string, lat double, lon double"
    got = places.too_close_anti(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema)).select("ord").collect()
    assert sorted(r.ord for r in got) == [k[0] for k in kept]


def test_too_close_far_north(spark):
    rng = random.Random(2)
    new = [(i, "x", round(80 + rng.random() * 0.02, 5), round(100 + rng.random() * 0.1, 5)) for i in range(200)]
    kept = []
    for i, _, la, lo in new:
        if all(planar(la, lo, a, b) >= 300 for _, a, b in kept):
            kept.append((i, la, lo))
    schema = "ord int, name string, lat double, lon double"
    got = places.too_close_anti(spark.createDataFrame(new, schema), spark.createDataFrame([], schema)).select("ord").collect()
    assert sorted(r.ord for r in got) == [k[0] for k in kept]


def test_snap_distance(spark):
    rng = random.Random(4)
    schema = "ord int, name string, lat double, lon double"
    new, old = points(rng, 150, 0.02), points(rng, 150, 0.02)
    got = {r.ord: (r.lat, r.lon) for r in places.snap_to_existing(
        spark.createDataFrame(new, schema), spark.createDataFrame(old, schema)).collect()}
    for i, name, la, lo in new:
        same = sorted((planar(la, lo, a, b), o, a, b) for o, nm, a, b in old if nm == name and planar(la, lo, a, b) < 300)
        near = sorted((planar(la, lo, a, b), o, a, b) for o, nm, a, b in old if planar(la, lo, a, b) < 150)
        want = (same or near or [(0, 0, la, lo)])[0][2:]
        assert got[i] == want


def test_ordinal_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i * 7919 % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(8)
    got = tools.ordinal(df, ["k"], ["v"], "i", total="n").collect()
    byk = {}
    for k, v in rows:
        byk.setdefault(k, []).append(v)
    assert len(got) == 5000
    assert all(r.i == sorted(byk[r.k]).index(r.v) and r.n == len(byk[r.k]) for r in got[:400])


def test_order_independence(spark):
    """Sections do not depend on how the records are partitioned."""
    from stratloom.registry.core import Views
    raw = Views(spark, "/root/testdata/sf0.001").raw_records
    hot = raw.withColumn("nearest_locality", F.when(F.col("doc_no") % 3 == 0, "Красный Яр").otherwise(F.col("nearest_locality")))
    a = sections.consolidate_v2(hot.repartition(1)).collect()
    b = sections.consolidate_v2(hot.repartition(13)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_evidence_pages_by_construction(spark):
    """Pages have words of their own, so the page of a quote and how it is found are known."""
    pages, quotes, want = [], [], {}
    for pub, n in (("hot", 60), ("p1", 7), ("p2", 1)):
        for i in range(n):
            own = [f"слово{pub}{i}номер{k}" for k in range(30)]
            pages.append((pub, i, i, " ".join(own)))
            quotes += [(pub, " ".join(own[4:16]).upper()), (pub, "; ".join(own[20:27][::-1])), (pub, own[3][:9])]
            want[pub, quotes[-3][1]] = (i + 1, "exact")
            want[pub, quotes[-2][1]] = (i + 1, "fuzzy")  # the order is another: only the words agree
        quotes += [(pub, "ничего похожего здесь нигде не напечатано"), (pub, ""), (pub, None)]
    got = {(r.publication, r.evidence): (r.page, r.method) for r in links.evidence_page_join(
        spark.createDataFrame(quotes, "publication string, evidence string"),
        spark.createDataFrame(pages, "publication string, idx long, ord long, text string")).collect()}
    assert got == want


def test_ordinal_with_null_keys(spark):
    rows = [(None, 3), (None, 1), ("a", 2), (None, 2)]
    got = tools.ordinal(spark.createDataFrame(rows, "k string, v int"), ["k"], ["v"], "i", total="n").collect()
    assert sorted((str(r.k), r.v, r.i, r.n) for r in got) == [("None", 1, 0, 3), ("None", 2, 1, 3), ("None", 3, 2, 3), ("a", 2, 0, 1)]


def test_melt_keeps_order_of_long_lists(spark):
    long = [f"v{(i * 7919) % 6000:04d}" for i in range(6000)]
    df = spark.createDataFrame([("a", 1, long)], "k string, ord int, x array<string>")
    melted = tools.melt_values(df, ["k"], {"x": F.col("x")}, inner_order=True)
    assert melted.groupBy("k").agg(tools.values_seen("x").alias("x")).first().x == long


def test_too_close_on_a_line(spark):
    """Numbered along a line 250 m apart, every second point is accepted."""
    step = 250 / 111320.0
    schema = "ord int, name string, lat double, lon double"
    new = spark.createDataFrame([(i, "x", 50 + i * step, 40.0) for i in range(24)], schema)
    got = places.too_close_anti(new, spark.createDataFrame([], schema)).select("ord").collect()
    assert sorted(r.ord for r in got) == list(range(0, 24, 2))
    assert places.too_close_anti(new.filter("false"), new).count() == 0


def _chain(n):
    return [(i, "j", f"Пункт {i}", "часть другого объекта", f"Пункт {i - 1}" if i else "Разрез", "", 0.0, "нет", "", 50.0 if i == 0 else None, 40.0 if i == 0 else None, 1500 if i == 0 else None) for i in range(n)]


SUB = "ord int, job_id string, name string, relation string, parent string, anchor string, offset_km double, direction string, why string, lat double, lon double, accuracy long"


def test_hierarchy_of_nine_levels(spark):
    from stratloom.operators import hierarchy
    placed = hierarchy.hierarchy_placement(spark.createDataFrame(_chain(9), SUB))
    assert placed.filter("lat is null").count() == 0
    roots = {r.ord: r.root for r in hierarchy.hierarchy_root(placed).collect()}
    assert set(roots.values()) == {"разрез"} and len(roots) == 9


def test_hierarchy_in_a_circle(spark):
    from stratloom.operators import hierarchy
    rows = [(1, "j", "А", "часть другого объекта", "Б", "", 0.0, "нет", "", 50.0, 40.0, 1), (2, "j", "Б", "часть другого объекта", "В", "", 0.0, "нет", "", 50.0, 40.0, 1),
            (3, "j", "В", "часть другого объекта", "А", "", 0.0, "нет", "", 50.0, 40.0, 1), (4, "j", "Г", "часть другого объекта", "Г", "", 0.0, "нет", "", 50.0, 40.0, 1)]
    assert {r.root for r in hierarchy.hierarchy_root(spark.createDataFrame(rows, SUB).withColumn("inherited_from", F.lit(None).cast("string"))).collect()} == {""}


def test_aligned_join_sees_duplicates(spark):
    import pytest
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "ID string, p string")
    b = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "z")], "ID string, q string")
    assert sections.aligned_join(a, b.filter("q <> 'z'")).count() == 2
    with pytest.raises(sections.MisalignedError):
        sections.aligned_join(a, b)


def test_ambiguous_names_uncut(spark):
    rows = [("А", "place", "village", 50.0, 40.0 + i / 1000, i) for i in range(20)] + [("А", "place", "village", 60.0, 90.0, 99), ("Б", "place", "village", 50.0, 40.0, 1)]
    gaz = spark.createDataFrame(rows, "name string, class string, type string, lat double, lon double, rank int")
    assert [r.name for r in places.ambiguous_names(gaz).collect()] == ["А"]
