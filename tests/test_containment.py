"""Names in texts, words in lists, markers nearest to lost entries: against all pairs, with one group that holds a third of the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratloom.operators import containment, hierarchy, jobs, links


def _texts(rng, k, most=14):
    """Short texts over few letters, so that many contain each other."""
    return ["".join(rng.choice("абв ") for _ in range(rng.randint(0, most))) for _ in range(k)]


def _dealt(rng, items):
    return [("hot" if i % 3 == 0 else f"g{i % 11}", x) for i, x in enumerate(items)]


def test_containing(spark):
    rng = random.Random(5)
    texts, names = _dealt(rng, _texts(rng, 600, 40)), _dealt(rng, _texts(rng, 400))
    texts += [("hot", None), ("hot", ""), (None, "аб"), ("hot", "аб" * 3000)]
    names += [("hot", None), ("hot", ""), (None, "аб"), ("hot", "аба"), ("hot", "аба")]
    got = [tuple(r) for r in containment.containing(spark.createDataFrame(texts, "g string, text string"),
                                                    spark.createDataFrame(names, "g string, name string"), ["g"]).collect()]
    want = {(g, x, y) for g, x in texts if g and x for h, y in names if h == g and y and y in x}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


def test_covered(spark):
    rng = random.Random(6)

    def lists(k):
        return _dealt(rng, [[f"w{int(rng.random() ** 2 * 30)}" for _ in range(rng.randint(0, 9))] for _ in range(k)])

    a, b = lists(500), lists(300)
    got = [(r.g, tuple(r.a), tuple(r.b)) for r in containment.covered(
        spark.createDataFrame(a, "g string, a array<string>"), spark.createDataFrame(b, "g string, b array<string>"), ["g"], "a", "b").collect()]

    def met(x, y):
        c = sum(w in y for w in x)
        return c >= 2 and c / len(x) >= 0.6

    want = {(g, tuple(x), tuple(y)) for g, x in a for h, y in b if g == h and met(x, y)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], "g string, text string")
    assert containment.containing(none, none.withColumnRenamed("text", "name"), ["g"]).count() == 0
    empty = spark.createDataFrame([], "g string, a array<string>")
    assert containment.covered(empty, empty.withColumnRenamed("a", "b"), ["g"], "a", "b").count() == 0


@pytest.mark.parametrize("compared", [0, 3, 64])
def test_lines_of_a_hot_page(spark, compared):
    rng = random.Random(7)
    words = ["разрез", "глина", "песок", "слой", "на", "у", "реки", "торф", "мощный", "бурый"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(1, n)))
    lines = [("p", 1 if i % 3 == 0 else i % 20, i, text(6)) for i in range(400)]
    quotes = [("p", 1 if i % 3 == 0 else i % 20, text(9)) for i in range(60)]
    got = links.line_highlight_join(spark.createDataFrame(lines, "slug string, page int, n int, text string"),
                                    spark.createDataFrame(quotes, "slug string, page int, phrase string"), compared).collect()

    def met(x, y):
        x = [w for w in x.split() if len(w) >= 4]
        c = sum(w in y.split() for w in x)
        return c >= 2 and c / len(x) >= 0.6

    want = {(s, p, n) for s, p, n, t in lines if len(t) >= 4 and any(
        s == u and p == v and len(q) >= 12 and (q in t or (len(t) >= 12 and t in q) or met(q, t) or met(t, q)) for u, v, q in quotes)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want and 50 < len(want) < 400


def test_anchors_of_a_hot_job(spark):
    rng = random.Random(8)
    job = lambda i: "hot" if i % 3 == 0 else f"j{i % 9}"
    sites = [(job(i), f"Якорь {rng.randint(1, 60)}", 50.0 + i, 40.0, i) for i in range(150)]
    subs = [(i, job(i + rng.randint(0, 1)), f"Шурф {i}", "часть другого объекта", "", f"у села Якорь {rng.randint(1, 99)}" if i % 2 else "",
             f"рядом якорь {rng.randint(1, 99)}" if i % 4 else "") for i in range(300)]
    got = hierarchy.anchor_resolve(
        spark.createDataFrame(subs, "ord int, job_id string, name string, relation string, parent string, anchor string, why string"),
        spark.createDataFrame(sites, "job_id string, locality string, lat double, lon double, ord int"),
        spark.createDataFrame([], "name string, lat double, lon double, rank int")).collect()
    for r in got:
        known = {}
        for j, name, la, _, o in sites:
            if j == r.job_id:
                known.setdefault(name.lower(), (o, la))
        if r.anchor:
            inside = [v for k, v in known.items() if k in r.anchor.lower()]
            want = (min(inside)[1], "phrase") if inside else (None, None)
        else:
            told = [v for k, v in known.items() if k in r.why.lower()]
            want = (told[0][1], "reason") if len(told) == 1 else (None, None)
        assert (r.base_lat, r.base_by) == want
    assert len(got) == 300 and {r.base_by for r in got} == {"phrase", "reason", None}


def test_nearest_or_only(spark):
    rng = random.Random(9)
    spots = [(f"m{i}", 50 + rng.random() * (0.02 if i % 3 == 0 else 1), 40 + rng.random() * (0.02 if i % 3 == 0 else 1)) for i in range(300)]
    spots += [("twin", *spots[5][1:])]
    keys = [(f"k{i % 120}", 50 + rng.random(), 40 + rng.random()) for i in range(150)]

    def planar(a, b, c, e):
        return math.hypot((c - a) * 111320.0, (e - b) * 111320.0 * math.cos(math.radians(a)))

    want = {}
    for k in {k for k, _, _ in keys}:
        near = sorted((planar(a, b, c, e), m) for x, a, b in keys if x == k for m, c, e in spots if planar(a, b, c, e) < 5000)
        if near and (near[0][0] < 1000 or len(near) == 1):
            want[k] = near[0][1]
    got = jobs.nearest_or_only(spark.createDataFrame(keys, "marker_key string, lat double, lon double"),
                               spark.createDataFrame(spots, "marker string, lat double, lon double"), 5000.0).collect()
    assert {r.marker_key: r.marker for r in got} == want and len(got) == len(want) and len(want) > 10


def test_names_of_lost_markers(spark):
    """Names share all their words but one; equal names of two markers decide nothing."""
    markers = spark.createDataFrame([(f"m{i}", f"Разрез у Красного Яра {i}", 0.0, 0.0) for i in range(40)] + [("again", "Разрез у Красного Яра 7", 0.0, 0.0)],
                                    "marker string, name string, lat double, lon double")
    orphans = spark.createDataFrame([(f"x{i}", f"это РАЗРЕЗ у Красного Яра {i}, а не то") for i in range(45)] + [("none", ""), ("null", None)],
                                    "marker_key string, comment string")
    moved = spark.createDataFrame([], "marker_key string, to string")
    got = {r.marker_key: (r.target, r.why) for r in jobs.orphan_resolve(orphans, moved, markers).collect()}
    assert got == {f"x{i}": ((f"m{i}", "named") if i < 40 and i != 7 else (None, None)) for i in range(45)} | {"none": (None, None), "null": (None, None)}
    assert not set(jobs.orphan_resolve(orphans, moved, markers.filter(F.lit(False))).collect()[0][1:]) - {None}
