"""Mix of sources against a plain version."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratloom.llm import mixing
from stratloom.llm.mixing import golden_step, mix, schedule, taken_words

SCHEMA = "doc_id bigint, text string, source string"


def plain_targets(sizes, weights, share=Fraction(3, 2), epochs=2):
    """Shared out again and again until no source is above its limit."""
    out, left, open_ = {}, share * sum(sizes), set(range(len(sizes)))
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > epochs * sizes[i]}
        if not over:
            return out | {i: level * weights[i] for i in open_}
        for i in over:
            out[i] = Fraction(epochs * sizes[i])
            left -= out[i]
        open_ -= over
    return out


def plain_mix(rows):
    docs = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    names = sorted({s for _, _, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(d[1] for d in docs if d[2] == s) for s in names]
    target = plain_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))])
    out = []
    for i, s in enumerate(names):
        want, at = min(int(target[i] + Fraction(1, 2)), 2 * sizes[i]), 0
        for doc, size, _ in sorted((d for d in docs if d[2] == s), key=lambda d: (hashlib.md5(("" if d[0] is None else str(d[0])).encode()).hexdigest(), d[0] or 0, d[1])):
            taken = sum(max(0, min(at + size + e * sizes[i], want) - at - e * sizes[i]) for e in (0, 1))
            out.append((doc, size, sizes[i], round(float(target[i]), 6), taken))
            at += size
    return out


def key(r):
    return tuple(-1 if x is None else x for x in r)


def corpus():
    rows = [(i, "w " * (1 + i * 7 % 23), f"s{i % 5}") for i in range(300)]
    rows += [(i, "long text " * 4000, "big") for i in range(300, 303)]
    rows += [(i, "x y z", "hot") for i in range(400, 700)]
    rows += [(None, "no id", None), (None, "no id", None), (800, None, None), (801, "", "empty"), (802, " \t\n", ""), (803, "a\x0bb\x0cc", ""),
             (803, "a\x0bb\x0cc", ""), (804, " one word ", "\U0001F600"), (805, "b", "￿")]
    return rows


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_mix_of_odd_documents(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("x")).withColumn("target", F.lit("y")).withColumn("place", F.lit(0)).repartition(4)
    got = [(*tuple(r)[:3], round(r["target"], 6), r["taken"]) for r in taken_words(df, block_words=block).collect()]
    assert sorted(got, key=key) == sorted(plain_mix(rows), key=key)


def test_cells_do_not_change_the_mix(spark, monkeypatch):
    df = spark.createDataFrame(corpus(), SCHEMA)
    one = sorted((tuple(r) for r in taken_words(df).collect()), key=key)
    monkeypatch.setattr(mixing, "CELL_ROWS", 10)
    assert sorted((tuple(r) for r in taken_words(df.repartition(3)).collect()), key=key) == one


def test_no_rows_and_no_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], SCHEMA)
    assert taken_words(df.limit(0)).collect() == []
    assert sorted(tuple(r) for r in taken_words(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_pieces_fill_the_slots(spark):
    """Each slot is one block of one source; its pieces have the block's words, and sources are spread evenly."""
    documents, pieces = mix(spark.createDataFrame(corpus(), SCHEMA), block_words=50)
    want = {r["place"]: min(round(r["target"]), 2 * r["source_size"]) for r in documents.select("place", "target", "source_size").distinct().collect()}
    slots, ranks = defaultdict(int), defaultdict(set)
    for r in pieces.collect():
        slots[r["place"], r["rank"], r["slot"]] += r["n_words"]
        ranks[r["place"]].add((r["slot"], r["rank"]))
        assert r["first"] >= 0 and r["n_words"] > 0
    assert len({s for _, _, s in slots}) == len(slots) == sum(-(-w // 50) for w in want.values())
    for place, pairs in ranks.items():
        assert [r for _, r in sorted(pairs)] == list(range(len(pairs)))  # in slot order the blocks of a source follow each other
        assert sum(n for (p, _, _), n in slots.items() if p == place) == want[place]
        assert all(n == 50 for (p, r, _), n in slots.items() if p == place and r < len(pairs) - 1)


def test_schedule_is_exact_and_even(spark):
    cuts = [0, 500, 500, 620, 621, 1000]
    shares = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))], "place bigint, low bigint, high bigint")
    rows = schedule(spark, shares, 1000).collect()
    assert sorted(r["slot"] for r in rows) == list(range(1000))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        own = sorted((r["slot"], r["rank"]) for r in rows if r["place"] == i)
        assert [r for _, r in own] == list(range(b - a))
        for n in (100, 400, 900):  # any start of the schedule has its share of every source, up to a few slots
            assert abs(sum(s < n for s, _ in own) - n * (b - a) / 1000) < 4


def test_golden_steps_reach_every_slot():
    for n in (1, 2, 3, 10, 997, 1000, 2**20):
        step = golden_step(n)
        assert len({i * step % n for i in range(min(n, 5000))}) == min(n, 5000)
    assert abs(golden_step(10**6) / 10**6 - mixing.GOLDEN) < 1e-4


def test_no_python_on_the_way(spark):
    plan = taken_words(spark.createDataFrame(corpus(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
