"""Results do not depend on the number of indexes; short items and scripts without spaces are found."""

import math
import random

from pyspark.sql import functions as F

from stratloom.llm import decontam


def found(docs, benchmark, **more):
    rows = decontam.find_items(docs, benchmark, **more).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*").collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0], r[1] is not None, r[1:]))


def test_indexes_do_not_change_the_result(spark):
    rng = random.Random(21)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(4000)]
    bench = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 40, 90])))) for i in range(120)]
    rows = []
    for i, (_, text) in enumerate(bench):
        ws = text.split()
        # shares of an item on both sides of the limits, in either half
        keep = [w if rng.random() < rng.choice([0.5, 0.6, 0.75, 1.0]) else rng.choice(vocabulary) for w in ws]
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 200))) + " " + " ".join(keep)))
        rows.append((1000 + i, text + " " + " ".join(rng.choice(vocabulary) for _ in range(150))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([*bench, (500, None), (None, bench[3][1])], "item_id long, text string")
    one = found(docs, benchmark, shards=1)
    assert {(1000 + i, i) for i in range(120)} <= {r[:2] for r in one} and len(one) > 130
    for shards in (4, 20):
        assert found(docs, benchmark, shards=shards) == one


def test_bm25_by_hand(spark):
    """Shares and overlaps recomputed from the texts, for every document against every item."""
    rng = random.Random(22)
    vocabulary = [f"v{i}" for i in range(300)]
    bench = [(i, " ".join(rng.sample(vocabulary, 10 + i % 7))) for i in range(40)]
    rows = []
    for i, (_, text) in enumerate(bench):
        ws = text.split()
        cut = rng.randint(0, len(ws) // 2)
        rows.append((i, " ".join(ws[cut:])))
    longest = max(len(t.split()) for _, t in bench)
    stats = decontam.Statistics.of([t.split() for _, t in bench])
    weight = lambda tf, df, n: (
        math.log(1 + (len(bench) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / stats.mean)))
    want = set()
    for d, text in rows:
        own = text.split()
        assert len(own) <= longest  # one passage
        for i, item in bench:
            ws = item.split()
            full = {w: weight(ws.count(w), sum(w in t.split() for _, t in bench), len(ws)) for w in ws}
            share = sum(v for w, v in full.items() if w in own) / sum(full.values())
            grams = {tuple(own[k:k + 4]) for k in range(len(own))}
            halves = [ws[:len(ws) // 2], ws[len(ws) // 2:]]
            over = [sum(tuple(h[k:k + 4]) in grams for k in range(len(h) - 3)) / (len(h) - 3) for h in halves]
            if share >= decontam.SHARE and min(over) >= decontam.OVERLAP:
                want.add((d, i))
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r[:2] for r in got} == want and 5 < len(want) < 40


def test_short_and_unspaced_items(spark):
    question = "東京から大阪まで新幹線で何時間かかりますか。およそ二時間半です。"
    benchmark = spark.createDataFrame([(1, question), (2, "Who wrote Hamlet?"), (3, "Paris"), (4, "日本の首都"), (5, ""), (6, "?!"), (7, "a b a c")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "まえがき。" + question + "あとがき。"), (2, "they ask who wrote  hamlet, again"), (3, "who wrote the play Hamlet"), (4, "Paris."), (5, "He went to Paris."),
         (6, "これは日本の首都です"), (7, "日本には首都がある"), (8, None), (9, ""), (10, "x a b a b a c y"), (11, "word " * 5000 + "who wrote hamlet")], "doc_id long, text string")
    assert [r[:2] for r in found(docs, benchmark)] == [(1, 1), (2, 2), (4, 3), (6, 4), (10, 7), (11, 2)]
    assert found(docs, benchmark, shards=3) == found(docs, benchmark)
