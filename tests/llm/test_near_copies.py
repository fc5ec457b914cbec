"""Near copies against all pairs."""

import random

import pytest

import corpus_pipeline
from stratloom.llm import near_copies, simhash


def plain_shingles(text):
    ws = (text or "").lower().split()
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    """Smallest id of each group of texts whose shingles have a similarity of 0.8 or more."""
    sets = {i: plain_shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i for i in sets if find(i) == i}


def edited(rng, ws, n):
    ws = list(ws)
    for at in rng.sample(range(len(ws)), n):
        ws[at] = f"new{rng.randrange(10**6)}"
    return ws


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    line = [f"common{i}" for i in range(12)]
    out = []
    for g in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 150, 400]))]
        out.append(base)
        # edits on both sides of the limit
        out += [edited(rng, base, max(1, len(base) * k // 100)) for k in (1, 2, 2, 3)]
        out.append(base + line)
    hub = [f"h{i}" for i in range(300)]
    out += [edited(rng, hub, rng.choice([3, 5, 6, 7])) for _ in range(90)] + [line, line[:4], [], hub]
    return [(i, " ".join(t)) for i, t in enumerate(out)] + [(5000, None), (5001, " ".join(out[0]).upper())]


def test_stage_equals_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.without_copies(spark, docs, "").collect()}
    assert got == brute(rows)


def test_copies_of_many_bits_go(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)] + [" ".join(edited(rng, base, 3)) for _ in range(60)]
    far = [t for t in texts[1:] if (simhash.fingerprint(t) ^ simhash.fingerprint(texts[0])).bit_count() > simhash.RADIUS]
    assert far
    docs = spark.createDataFrame([(0, texts[0]), (1, far[0])], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.without_copies(spark, docs, "").collect()] == [0]


def test_parities_bound_what_sets_share():
    rng = random.Random(4)
    for n in (0, 1, 3, 31, 32, 33, 400, 5000):
        a = near_copies.shingles(" ".join(f"w{rng.randrange(10**6)}" for _ in range(n + 4 if n else 0)))
        for cut in (0, 1, n // 9, n // 5, n // 2, n):
            b = near_copies.np.sort(near_copies.np.r_[a[cut:], near_copies.shingles(" ".join(f"v{rng.randrange(10**6)}" for _ in range(cut + 4)))])
            shared = len(set(a.tolist()) & set(b.tolist()))
            assert shared <= near_copies.most_shared(len(a), near_copies.parities(a), len(b), near_copies.parities(b)) <= min(len(a), len(b)) + abs(len(a) - len(b))


def test_sets_of_texts_that_share_a_passage_only_stay_where_they_are(spark, monkeypatch):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(240)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(60)]
    near = texts + [texts[0] + " end"]
    sent, plain = [], near_copies._sets

    def counted(docs, asked):
        sent.append(asked.count())
        return plain(docs, asked)

    monkeypatch.setattr(near_copies, "_sets", counted)
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    assert {r["doc_id"] for r in near_copies.keep_one(docs).collect()} == set(range(60))
    assert 0 < sum(sent) <= 10, sent
