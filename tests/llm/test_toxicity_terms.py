"""Every term of every labelled example counts, whichever label it points to."""

import random

import numpy as np

from stratloom.llm import toxicity


def test_all_examples_and_terms_are_indexed(spark):
    rng = random.Random(4)
    # 400 toxic words: more than any short list of the best terms holds; clean rows have words of their own
    rows = [(i, f"vile{i % 400:03d}x sand river" if i < 1600 else f"calm{i % 50} sand river clay", int(i < 1600)) for i in range(4000)]
    rng.shuffle(rows)
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(known, known.select("doc_id", "toxic"))
    assert model.index.n_items == 4000 and set(model.terms.tolist()) == set(toxicity.hashes({t for _, x, _ in rows for t in toxicity.terms_of(x)}).tolist())
    for i in range(0, 400, 7):
        score, near, cosines = model.score(f"vile{i:03d}x")
        assert score >= 0.5 and near and cosines
    score, near, _ = model.score("calm7 sand")
    assert score < 0.5 and len(near) == toxicity.NEAREST and min(near) >= 1600


def test_nearest_equals_the_index(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))), i % 3 // 2) for i in range(300)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(known, known.select("doc_id", "toxic"))
    vectors = [model.vector(t + " unseen") for _, t, _ in rows[:150]] + [model.vector("unseen"), model.vector("")]
    for (at, w), (near, cosine) in zip(vectors, model.nearest(vectors), strict=True):
        want, scores = model.index.top(at, w, toxicity.NEAREST)
        assert np.allclose(scores, cosine) and len(near) == len(want)


def test_a_task_keeps_no_entries_and_no_double_weights():
    """What stays after the parts are made is bounded by 16 bytes a posting beside the matrices; exact cosines are those of the index."""
    rng = np.random.default_rng(3)
    n, v = 3000, 60_000
    key = np.unique((v ** rng.random(n * 200)).astype(np.int64) % v * n + rng.integers(0, n, n * 200))
    term, item = key // n, (key % n).astype(np.int32)
    df, tf = np.bincount(term, minlength=v), rng.integers(1, 5, len(key)).astype(np.int32)
    model = toxicity.Model(np.arange(v, dtype=np.uint64), 1 / (1 + np.log1p(df)), item, df, tf, np.zeros(n), np.arange(n), 0.1, 0.01)
    dense, most, row, start, *rest = model.parts()
    assert "_index" not in model.__dict__
    assert sum(x.nbytes for x in rest) + model.item.nbytes + model.tf.nbytes <= 16 * len(key)
    vectors = []
    for _ in range(20):
        at = np.unique((v ** rng.random(100)).astype(np.int64) % v)
        w = model.idf[at]
        vectors.append((at, w / np.sqrt((w * w).sum())))
    for (at, w), (near, cosine) in zip(vectors, model.nearest(vectors), strict=True):
        _, scores = model.index.top(at, w, toxicity.NEAREST)
        assert len(near) == toxicity.NEAREST and np.allclose(cosine, scores)
