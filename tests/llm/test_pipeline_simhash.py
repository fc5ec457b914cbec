"""The pipeline's near copies go by SimHash first, and by shingles of what fingerprints miss."""

import corpus_pipeline as p
from stratloom.llm import simhash


def test_groups_of_fingerprints_keep_one_document(spark):
    block = (" ".join(f"part{i}" for i in range(13)) + " ") * 200
    tails = [" ".join(f"w{k}x{i}" for i in range(120)) for k in range(2)]
    a, b = (block + t for t in tails)
    assert bin(simhash.fingerprint(a) ^ simhash.fingerprint(b)).count("1") <= simhash.RADIUS
    long = " ".join(f"word{i}" for i in range(300))
    near = long.replace("word7 ", "other ")
    docs = spark.createDataFrame([(1, a), (2, b), (3, long), (4, near)], "doc_id long, text string")
    assert {r.doc_id for r in p.without_copies(spark, docs, "").collect()} == {1, 3}
