"""The pipeline's stages on rows with planted cases, and on odd rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from stratloom.llm import decontam

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", None, 0), (10**9 + 1, "?! 12", None, "s", 5)], docs.schema)
    # columns that bear the names operators give, and their values must come through
    clash = [c for c in ("predicted", "toxicity", "lang_pred", "leaks", "_fp", "_id", "_n", "score")]
    rows = docs.union(odd).union(docs.limit(3)).select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in clash])
    names = [n for n, _ in p.STAGES]
    assert names == ["toxicity", "language", "near_duplicates", "decontamination", "encoding"]
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, rows, FOLDER)
        assert out.columns == rows.columns and [f.dataType for f in out.schema] == [f.dataType for f in rows.schema]
        wrong = out.filter(" or ".join(f"`{c}` <> concat('{c}:', coalesce(cast(doc_id as string), ''))" for c in clash))
        assert 0 < out.count() <= rows.count() and wrong.count() == 0
        assert stage(spark, rows.filter("false"), FOLDER).count() == 0
    assert p.encoded(spark, rows, FOLDER).count() == rows.count()


def test_planted_cases_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = next(r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").collect() if len(decontam.tokens(r["text"])) > 20)
    clean = docs.filter("doc_id = (select min(doc_id) from {d} where n_chars between 1500 and 3000)".replace("{d}", f"parquet.`{FOLDER}/documents.parquet`")).first()["text"]
    planted = [(10**6, clean + " final words of another kind"), (10**6 + 1, clean + " final words of another kind"),
               (10**6 + 2, "a long walk along the river " * 3 + item + " and back home again")]
    more = docs.union(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in planted], docs.schema))
    once = {r.doc_id for r in p.without_copies(spark, more, FOLDER).collect()}
    assert not {10**6, 10**6 + 1} <= once and 10**6 + 2 in once
    pure = {r.doc_id for r in p.without_benchmark(spark, more, FOLDER).collect()}
    assert 10**6 + 2 not in pure


def test_run_is_its_stages(spark):
    by_hand = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in p.STAGES:
        by_hand = stage(spark, by_hand, FOLDER).cache()
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(p.run(spark, FOLDER)) == rows(by_hand)
    assert p.ORACLE_SQL is None


@pytest.mark.parametrize("key", ["op1_bpe_chunks", "op3_simhash", "op4_quality", "op5_toxicity", "op6_language", "op8_token_counts", "op10_sharding"])
def test_queries_return_every_document(spark, key):
    from stratloom.llm.queries import llm_queries
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = llm_queries()[key](spark, FOLDER)
    assert got.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0 == docs.count() - got.count()


def test_licence_query_equals_its_sql(spark):
    from stratloom.llm.queries import llm_oracles, llm_queries
    from tools.check import compare, duck
    for key, sql in llm_oracles().items():
        problems, _ = compare(llm_queries()[key](spark, FOLDER), duck(FOLDER), sql)
        assert not problems, problems
