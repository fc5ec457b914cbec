"""Training corpus: documents without toxic, unreadable, repeated and leaked texts, encoded.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and is written as Parquet
and read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratloom.llm import bpe_chunks, decontam, language, near_copies, simhash, toxicity
from stratloom.llm.common import held_out, table, unused
from stratloom.operators.tools import materialise

TOKENIZER = "byte_bpe_50k.json"
LEAST_LANGUAGE_SCORE = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples nearest to them do not mark as toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 5, 0))
    names = unused(docs, "toxicity", "predicted", "nearest_ids", "nearest_cosines")
    return toxicity.score_toxicity(docs, model, names=names).filter(F.col(names[1]) == 0).select(docs.columns)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told; texts without letters and undecided ones go."""
    model = language.fit(docs, lambda i: ~held_out(i, 3, 1))
    names = unused(docs, "lang_pred", "lang_score")
    known = (F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= LEAST_LANGUAGE_SCORE)
    return language.identify_language(docs, model, names=names).filter(known).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, then of each group of near copies that fingerprints miss: five-word shingles of similarity 0.8 or more."""
    return near_copies.keep_one(materialise(simhash.keep_one(docs)))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    (leaks,) = unused(docs, "leaks")
    return decontam.find_items(docs, table(spark, sf_dir, "benchmark"), column=leaks).filter(F.size(leaks) == 0).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe_chunks.encode_corpus(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", without_toxic), ("language", with_language), ("near_duplicates", without_copies),
          ("decontamination", without_benchmark), ("encoding", encoded)]

# nearest examples, hashed n-grams and merges are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
