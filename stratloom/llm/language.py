"""Language of a text by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, text_slices

PER_LANGUAGE = 1_500  # texts of each language the model is fitted on, about
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)  # lengths of the n-grams
EVIDENCE = 30.0  # n-grams that count as independent; keeps scores of long texts below certainty
UNKNOWN = "und"


def hashed(text: str) -> np.ndarray:
    """Buckets of the character n-grams of one or several texts (joined by a line feed), lower-cased."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    # everything that separates words looks alike
    codes = np.where(codes < 65, np.uint64(32), codes)
    out = np.empty((len(ORDERS), len(codes)), np.int32)
    h = np.zeros(len(codes), np.uint64)
    row = 0
    for n in range(1, max(ORDERS) + 1):
        back = np.full(len(codes), 32, np.uint64)
        back[n - 1:] = codes[:len(codes) - n + 1]
        h = (h ^ back) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        if n in ORDERS:
            out[row] = ((h + np.uint64(n)) * np.uint64(0xD1342543DE82EF95) >> np.uint64(40)).astype(np.int64) % BUCKETS
            row += 1
    return out


class Model:
    """Languages, their log priors, and log probabilities: buckets by languages."""

    def __init__(self, languages: list[str], prior: np.ndarray, logs: np.ndarray):
        self.languages, self.prior, self.logs = languages, prior, logs

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text; texts without a letter, and all without a model: und, 0."""
        k = len(self.languages)
        lettered = [any(map(str.isalpha, t)) for t in texts] if k else [False] * len(texts)
        used = [i for i, ok in enumerate(lettered) if ok]
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not used:
            return names, score
        lowered = [texts[i].lower() for i in used]
        ends = np.cumsum([len(t) + 1 for t in lowered])
        buckets = hashed("\n".join(lowered) + "\n")
        starts = np.r_[0, ends[:-1]]
        total = np.zeros((len(used), k))
        for row in buckets:
            for j in range(k):
                total[:, j] += np.add.reduceat(self.logs[:, j][row], starts)
        n = (ends - starts) * len(ORDERS)
        best = total + self.prior
        scaled = total * (np.minimum(n, EVIDENCE) / n)[:, None] + self.prior
        choice = best.argmax(axis=1)
        p = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for row, i in enumerate(used):
            names[i] = self.languages[choice[row]]
        score[used] = p[np.arange(len(used)), choice]
        return names, score


def fit(docs: DataFrame, usable=None, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """A model from about ``per_language`` texts of each language, chosen by the hash of their id.

    Priors count all usable rows. Rows without language, id or text are not learnt from. ``usable`` is a
    condition on the id. Languages are in alphabetical order, so ties in a prediction go to the first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")) \
        .filter("_lang is not null and _id is not null")
    if usable is not None:
        rows = rows.filter(usable(F.col("_id")))
    prior = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    languages = sorted(prior)
    if not languages:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    # a share of each language, by the hash of the id: no ranking, and nothing of a hot language is shuffled
    parts = 1 << 20
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(-(-per_language * parts // prior[k])))])
    sample = rows.filter(F.pmod(F.xxhash64("_id"), F.lit(parts)) < share[F.col("_lang")])

    def count(batches):
        at = {x: i for i, x in enumerate(languages)}
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            names = batch.column("_lang").to_pylist()
            for first, texts in text_slices(batch.column("_text")):
                for name, t in zip(names[first:first + len(texts)], texts, strict=True):
                    if t:
                        sums[at[name]] += np.bincount(hashed(t + "\n").ravel(), minlength=BUCKETS)
        for i in range(len(languages)):
            some = np.flatnonzero(sums[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i), pa.int32()), pa.array(some, pa.int32()), pa.array(sums[i][some])],
                                             names=["lang", "bucket", "n"])

    counts = sample.select("_lang", "_text").mapInArrow(count, "lang int, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.full((BUCKETS, len(languages)), 0.5)
    matrix[counts["bucket"].to_numpy(), counts["lang"].to_numpy()] += counts["n"].to_numpy()
    size = np.array([prior[x] for x in languages], float)
    return Model(languages, np.log(size / size.sum()), np.log(matrix / matrix.sum(axis=0)).astype(np.float32))


def identify_language(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, ...] = ("lang_pred", "lang_score")) -> DataFrame:
    """Append ``lang_pred`` (a learnt language, or ``und`` for a text that is null or has no letter) and ``lang_score``.

    Texts of ``und`` score 0. Equal texts get equal answers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        return lambda texts: list(shared.value.predict(texts))

    return append_columns(docs, text, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())], start)
