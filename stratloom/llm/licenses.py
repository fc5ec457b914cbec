"""License notices in texts: word k-grams joined to template positions, votes on offset diagonals."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3  # words of a gram; templates of fewer words are one gram
DRIFT = 3  # diagonals that differ by at most so much belong to one span: words were put in or left out
LEAST_COVER = 0.7  # share of a template's words that a span must hold for its label

# Phrases of the contract with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices in common use, lower-cased, with the label of their license.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "this work is licensed under the gnu general public license version": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# what splits words: all of ASCII but digits and letters
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_rows() -> list[tuple]:
    """(k, gram, template, place, length, base, label) of the grams of all templates."""
    rows = []
    for i, (text, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        ws = text.split()
        k = min(GRAM, len(ws))
        rows += [(k, " ".join(ws[p:p + k]), i, p, len(ws), i < len(BASE), label) for p in range(len(ws) - k + 1)]
    return rows


def _words(text) -> F.Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def find_notices(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row per row of ``docs``.

    Every word position gives the hash of its gram, which joins the grams of the templates; equal words are
    required too, so a hash alone never counts. Hits of a template vote for the diagonal position - place.
    Neighbouring diagonals are merged to spans, a span is verified by the share of the template's words its
    grams cover, and a phrase of BASE counts where one diagonal has all its grams. ``score`` is the largest
    share over all spans, 0 without one. Null and empty texts have no words. Repeated rows stay repeated, null
    ids are kept. ``spans`` lists (label, first word, last word, share) of verified spans in order.
    """
    spark = docs.sparkSession
    row = F.monotonically_increasing_id()
    # one row in, one row out: keeps the words from being computed again for every position
    split = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.explode(F.array(_words(F.col(text)))).alias("w"))
    n = F.size("w")
    # position -1 stands for the text itself and meets a row of its own, so texts without hits stay
    at = F.explode(F.sequence(F.lit(-1), n - 1)).alias("pos")
    grams = split.select("row", "id", "w", n.alias("n_words"), at)

    def word(i):
        return F.get("w", F.col("pos") + i)

    ks = sorted({min(GRAM, len(t.split())) for t in [*BASE, *NOTICES]})
    hashed = F.explode(F.when(F.col("pos") < 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.array(*[F.when(F.col("pos") + k <= F.col("n_words"), F.xxhash64(F.lit(k), *[word(i) for i in range(k)])) for k in ks]))).alias("h")
    known = spark.createDataFrame(template_rows(), "k int, gram string, template int, place int, length int, base boolean, label string").withColumn("p", F.split("gram", " "))
    h = F.coalesce(*[F.when(F.col("k") == k, F.xxhash64(F.lit(k), *[F.get("p", F.lit(i)) for i in range(k)])) for k in ks])
    known = known.select(h.alias("h"), "p", "k", "template", "place", "length", "base", "label")
    own = spark.createDataFrame([(0,)], "h long").select("h", *[F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema if f.name != "h"])
    same = F.lit(True)
    for i in range(max(ks)):
        same = same & (F.col("p").isNull() | (F.col("k") <= i) | (word(i) == F.get("p", F.lit(i))))
    # the templates are constants of this module
    hits = grams.select("row", "id", "w", "n_words", "pos", hashed).join(F.broadcast(known.union(own)), "h").filter(same) \
        .select("row", "id", "n_words", "pos", "k", "template", "place", "length", "base", "label").repartition("row")
    # all that follows is by row, so the rows are dealt once
    diagonals = hits.groupBy("row", "id", "n_words", "template", "length", "base", "label", "k", (F.col("pos") - F.col("place")).alias("diagonal")) \
        .agg(F.count("place").alias("votes"), F.collect_set("place").alias("places"), F.min("pos").alias("first"), (F.max("pos") + F.col("k") - 1).alias("last"))
    w = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > DRIFT).cast("int"), F.lit(1))
    whole = F.col("base") & (F.col("votes") == F.col("length") - F.col("k") + 1)
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))
    spans = diagonals.withColumn("opens", opens).withColumn("span", F.sum("opens").over(w)) \
        .groupBy("row", "id", "n_words", "template", "length", "label", "span").agg(
            F.sum(F.when(whole, 1)).alias("n"), F.min(F.when(whole, F.col("diagonal"))).alias("lo"), F.max(F.when(whole, F.col("diagonal"))).alias("hi"),
            (F.size(F.array_distinct(F.flatten(F.collect_list(covered)))) / F.col("length")).alias("share"),
            F.min("first").alias("first"), F.max("last").alias("last"))
    verified = F.col("share") >= LEAST_COVER
    return spans.groupBy("row", "id", "n_words").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_base"), F.min("lo").cast("long").alias("first_word"), F.max("hi").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("n") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(verified, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("template").isNotNull(), F.col("share"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(verified, F.struct("first", "last", "label", "share")))).alias("spans")) \
        .select("id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
