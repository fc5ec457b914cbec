"""Which texts hold which names: literal containment and word cover, without comparing all texts with all names of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tools

GRAM = 6  # characters of a key; a matter of cost, not of results
PROBES = 4  # of a name; as well
SALTS = 16  # tasks that the texts of one key are dealt to
_NUM, _DEN, _LEAST = 3, 5, 2  # fixed values: share of the words that must be met, as a fraction, and their least number


def _grams(c: str, n: Column) -> Column:
    """Distinct substrings of ``n`` characters."""
    last = F.length(c) - n + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(F.col(c), i, n))))


def containing(texts: DataFrame, names: DataFrame, by: list[str], text: str = "text", name: str = "name") -> DataFrame:
    """(by, text, name): distinct texts with each non-empty name of the same group that they contain literally.

    ``PROBES`` substrings of a name, of ``GRAM`` characters or all of a shorter name, must occur in texts of its group; names of
    which one does not are dropped first. The others meet texts through the one that fewest texts have. So a group is
    spread over its substrings, and the texts of a substring are dealt to ``SALTS`` tasks. Nulls match nothing.
    """
    rows = names.select(*by, name).filter(F.length(name) > 0).distinct().withColumn("_len", F.least(F.length(name), F.lit(GRAM)))
    last = F.length(name) - F.col("_len")
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.floor(last * i / (PROBES - 1)).cast("int") + 1))
    rows = rows.select(*by, name, "_len", F.array_distinct(F.transform(starts, lambda i: F.substr(F.col(name), i, F.col("_len")))).alias("_g"))
    grams = rows.select(*by, name, F.size("_g").alias("_m"), F.explode("_g").alias("_gram"))
    # at most GRAM rows, whatever the names are
    lengths = F.broadcast(rows.select("_len").distinct())
    # only substrings that are some name's are written
    seen = texts.select(*by, text).filter(F.length(text) > 0).distinct().join(lengths, F.col("_len") <= F.length(text)) \
        .select(*by, text, F.explode(_grams(text, F.col("_len"))).alias("_gram"))
    seen = tools.materialise(seen.join(grams.select(*by, "_gram").distinct(), [*by, "_gram"], "left_semi"))
    often = seen.groupBy(*by, "_gram").agg(F.count(F.lit(1)).alias("_n"))
    key = grams.join(often, [*by, "_gram"]).groupBy(*by, name, "_m").agg(F.count(F.lit(1)).alias("_f"), F.min(F.struct("_n", "_gram")).alias("_k")) \
        .filter("_f = _m").select(*by, name, F.col("_k._gram").alias("_gram"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    dealt = seen.withColumn("_salt", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int"))
    # one key per name: a pair is found once
    return dealt.join(key, [*by, "_gram", "_salt"]).filter(F.contains(F.col(text), F.col(name))).select(*by, text, name)


def enough(words: str, other: str) -> Column:
    """Whether enough of the words, repeats counted, are among the others."""
    hits, n = F.size(F.filter(words, lambda w: F.array_contains(F.col(other), w))), F.size(words)
    return (hits >= _LEAST) & (hits * _DEN >= n * _NUM)


def covered(phrases: DataFrame, texts: DataFrame, by: list[str], words: str, others: str) -> DataFrame:
    """(by, words, others): distinct word lists and the lists of the same group that hold two and 60 % of their words.

    Words count as often as they stand in ``words``. Of n words h must be met: lists of which fewer stand anywhere in the
    group are dropped first, and as one of any n - h + 1 must be met, only those n - h + 1 that fewest lists hold are looked up.
    """
    want = phrases.select(*by, words).filter(F.size(words) >= _LEAST).distinct()
    have = texts.select(*by, others).filter(F.size(others) >= 1).distinct()
    each = want.select(*by, words, F.explode(words).alias("_w")).groupBy(*by, words, "_w").agg(F.count(F.lit(1)).alias("_c"))
    held = have.select(*by, others, F.explode(F.array_distinct(others)).alias("_w")) \
        .join(each.select(*by, "_w").distinct(), [*by, "_w"], "left_semi")
    often = held.groupBy(*by, "_w").agg(F.count(F.lit(1)).alias("_n"))
    known = each.join(often, [*by, "_w"])
    # the words of one list; those that no list holds come first in the order and are looked up in vain
    line = Window.partitionBy(*by, words)
    need = F.greatest(F.lit(_LEAST), F.floor((F.size(words) * _NUM + _DEN - 1) / _DEN))
    ranked = known.withColumn("_all", F.sum("_c").over(line)).filter(F.col("_all") >= need) \
        .withColumn("_before", F.size(words) - F.col("_all") + F.coalesce(F.sum("_c").over(
            line.orderBy("_n", "_w").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = ranked.filter(F.col("_before") < F.size(words) - need + 1) \
        .select(*by, words, "_w").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = held.withColumn("_salt", F.pmod(F.xxhash64(others), F.lit(SALTS)).cast("int"))
    return dealt.join(first, [*by, "_w", "_salt"]).filter(enough(words, others)).select(*by, words, others).distinct()


def any_of(*found: DataFrame) -> DataFrame:
    """Distinct rows of several results with equal columns, written once."""
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return tools.materialise(out.distinct())
