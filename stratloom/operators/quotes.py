"""Quotes to pages through their rarest keys, source names to publications through sorted neighbours."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.common import let
from ..functions.python import with_search_bytes
from . import tools
from .marks import PAGE_END, mixed, quotes_in_pages, starts_in_pages

_STEM = 25  # fixed value: characters of a file name that identify a publication
_START, _LEAST = 60, 12  # fixed values: characters of a quote's start, and of the shortest text that is looked up
_WORDS = (8, 6, 4)  # fixed values: words of shorter starts
STAGES = ("whole", f"start{_START}", *(f"words{n}" for n in _WORDS), "fuzzy")
_CERTAIN = 3  # a fuzzy match shares three words at least
_AT_ONCE, _BESIDES = 96 << 20, 120  # bytes of quotes that a task holds at a time, and what each takes besides its text; a matter of memory, not of results


# ---------------------------------------------------------------- source → publication
def common_start(a: Column, b: Column) -> Column:
    """Length of the longest common start of two strings."""
    n = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)))
    return F.when(n == 0, 0).otherwise(let(F.array_position(same, F.lit(False)), lambda p: F.when(p == 0, n).otherwise(p - 1))).cast("int")


def neighbours(names: DataFrame, texts: DataFrame) -> DataFrame:
    """(s, before, after): for each text the names next to it in sorted order; of all names one of these shares its longest start.

    ``names`` has k, ``texts`` has s, both distinct. Both are sorted together by range; a partition carries its last and
    its first name to its neighbours through a table of one row per partition, so nothing is sorted in one task.
    """
    spark = names.sparkSession
    both = names.select("k", F.lit(None).cast("string").alias("s"), F.col("k").alias("v")) \
        .unionByName(texts.select(F.lit(None).cast("string").alias("k"), "s", F.col("s").alias("v")))
    # a text stands behind an equal name, so that the name is the one before it
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = tools.materialise(both.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()))
    ends = sorted_.groupBy("part").agg(F.max("k").alias("last"), F.min("k").alias("first"))
    line = Window.orderBy("part")  # one row per partition
    ends = ends.select("part", F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("left"),
                       F.min("first").over(line.rowsBetween(1, Window.unboundedFollowing)).alias("right"))
    here = Window.partitionBy("part").orderBy("v", F.col("k").isNull())
    near = sorted_.select("s", "part", F.max("k").over(here.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
                          F.min("k").over(here.rowsBetween(1, Window.unboundedFollowing)).alias("a"))
    return near.filter("s is not null").join(ends, "part").select("s", F.coalesce("b", "left").alias("before"), F.coalesce("a", "right").alias("after"))


def publication_lookup(srcs: DataFrame, pubs: DataFrame) -> DataFrame:
    """(src, publication, common, tied): the publication of each source name that has one.

    An equal normalised name wins (``common`` is its length). Else the name with the longest start in common with the
    source's name without its extension wins, if that is 25 characters or more. Else, for names shorter than that, one must be the start
    of the other, and the longest wins. Of names equally good the first by ``ord`` is taken and ``tied`` is set. ``srcs`` has
    ``src``; ``pubs`` has ``publication, ord``. No name is compared with more than its two neighbours in sorted order.
    """
    names = pubs.select(t.norm_pubname("publication").alias("k"), "publication", "ord").groupBy("k").agg(
        F.min(F.struct("ord", "publication")).alias("p"))
    want = srcs.select("src").distinct().withColumn("k", t.norm_pubname("src"))
    exact = tools.materialise(want.join(names, "k", "left"))
    missing = exact.filter("p is null").select("src", t.stem(F.col("k")).alias("s"))
    near = neighbours(names.select("k"), missing.select("s").distinct()).withColumn(
        "common", F.greatest(*[common_start(F.col("s"), F.coalesce(c, F.lit(""))) for c in ("before", "after")]))
    near = tools.materialise(near.select("s", "common"))
    # all names that share the longest start: they are looked up by that start, which few texts have in common
    starts = near.filter(F.col("common") >= _STEM).withColumn("start", F.substr("s", F.lit(1), F.col("common")))
    sizes = F.transform(F.sequence(F.lit(_STEM), F.greatest(F.length("k"), F.lit(_STEM))), lambda i: F.substr("k", F.lit(1), i))
    long = names.filter(F.length("k") >= _STEM).select("p", F.explode(F.array_distinct(sizes)).alias("start")) \
        .join(starts.select("start").distinct(), "start", "left_semi").groupBy("start").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("n"))
    by_neighbour = starts.join(long, "start").select("s", "common", "p", (F.col("n") > 1).alias("tied"))

    def prefixes(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.least(F.length(c), F.lit(_STEM))), lambda i: F.substr(c, F.lit(1), i))

    def first(df: DataFrame, start: Column) -> DataFrame:
        return df.select("p", start.alias("start")).groupBy("start").agg(F.min("p").alias("p"), F.max("p").alias("q"))

    rest = near.filter(F.col("common") < _STEM).select("s")
    stem = t.stem(F.col("k"))
    one = rest.withColumn("start", F.substring("s", 1, _STEM)).join(first(names, F.explode(prefixes(F.col("k")))), "start")
    two = rest.withColumn("start", F.explode(prefixes(F.col("s")))).join(first(names, F.substring(stem, 1, _STEM)), "start")
    short = one.unionByName(two).groupBy("s").agg(F.max(F.length("start")).alias("common"), F.collect_list(F.struct(F.length("start").alias("c"), "p", "q")).alias("x"))
    best = F.filter("x", lambda x: x["c"] == F.col("common"))  # at most one row per length on each side
    short = short.select("s", "common", F.array_min(F.transform(best, lambda x: x["p"])).alias("p"), F.array_max(F.transform(best, lambda x: x["q"])).alias("q"))
    near = by_neighbour.unionByName(short.select("s", "common", "p", (F.col("p") != F.col("q")).alias("tied")))
    found = exact.filter("p is not null").select("src", F.length("k").alias("common"), "p", F.lit(False).alias("tied")) \
        .unionByName(missing.join(near, "s").select("src", "common", "p", "tied"))
    return found.select("src", F.col("p.publication").alias("publication"), "common", "tied")


# ---------------------------------------------------------------- quote → page
def _at(w: Column, i: Column | int) -> Column:
    return F.get(w, F.lit(i) if isinstance(i, int) else i)


def _hash(*parts: Column) -> Column:
    """A key as a number, that of the same parts in a page of the publication (``marks.text_keys``)."""
    return mixed(F.xxhash64("publication"), *[F.xxhash64(x) for x in parts])


def _end(w: Column, i: Column | int, n: int = 1) -> Column:
    return F.right(_at(w, i), F.lit(n))


def _start(w: Column, i: Column | int, n: int = 1) -> Column:
    return F.left(_at(w, i), F.lit(n))


def _anchor(s: Column, df: Column) -> Column:
    """struct<n, kind, h>: the rarest key of a text, which every page that holds the text has as well.

    A text may start and end inside a word of the page, so only its inner words are whole: each pair of them makes a key. A text
    of three words has one whole word, shorter ones six or twelve letters of a word. ``df`` has the number of pages of each
    word of the quote that the text is the start of; ``n`` is 0 if no page holds one of the whole words.
    """
    def key(n: Column, kind: str, h: Column) -> Column:
        return F.struct(n.cast("double").alias("n"), F.lit(kind).alias("kind"), h.alias("h"))

    def of(w: Column) -> Column:
        k, one = F.size(w), F.lit(1)
        # two whole words with the letters that touch them on both sides
        many = F.transform(F.sequence(one, F.greatest(k - 3, one)), lambda i: key(
            _at(df, i).cast("double") * _at(df, i + 1), "c", _hash(_at(w, i), _at(w, i + 1), _end(w, i - 1), _start(w, i + 2))))
        return (F.when(k >= 4, F.array_min(many))
                .when(k == 3, key(_at(df, 1), "t", _hash(_at(w, 1), _end(w, 0), _start(w, 2))))
                .when((k == 2) & (F.length(_at(w, 1)) >= 6), key(one, "p", _hash(_start(w, 1, 6), _end(w, 0))))
                .when(k == 2, key(one, "s", _hash(_end(w, 0, 6), _start(w, 1))))
                .otherwise(key(one, "g", _hash(_start(w, 0, 12)))))

    # the start of a quote may be cut behind a word, which then is whole
    return let(F.split(F.rtrim(s), " "), of)


def _found(pages: DataFrame, quotes: DataFrame, held: Column, look: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(q, value, idx): the least value of each quote that ``look`` finds, and its earliest page.

    Tasks hold the quotes while they read the pages, as quotes and pages that share some words are as many as their product and must
    not be rows. They hold a bounded number of bytes (``held`` of a text and those who ask): more quotes take more rounds over the pages.
    """
    texts = tools.materialise(quotes.groupBy("norm").agg(F.collect_list(F.struct("publication", "q")).alias("asked")))
    rounds = -(-(texts.agg(F.sum(held)).first()[0] or 0) // _AT_ONCE)
    found = []
    for i in range(rounds):
        some = texts.filter(F.pmod(F.xxhash64("norm"), F.lit(rounds)) == i)
        best = look(pages, some).groupBy("q").agg(F.min(F.struct("value", F.struct("ord", "idx").alias("at"))).alias("b"))
        found.append(tools.materialise(best.select("q", "b.value", F.col("b.at.idx").alias("idx"))))
    none = pages.select(F.lit(0).cast("long").alias("q"), F.lit(0).cast("long").alias("value"), "idx").limit(0)
    return reduce(DataFrame.unionByName, found) if found else none


def evidence_page_join(ev: DataFrame, pages: DataFrame) -> DataFrame:
    """Quote → page of its publication: (publication, evidence, page, stage, method).

    Exact: the whole quote occurs in the page, else its first 60 characters, else its first 8, 6, 4 words; fuzzy: at least
    max(3, 60 %) of the quote's long words do. An earlier stage beats a later one, then more shared words,
    then the earlier page. Texts are normalised (``norm_search``) and written once; every look-up names the publication.
    """
    quotes = with_search_bytes(ev.select("publication", "evidence").filter("publication is not null").distinct(), "evidence", keep_text=True)
    quotes = tools.materialise(quotes.filter(F.length("norm") >= _LEAST))
    pages = tools.materialise(with_search_bytes(pages.select("publication", "ord", "idx", "text").filter("publication is not null"), "text", end=PAGE_END))
    uniq = tools.materialise(quotes.select("publication", "norm").distinct().withColumn("q", F.monotonically_increasing_id()))
    length, askers = F.length("norm"), F.size("asked")
    exact = _found(pages, uniq, length + askers * _BESIDES, lambda p, q: starts_in_pages(p, q, _START, _WORDS))
    rest = tools.materialise(uniq.join(exact, "q", "left_anti"))
    fuzzy = _found(pages, rest, (length + _BESIDES) * askers, lambda p, q: quotes_in_pages(p, q, _CERTAIN))
    found = exact.unionByName(fuzzy.withColumn("value", F.lit(len(STAGES) - 1).cast("long")))
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGES]), F.col("value").cast("int") + 1)
    return quotes.join(uniq.join(found, "q"), ["publication", "norm"]).select(
        "publication", "evidence", (F.col("idx") + 1).alias("page"), stage.alias("stage"),
        F.when(stage == STAGES[-1], "fuzzy").otherwise("exact").alias("method"))
