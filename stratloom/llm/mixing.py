"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks. DataFrame functions only."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tools import materialise, ordinal

WEIGHTS = (3, 1, 2)  # of the sources in their order, repeated
SHARE = 1.5  # words of the mix over words of the corpus
EPOCHS = 2  # times a document may be taken at most
BLOCK_WORDS = 1024
MOST_SLOTS = 1 << 31  # a longer schedule gets larger blocks, so that its products stay in 64 bits
CELL_ROWS = 4096  # documents of a source that are numbered together, about
GOLDEN = (5 ** 0.5 - 1) / 2


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, src, named, size, key) of each row: ``named`` is false for a null source, ``key`` shuffles a source."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
                       F.col(source).isNotNull().alias("named"), size.alias("size"),
                       F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"))


def sums_before(cells: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Append the sum of ``value`` over the earlier rows of the group; for tables of one row per cell."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def water_level(sources: DataFrame, total: float, epochs: int = EPOCHS) -> float | None:
    """Words for one unit of weight once no target is above its limit; None where nothing is left to share.

    Each round shares what the stopped sources leave among the others; only two numbers come to the driver.
    """
    limit, level = F.lit(float(epochs)) * F.col("source_size"), 0.0
    stopped = -1
    while True:
        over = limit <= F.lit(level) * F.col("weight")
        r = sources.agg(F.sum(F.when(over, limit)).alias("held"), F.sum(F.when(~over, F.col("weight"))).alias("weight"),
                        F.count(F.when(over, 1)).alias("n")).first()
        if not r["weight"]:
            return None
        if r["n"] == stopped:
            return level
        stopped, level = r["n"], max(level, (total - (r["held"] or 0.0)) / r["weight"])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(src, named, place, source_size, weight, target, want), one row per source.

    ``sizes`` has one row per source. Sources are ordered by code point, null last; target is the source's share of
    the mix by weight, at most ``epochs`` times its size, and ``want`` the same in whole words.
    """
    placed = ordinal(sizes, [], [F.desc("named"), F.col("src")], "place")
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = materialise(placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))))
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(placed, share * total, epochs)
    limit = F.col("source_size") * float(epochs)
    target = limit if level is None else F.least(limit, F.lit(level) * F.col("weight"))
    return placed.withColumn("target", target.cast("double")) \
        .withColumn("want", F.least(F.round("target").cast("long"), F.col("source_size") * epochs))


def golden_step(slots: int) -> int:
    """The step nearest to the golden section of ``slots`` that reaches every slot."""
    near = max(1, round(slots * GOLDEN))
    return next(s for d in range(slots + 1) for s in (near - d, near + d) if 0 < s <= max(1, slots) and gcd(s, slots) == 1)


def schedule(spark: SparkSession, shares: DataFrame, slots: int) -> DataFrame:
    """(slot, place, rank): the source of each slot and the number of the slot among those of its source.

    ``shares`` has (place, low, high), whole numbers that cut 0 … ``slots`` into one range per source. Slot i has the
    point i * step modulo ``slots``, a golden-ratio sequence that meets every number once, so a source gets exactly
    high - low slots, evenly spread. The range of a point is found through cells as wide as an average range;
    slots are counted chunk by chunk, so a source with a third of all slots is never in one task.
    """
    n = max(1, slots)
    width = max(1, n // max(1, shares.count()))
    cells = shares.filter("high > low").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") / width).cast("long"), F.floor((F.col("high") - 1) / width).cast("long"))))
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") * golden_step(n)) % n).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / width).cast("long"))
    dealt = points.join(cells, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))) \
        .select("slot", "place", F.shiftright("slot", 16).alias("chunk"))
    counts = sums_before(dealt.groupBy("place", "chunk").agg(F.count(F.lit(1)).alias("n")), ["place"], ["chunk"], "n", "before")
    local = Window.partitionBy("place", "chunk").orderBy("slot")
    return dealt.withColumn("at", F.row_number().over(local)).join(counts.drop("n"), ["place", "chunk"]) \
        .select("slot", "place", (F.col("before") + F.col("at") - 1).alias("rank"))


def cell_of(key: Column, rows: int) -> Column:
    """First hexadecimal digits of a key, as many as leave about ``CELL_ROWS`` rows to a cell."""
    digits = 0
    while 16 ** digits * CELL_ROWS < rows and digits < 8:
        digits += 1
    return F.substring(key, 1, digits) if digits else F.lit("")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of a mix of all rows of ``docs``.

    documents: doc_id, src, named, size, source_size, target, place, start. The documents of a source stand one after
    the other in the order of the MD5 of their ids; ``start`` is the first word of a document there. pieces: place,
    start, doc_id, rank, slot, first, n_words: the words ``first`` … of a document that slot ``slot`` of the mix takes; the
    words of a source are cut into equal blocks, the last one ends where the target is met, and a source that ends
    before starts again. Block ``rank`` of a source goes to the source's slot of that rank.

    Null texts are of size 0; texts without a word are documents with nothing to take. Null sources form a source of their
    own, the last. Null ids are like empty ones, and repeated rows are documents of their own. No rows give no rows. Columns
    beside the three are ignored, whatever their names.
    """
    spark = docs.sparkSession
    rows = materialise(measure(docs, id_col, text, source))
    count = rows.count()
    rows = rows.withColumn("cell", cell_of(F.col("key"), count))
    cells = materialise(rows.groupBy("src", "named", "cell").agg(F.sum("size").alias("cell_size")))
    known = targets(cells.groupBy("src", "named").agg(F.sum("cell_size").alias("source_size")), weights, share, epochs)
    wanted = known.agg(F.sum("want")).first()[0] or 0
    block = max(block_words, -(-wanted // MOST_SLOTS))
    known = known.withColumn("blocks", F.ceil(F.col("want") / block).cast("long")).withColumn("group", F.shiftright("place", 12))
    groups = sums_before(known.groupBy("group").agg(F.sum("blocks").alias("n")).withColumn("all", F.lit(0)), ["all"], ["group"], "n", "low0")
    before = Window.partitionBy("group").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    known = known.join(groups.select("group", "low0"), "group") \
        .withColumn("low", F.col("low0") + F.coalesce(F.sum("blocks").over(before), F.lit(0))).withColumn("high", F.col("low") + F.col("blocks"))
    known = materialise(known.select("src", "named", "place", "source_size", "target", "want", "low", "high"))
    slots = known.agg(F.max("high")).first()[0] or 0

    based = sums_before(cells.join(known.drop("low", "high"), ["src", "named"]), ["src", "named"], ["cell"], "cell_size", "base")
    inside = Window.partitionBy("src", "named", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # a cell holds about as many rows however large its source is; both sides share one partitioning
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(based, ["src", "named", "cell"]) \
        .select("doc_id", "src", "named", "size", "source_size", "target", "place", (F.col("base") + F.col("inner")).cast("long").alias("start"), "want")
    placed = materialise(placed)

    turns = F.explode(F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: F.col("start") + e * F.col("source_size")))
    spans = placed.filter("size > 0").select("place", "start", "doc_id", "size", "want", turns.alias("from"))
    spans = spans.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("want"))).filter(F.col("from") < F.col("to"))
    ranks = F.sequence(F.floor(F.col("from") / block).cast("long"), F.floor((F.col("to") - 1) / block).cast("long"))
    cut = spans.withColumn("rank", F.explode(ranks))
    low, high = F.greatest(F.col("from"), F.col("rank") * block), F.least(F.col("to"), (F.col("rank") + 1) * block)
    cut = cut.select("place", "start", "doc_id", "rank", (low - F.col("from")).alias("first"), (high - low).alias("n_words"))
    pieces = cut.join(schedule(spark, known.select("place", "low", "high"), slots), ["place", "rank"])
    return placed.drop("want"), pieces.select("place", "start", "doc_id", "rank", "slot", "first", "n_words")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row: the words that the slots of :func:`mix` take of it."""
    documents, pieces = mix(docs, **options)
    taken = pieces.groupBy("place", "start").agg(F.sum("n_words").alias("taken"))
    full = documents.filter("size > 0").join(taken, ["place", "start"], "left")
    return full.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")) \
        .unionByName(documents.filter("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))
