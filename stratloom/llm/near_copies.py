"""Near copies by the exact Jaccard similarity of word shingles: ordered prefixes find candidates, whole sets verify them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tools import forget, materialise
from .common import append_columns, unused
from .simhash import connected

SHINGLE = 5
NUM, DEN = 4, 5  # least similarity, 0.8, as a fraction: every comparison is one of whole numbers
COMMON = 32  # shingles in more prefixes than this go to the end of the order; a matter of cost, not of results
SLOTS = 1 << 24  # of ids, for the filter of rows whose sets are asked for


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word k-grams; words as in ``simhash.fingerprint``.

    A text of fewer than k words is one shingle, one without a word has none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*[found[i:] for i in range(k)])) if len(found) >= k else [b" ".join(found)]
    return np.array(sorted({xxhash.xxh64_intdigest(g) for g in grams}), np.uint64)


def name_of(own: np.ndarray) -> bytes:
    """128 bits that name a set of shingles: equal sets have equal names."""
    return xxhash.xxh128_digest(own.tobytes())


def parities(own: np.ndarray) -> bytes:
    """Two to four bits for each shingle: whether the shingles that fall on a bit are odd in number.

    Shingles in both of two sets cancel out, so bits that differ come from shingles of one set only, each from one at least.
    """
    size = 64 << max(0, (2 * len(own) - 1).bit_length() - 6)
    return np.packbits(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def most_shared(na: int, a: bytes, nb: int, b: bytes) -> int:
    """Shingles that two sets of these sizes and parities share, at most; the longer parities are folded to the length of the shorter."""
    x, y = (int.from_bytes(v, "little") for v in (a, b))
    size, least = 8 * len(a), 8 * len(b)
    if size < least:
        x, y, size, least = y, x, least, size
    while size > least:
        size >>= 1
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (na + nb - (x ^ y).bit_count()) // 2


def prefix_size(n: int) -> int:
    """Sets of similarity NUM / DEN or more share one of their first so many shingles, in any one order of all."""
    return n - -(-n * NUM // DEN) + 1 if n else 0


def _prefixes(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(id, s, n, bits, prefix): name, size and parities of each row's set, and its first shingles: common ones last, commonest at the very end."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        rank = {v: i for i, v in enumerate(shared.value.tolist(), 1)}
        for batch in batches:
            names, sizes, bits, prefixes = [], [], [], []
            for text in batch.column("t"):
                own = shingles(text.as_py())
                names.append(name_of(own))
                sizes.append(len(own))
                bits.append(parities(own))
                late = np.array([rank.get(v, 0) for v in own.tolist()], np.int64) if rank else np.zeros(len(own), np.int64)
                prefixes.append(own[np.argsort(late, kind="stable")][:prefix_size(len(own))].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()),
                                              pa.array(prefixes, pa.list_(pa.int64()))], names=["id", "s", "n", "bits", "prefix"])

    return docs.mapInArrow(run, "id long, s binary, n int, bits binary, prefix array<long>")


def _sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(s, own): the whole sets that are asked for, and perhaps a few others; ``asked`` has the id of a row of each."""
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS)).cast("int").alias("slot")  # that of a null id too
    # at most SLOTS small numbers, whatever is asked for
    slots = asked.select(slot).distinct().toArrow()["slot"].to_numpy()
    mask = np.zeros(SLOTS, bool)
    mask[slots] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(mask))

    def run(batches):
        for batch in batches:
            at = batch.column("slot").to_numpy()
            own = [shingles(text.as_py()) for text in batch.column("t").filter(pa.array((shared.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))]
            yield pa.RecordBatch.from_arrays([pa.array([name_of(v) for v in own], pa.binary()), pa.array([v.view(np.int64) for v in own], pa.list_(pa.int64()))],
                                             names=["s", "own"])

    return docs.select("t", slot).mapInArrow(run, "s binary, own array<long>")


def _enough(overlap: Column, a: str, b: str) -> Column:
    """Whether sets of the sizes a and b with this overlap, or at most this overlap, can be similar enough."""
    return overlap * (NUM + DEN) >= (F.col(a) + F.col(b)) * NUM


def _likely(met: DataFrame) -> DataFrame:
    """(a, b, na, nb, c): the pairs that can still be similar enough after all that their prefixes share.

    ``met`` has one row (a, na, left_a, b, nb, left_b) per shared shingle of two prefixes. At most c shared ones and what stands
    behind the last of them in either set can be in both; for texts that share a passage only this is far too little.
    """
    pairs = met.groupBy("a", "na", "b", "nb").agg(F.count(F.lit(1)).alias("c"), F.min("left_a").alias("la"), F.min("left_b").alias("lb"))
    return pairs.filter(_enough(F.col("c") + F.least("la", "lb") - 1, "na", "nb")).select("a", "b", "na", "nb", "c")


def _possible(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb), written: the pairs that by their parities can be similar enough; no other pair is.

    Most candidates share a passage and little else. They end here, and their sets need not travel.
    """
    met = pairs.join(names.select(F.col("k").alias("a"), F.col("bits").alias("bits_a")), "a").join(names.select(F.col("k").alias("b"), F.col("bits").alias("bits_b")), "b")

    def run(batches):
        for batch in batches:
            na, nb, a, b = (batch.column(c).to_pylist() for c in ("na", "nb", "bits_a", "bits_b"))
            stay = [most_shared(m, x, n, y) * (NUM + DEN) >= (m + n) * NUM for m, x, n, y in zip(na, a, nb, b)]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(stay, pa.bool_()))

    return materialise(met.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a long, b long, na int, nb int"))


def _verified(docs: DataFrame, names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the pairs whose whole sets are similar enough.

    Each set goes straight to the centres it is compared with, once for each of its pairs, that of a centre once: what is
    written between the two shuffles is all that ever lies on disk of the sets.
    """
    asked = materialise(
        pairs.join(names.withColumnRenamed("k", "b"), "b").select("s", "id", "a", "b", "na", "nb")
        .unionByName(pairs.select("a").distinct().join(names.withColumnRenamed("k", "a"), "a").select("s", "id", "a"), allowMissingColumns=True))
    sent = materialise(_sets(docs, asked).dropDuplicates(["s"]).join(asked.drop("id"), "s").drop("s"))
    forget(asked)
    centres = sent.filter("b is null").select("a", F.col("own").alias("own_a"))
    both = sent.filter("b is not null").join(centres, "a") \
        .select("a", "b", "na", "nb", F.size(F.array_intersect("own", "own_a")).alias("both"))
    out = materialise(both.filter(_enough(F.col("both"), "na", "nb")).select("a", "b"))
    forget(sent)
    return out


def _to_hubs(pairs: DataFrame) -> DataFrame:
    """The pairs, turned so that a is the set of more pairs: sets are sent to a, so a hub is sent once instead of once per pair."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("node").alias("d"))
    known = pairs.join(degree.toDF("a", "da"), "a").join(degree.toDF("b", "db"), "b")
    turned = (F.col("db") > F.col("da")) | ((F.col("db") == F.col("da")) & (F.col("b") < F.col("a")))

    def one(first: str, second: str) -> Column:
        return F.when(turned, F.col(second)).otherwise(F.col(first)).alias(first)

    return known.select(one("a", "b"), one("b", "a"), one("na", "nb"), one("nb", "na"))


def links(docs: DataFrame, numbers: DataFrame, names: DataFrame) -> DataFrame:
    """(a, b): pairs of set numbers that connect all sets of similarity NUM / DEN or more.

    ``docs`` has id and t, ``numbers`` one row (k, n, prefix) per distinct set and is deleted once it is read, ``names`` its (k, s, bits, id). Two sets similar enough share a shingle of both prefixes,
    and at the first that they share the rest of either set is long enough; no such pair is left out. First each set is
    compared with one other, of the first sets of its shingles the one it shares most with, which connects most of a large group of near copies by as many
    pairs as it has members; then all pairs that are not connected yet are compared.
    """
    all_posts = numbers.select("k", "n", F.posexplode("prefix").alias("at", "shingle")) \
        .select("shingle", "k", "n", (F.col("n") - F.col("at")).alias("left"))
    again = all_posts.groupBy("shingle").agg(F.count("n").alias("df")).filter("df > 1").select("shingle")
    posts = materialise(all_posts.join(again, "shingle"))
    forget(numbers)

    def candidate(n: str, left: str) -> Column:
        return _enough(F.least(F.col("left"), F.col(left)), "n", n)

    least = posts.groupBy("shingle").agg(F.min("k").alias("pk"))
    least = posts.join(least, "shingle").filter("k = pk").select("shingle", "pk", F.col("n").alias("pn"), F.col("left").alias("pleft"))
    star = posts.join(least, "shingle").filter((F.col("k") != F.col("pk")) & candidate("pn", "pleft")) \
        .select(F.col("pk").alias("a"), F.col("pn").alias("na"), F.col("pleft").alias("left_a"), F.col("k").alias("b"), F.col("n").alias("nb"), F.col("left").alias("left_b"))
    # counted over some of the shared shingles only, which may leave a pair out here: it then is among all pairs below
    best = _likely(star).groupBy("b", "nb").agg(F.max(F.struct(F.col("c"), (-F.col("a")).alias("a"), "na")).alias("p")) \
        .select((-F.col("p.a")).alias("a"), "b", F.col("p.na").alias("na"), "nb")
    best = materialise(best)
    near = _possible(names, best)
    forget(best)
    first = _verified(docs, names, near)
    parts = connected(first).withColumnRenamed("node", "k")
    placed = materialise(posts.join(parts, "k", "left").withColumn("root", F.coalesce("root", "k")))
    forget(near, posts)
    open_ = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("shingle")
    some = materialise(placed.join(open_, "shingle", "left_semi"))
    forget(placed)
    other = some.select("shingle", F.col("k").alias("pk"), F.col("n").alias("pn"), F.col("left").alias("pleft"), F.col("root").alias("proot"))
    rest = some.join(other, "shingle").filter((F.col("k") < F.col("pk")) & (F.col("root") != F.col("proot")) & candidate("pn", "pleft")) \
        .select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("left").alias("left_a"), F.col("pk").alias("b"), F.col("pn").alias("nb"), F.col("pleft").alias("left_b"))
    rest = materialise(_likely(rest).drop("c"))
    forget(some)
    near = _possible(names, rest)
    forget(rest)
    turned = materialise(_to_hubs(near))
    forget(near)
    second = _verified(docs, names, turned)
    forget(turned)
    return first.union(second)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, s, group): one row per row of ``docs``; rows with the same group are near copies.

    Rows are connected whose shingle sets have a Jaccard similarity of NUM / DEN or more, and whatever these links connect.
    Texts without a word are one group. Groups are numbers without a meaning.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t"))
    # exact copies count too: which shingles are common is a matter of cost alone
    seen = _prefixes(rows, np.zeros(0, np.uint64)).select(F.explode("prefix").alias("shingle")) \
        .groupBy("shingle").agg(F.count("shingle").alias("df"))
    # at most one in COMMON of the prefixes' shingles
    common = seen.filter(F.col("df") > COMMON).orderBy("df", "shingle").toArrow()["shingle"].to_numpy().view(np.uint64)
    marked = materialise(_prefixes(rows, common))
    # a written number for each distinct set: what travels afterwards are numbers
    numbers = materialise(marked.groupBy("s").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"), F.min("id").alias("id")).withColumn("k", F.monotonically_increasing_id()))
    names, of_row = materialise(numbers.select("k", "s", "bits", "id")), materialise(marked.select("id", "s"))
    forget(marked)
    groups = connected(links(rows, numbers, names)).withColumnRenamed("node", "k")
    of_set = materialise(names.join(groups, "k", "left").select("s", F.coalesce("root", "k").alias("group")))
    out = materialise(of_row.join(of_set, "s"))
    forget(names, of_row, of_set)
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row of the smallest id stays.

    Null ids come last. Of rows that repeat the chosen id and set one stays, that of the smallest text.
    """
    missing, key, name, n = unused(docs, "_missing", "_id", "_set", "_n")
    chosen = near_copies(docs, id_col, text) \
        .select("group", F.col("id").isNull().alias(missing), F.coalesce(F.col("id"), F.lit(0)).alias(key), F.col("s").alias(name)) \
        .groupBy("group").agg(F.min(F.struct(missing, key, name)).alias("k")).select("k.*")

    def start():
        return lambda texts: [[name_of(shingles(t)) for t in texts]]

    own = F.col(id_col).cast("long")
    rows = append_columns(docs, text, [T.StructField(name, T.BinaryType())], start) \
        .withColumn(missing, own.isNull()).withColumn(key, F.coalesce(own, F.lit(0)))
    w = Window.partitionBy(missing, key, name).orderBy(text)
    return rows.join(chosen, [missing, key, name]).withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).select(docs.columns)
