"""SimHash fingerprints, their links within a few bits through sharded BK-trees, and connected groups."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tools import forget, materialise
from .common import append_columns, unused

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = 5  # at most RADIUS differing bits leave BLOCKS - RADIUS blocks untouched
TREE_NODES = 4096  # fingerprints in one tree, at most; a larger shard has several trees
SHARD = 4 * TREE_NODES  # fingerprints in one shard, at most, while bits are left to cut it by
BATCH = 1 << 15


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """64 bits, each set if over half the shingle hashes have it set; 0 without a word.

    Words are runs without ASCII white space after lower-casing A-Z; a text of fewer than k words is one
    shingle.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BATCH):
        part = found[at:min(at + BATCH, n) + k - 1]
        grams = map(b" ".join, zip(*[part[i:] for i in range(k)])) if len(found) >= k else [b" ".join(found)]
        hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            got = np.array([fingerprint(t.as_py()) for t in batch.column("t")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(got)], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(run, "id long, fp long")


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent.

    ``near`` asks for many queries at once: each level of the tree is visited for all queries that reach it,
    and an edge is followed only if its distance is within the radius of the query's distance to the parent.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        self.parent_edge = np.zeros(n, np.int64)
        parent = np.full(n, -1)
        # level by level: all nodes still to be placed stand at some node; the first of those that leave
        # it by the same edge becomes the child there
        waiting, at = np.arange(1, n), np.zeros(max(0, n - 1), np.int64)
        while len(waiting):
            edge = np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            _, first, group = np.unique(at * 65 + edge, return_index=True, return_inverse=True)
            child = waiting[first]
            parent[child] = at[first]
            self.parent_edge[child] = edge[first]
            stay = np.ones(len(waiting), bool)
            stay[first] = False
            waiting, at = waiting[stay], child[group][stay]
        self.children = np.argsort(parent[1:], kind="stable") + 1 if n > 1 else np.zeros(0, np.int64)
        self.first = np.searchsorted(parent[self.children], np.arange(n + 1))

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, node number) of all pairs within the radius."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for base in range(0, len(queries), 1024):
            part = queries[base:base + 1024]
            q, node = np.arange(len(part)), np.zeros(len(part), np.int64)
            while len(q):
                d = np.bitwise_count(part[q] ^ self.values[node]).astype(np.int64)
                hit = d <= radius
                if hit.any():
                    found.append((q[hit] + base, node[hit]))
                n = self.first[node + 1] - self.first[node]
                start = np.repeat(self.first[node] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                child = self.children[start]
                q, d = np.repeat(q, n), np.repeat(d, n)
                go = np.abs(self.parent_edge[child] - d) <= radius
                q, node = q[go], child[go]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's group under the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, up := root[root]):
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _finer(fixed: int, radius: int) -> list[int]:
    """Masks that add to the fixed bits all choices of BLOCKS - radius of BLOCKS blocks of the free ones."""
    free = [i for i in range(64) if not fixed >> i & 1]
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(free, BLOCKS)]
    return sorted({fixed | sum(blocks[i] for i in c) for c in combinations(range(BLOCKS), BLOCKS - radius)})


def links(values: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): links that connect what lies within the radius, at most one per fingerprint and shard.

    ``values`` has a column fp without repetitions. Two numbers that differ in at most ``radius`` bits agree
    in BLOCKS - radius of BLOCKS blocks, so each choice of as many blocks with its value names a shard, and
    every pair to be found meets in one. A shard of more than ``shard`` fingerprints is cut again in the same
    way by its free bits; as fewer and fewer bits are free, shards are bounded. A shard builds trees of bounded size
    and asks each for its own fingerprints; it gives a spanning forest of what it finds, not the pairs.
    """
    rows, masks, found = values.select("fp", F.lit(0).alias("path")), {0: 0}, None
    while True:
        finer = [(p, m) for p, fixed in masks.items() for m in _finer(fixed, radius)]
        # path -> its choices of blocks, a constant
        choices = [F.array(*[F.struct(F.lit(i).alias("next"), F.lit(m - (1 << 64) if m >= 1 << 63 else m).alias("mask"))
                             for i, (p, m) in enumerate(finer) if p == path]) for path in masks]
        at = F.explode(F.get(F.array(*choices), F.col("path"))).alias("c")
        keyed = rows.select("fp", at).select("fp", F.col("c.next").alias("path"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("v"))
        hot = materialise(keyed.groupBy("path", "v").count().filter(F.col("count") > shard).select("path", "v"))
        last = hot.isEmpty()
        grouped = (keyed if last else keyed.join(hot, ["path", "v"], "left_anti")).groupBy("path", "v") \
            .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")
        part = grouped.mapInArrow(_search(radius), "a long, b long")
        found = part if found is None else found.union(part)
        if last:
            return found.distinct()
        rows = materialise(keyed.join(hot, ["path", "v"], "left_semi").select("fp", "path"))
        masks = dict(enumerate(m for _, m in finer))


def _search(radius: int):
    def run(batches):
        for batch in batches:
            out_a, out_b = [], []
            for shard in batch.column("fps"):
                own = np.sort(shard.values.to_numpy())
                bits = own.view(np.uint64)
                if len(own) == 2:
                    if int(bits[0] ^ bits[1]).bit_count() <= radius:
                        out_a.append(own[:1])
                        out_b.append(own[1:])
                    continue
                root = np.arange(len(own))
                for at in range(0, len(own), TREE_NODES):
                    tree = BKTree(bits[at:at + TREE_NODES])
                    for ask in range(at, len(own), TREE_NODES):
                        q, node = tree.near(bits[ask:ask + TREE_NODES], radius)
                        root = _forest(len(own), np.r_[q + ask, np.arange(len(own))], np.r_[node + at, root])
                some = np.flatnonzero(root != np.arange(len(own)))
                out_a.append(own[root[some]])
                out_b.append(own[some])
            a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
            b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): each node that has a link, with the smallest node it reaches.

    Rounds of large-star and small-star: every node's neighbours are handed to its smallest neighbour, which
    halves the depth of the groups. A hub's rows are combined before the shuffle, and its links move away
    from it. Each round is a written table, so that lost executors never repeat the loop.
    """
    now = materialise(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct())
    before = None
    while True:
        both = now.union(now.select("lo", "hi")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = materialise(large)
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", "m")).distinct()
        done, now = now, materialise(small.select(F.col("u").alias("hi"), F.col("v").alias("lo")))
        forget(done, down)
        after = now.agg(F.count("hi"), F.sum(F.hash("hi", "lo").cast("long"))).first()
        if after == before:
            return now.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")) \
                .union(now.select("lo", "lo").distinct())
        before = after


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, fp, component, group): one row per row of ``docs``.

    component is the smallest id of the row's group, group its smallest linked fingerprint. Null and empty texts
    have fingerprint 0 and are linked like any other. Repeated rows stay repeated. A null id is never the
    smallest; a group of null ids alone has a null component. Groups are those of links within ``radius`` bits
    and whatever these links connect. Nothing but fingerprints and ids is shuffled.
    """
    marked = materialise(fingerprints(docs, id_col, text))
    values = materialise(marked.groupBy("fp").agg(F.min("id").alias("least")))
    groups = connected(links(values.select("fp"), radius)).withColumnRenamed("node", "fp")
    known = values.join(groups, "fp", "left").withColumn("group", F.coalesce("root", "fp")).drop("root")
    least = known.filter("group <> fp or least is not null").groupBy("group").agg(F.min("least").alias("component"))
    per_value = materialise(known.select("fp", "group").join(least, "group", "left"))
    return marked.join(per_value, "fp").select("id", "fp", "component", "group")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row of the smallest id stays.

    Null ids come last. Of rows that repeat the chosen id and fingerprint one stays, that of the smallest text.
    """
    groups = near_duplicates(docs, id_col, text, radius)
    names = unused(docs, "_missing", "_id", "_fp", "_n")
    missing, key, fp, n = names
    chosen = groups.select("group", F.col("id").isNull().alias(missing), F.coalesce(F.col("id"), F.lit(0)).alias(key), F.col("fp").alias(fp)) \
        .groupBy("group").agg(F.min(F.struct(missing, key, fp)).alias("k")).select("k.*")

    def start():
        return lambda texts: [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

    own = F.col(id_col).cast("long")
    rows = append_columns(docs, text, [T.StructField(fp, T.LongType())], start) \
        .withColumn(missing, own.isNull()).withColumn(key, F.coalesce(own, F.lit(0)))
    w = Window.partitionBy(missing, key, fp).orderBy(text)
    return rows.join(chosen, [missing, key, fp]).withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).select(docs.columns)
