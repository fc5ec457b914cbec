"""Prefix trie of conversations: ternary search trees per range shard, whose boundary nodes are merged."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tools import forget, materialise

SHARD_TURNS = 1 << 20  # turns of distinct conversations in a shard, about
HOT_SHARE = 1000  # turns that are a thousandth of all or more, at most a thousand of them, are looked up without a shuffle
MEMBERS = 10  # bits: members of a conversation are packed by ranges of 1,024 ids
HEAD = 3  # turns that another conversation may lend
FAMILY = 20  # conversations that share the turns of the first of them
WORD = r"[^\x20\x09-\x0D]+"

_LONGS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, key, words) of each row; ``key`` is a SHA-256 of role and text, so that texts stay where they are."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def encode_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words): the turns of each conversation in order, as numbers of a dictionary of distinct turns.

    The dictionary is written with its numbers, so a lost task cannot renumber it. Turns that are very common are few
    and are broadcast; the others meet the dictionary by a shuffle in which no key is common.
    """
    book = materialise(turns.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()))
    total = book.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(book.filter(F.col("n") * HOT_SHARE >= total).select("key", F.col("id").alias("hot_id")))
    marked = turns.join(often, "key", "left")
    rest = marked.filter("hot_id is null").join(book.filter(F.col("n") * HOT_SHARE < total).select("key", "id"), "key")
    coded = marked.filter("hot_id is not null").withColumnRenamed("hot_id", "id").unionByName(rest.drop("hot_id"))
    each = F.struct(F.col("turn").isNotNull().alias("t"), "turn", "role", "key", "id", "words")
    return coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("s")) \
        .select("conv_id", F.col("s.id").alias("ids"), F.col("s.words").alias("words"))


def rebuild(coded: DataFrame) -> DataFrame:
    """Each conversation with its first turns taken from the first of its family, as many as its id says."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    own = coded.withColumn("h", h).withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY)
    heads = coded.filter(F.col("conv_id") % FAMILY == 0) \
        .select(F.col("conv_id").alias("first"), *[F.slice(c, 1, HEAD).alias(f"head_{c}") for c in ("ids", "words")])

    def joined(c: str) -> Column:
        rest = F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))
        lent = F.coalesce(F.slice(f"head_{c}", F.lit(1), F.col("h")), F.array().cast("array<bigint>"))
        return F.concat(lent, rest).alias(c)

    return own.join(heads, "first", "left").select("conv_id", joined("ids"), joined("words"))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """(ids, words, conv_id, n, ends): one row per distinct sequence, its smallest member, members and their digest.

    Members are packed range by range on both sides of the shuffle; only packed ranges of one sequence meet in a
    task, which streams them in order through the digest. Tasks hold one packed range at a time.
    """
    packed = sequences.groupBy("ids", F.shiftright("conv_id", MEMBERS).alias("part")).agg(
        F.first("words").alias("words"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("members"))
    ordered = packed.repartition("ids").sortWithinPartitions("ids", "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*[b.column(c).to_pylist() for c in ("ids", "words", "conv_id", "n", "members")], strict=True)
        out = []
        for ids, group in groupby(rows(), key=lambda r: r[0]):
            sha, n, first, words = None, 0, None, None
            for _, words_, conv, count, members in group:
                if sha is None:
                    sha, first, words = hashlib.sha256(members.encode()), conv, words_
                else:
                    sha.update(b"," + members.encode())
                n += count
            out.append((ids, words, first, n, sha.hexdigest()))
            if len(out) == 1024:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    many = pa.list_(pa.int64())
    schema = pa.schema([("ids", many), ("words", many), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    return ordered.mapInArrow(digest, "ids array<bigint>, words array<bigint>, conv_id bigint, n bigint, ends string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def medians(n: int) -> Iterator[int]:
    """0 … n - 1, the middle one first, then the middles of the halves, level by level."""
    level = [(0, n)] if n else []
    while level:
        below = []
        for a, b in level:
            mid = (a + b) // 2
            yield mid
            below += [(x, y) for x, y in ((a, mid), (mid + 1, b)) if x < y]
        level = below


class TernaryTree:
    """Ternary search tree over sequences of numbers; node 0 is the empty sequence.

    ``low`` and ``high`` lead to siblings of a smaller and a larger number, ``equal`` to the children. Parents are
    always older than their children.
    """

    def __init__(self):
        self.number, self.low, self.high, self.equal = array("q", [0]), array("q", [-1]), array("q", [-1]), array("q", [-1])
        self.parent, self.depth, self.words = array("q", [-1]), array("q", [0]), array("q", [0])

    def _new(self, number: int, words: int, parent: int) -> int:
        for column, value in ((self.number, number), (self.low, -1), (self.high, -1), (self.equal, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.words, words)):
            column.append(value)
        return len(self.number) - 1

    def insert(self, ids: list[int], words: list[int]) -> int:
        """Node of the sequence; missing nodes are added."""
        at = 0
        for number, w in zip(ids, words, strict=True):
            side, up = self.equal, at
            at = side[up]
            if at < 0:
                at = side[up] = self._new(number, w, up)
                continue
            top = up
            while self.number[at] != number:
                side = self.low if number < self.number[at] else self.high
                if side[at] < 0:
                    side[at] = self._new(number, w, top)
                at = side[at]
        return at

    def path(self, node: int) -> list[int]:
        """Nodes from the top down to ``node``."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


def _shard_rows(shard: int, sequences: list[tuple]) -> Iterator[tuple]:
    """Rows of one shard's tree: finished nodes, and nodes on its first and last path, which other shards may share."""
    tree = TernaryTree()
    ends: dict[int, tuple[int, int, str]] = {}
    for i in medians(len(sequences)):
        ids, words, conv, n, digest = sequences[i]
        ends[tree.insert(ids, words)] = (conv, n, digest)
    size = len(tree.number)
    far = (1 << 63) - 1
    n, conv, kids = array("q", bytes(8 * size)), array("q", [far]) * size, array("q", bytes(8 * size))
    leaves, saved = array("q", bytes(8 * size)), array("q", bytes(8 * size))
    for node, (first, count, _) in ends.items():
        n[node], conv[node] = count, first
    first, last = (tree.path(tree.insert(*sequences[i][:2])) for i in (0, -1))
    edge = {node: b"" for node in (*first, *last)}
    inner = {node: [0, 0, 0] for node in edge}  # children, leaves and savings below that lie off these paths
    for node in range(size - 1, -1, -1):  # children come before their parents
        if not kids[node]:
            leaves[node] = 1
        saved[node] += (n[node] - 1) * tree.words[node]
        up = tree.parent[node]
        if up >= 0:
            n[up] += n[node]
            conv[up] = min(conv[up], conv[node])
            kids[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            if up in inner and node not in edge:
                for k, value in enumerate((1, leaves[node], saved[node])):
                    inner[up][k] += value
    for path in (first, last):
        for up, node in zip(path, path[1:], strict=False):
            edge[node] = hashlib.sha256(edge[up] + tree.number[node].to_bytes(8, "little")).digest()[:16]
    for node in range(size):
        up = tree.parent[node]
        on_edge, under = node in edge, up in edge
        yield (shard, edge.get(node), edge[up] if under else None, conv[node], tree.depth[node], conv[up] if up >= 0 and not under else None,
               n[node], kids[node], leaves[node], saved[node], ends[node][2] if node in ends else None,
               tree.words[node] if on_edge else None, *(inner[node] if on_edge else (None, None, None)))


_SHARD = pa.schema([("shard", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), *[(c, pa.int64()) for c in _LONGS],
                    ("ends", pa.string()), ("words", pa.int64()), ("in_children", pa.int64()), ("in_leaves", pa.int64()), ("in_saved", pa.int64())])
_SHARD_SQL = "shard bigint, key binary, parent_key binary, " + ", ".join(f"{c} bigint" for c in _LONGS) \
    + ", ends string, words bigint, in_children bigint, in_leaves bigint, in_saved bigint"


def shard_nodes(distinct: DataFrame, shards: int) -> DataFrame:
    """Nodes of a tree for each range of the distinct sequences.

    Nodes off the first and last path are finished but for the parent's id where that lies on one (``parent_key``); nodes on
    them have a ``key`` that is the same in all shards, and what lies below them in this shard.
    """
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        rows: list[tuple] = []
        for b in batches:
            rows += zip(*[b.column(c).to_pylist() for c in ("ids", "words", "conv_id", "n", "ends")], strict=True)
        out = []
        for row in _shard_rows(TaskContext.get().partitionId(), rows) if rows else ():
            out.append(row)
            if len(out) == 8192:
                yield _batch(out, _SHARD)
                out = []
        if out:
            yield _batch(out, _SHARD)

    return distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids").mapInArrow(trees, _SHARD_SQL)


def merge_boundaries(nodes: DataFrame) -> DataFrame:
    """All nodes of the trie from the rows of :func:`shard_nodes`, each once.

    A node on the first or last path of its shard that no other shard has is finished as well. Of the others
    members, children and ends are added up shard by shard, and leaves and savings come up from the shared nodes below
    by doubling steps, as many as the logarithm of the longest shared prefix.
    """
    edges = nodes.filter("key is not null")
    merged = materialise(edges.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.count(F.lit(1)).alias("shards"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.first("words").alias("words"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("in_children", "in_leaves", "in_saved", "n_children", "n_leaves", "saved_tokens")]))
    alone = merged.filter("shards = 1 and depth > 0")
    below = merged.filter("depth > 0").withColumn("alone", F.col("shards") == 1).groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.when(F.col("alone"), F.col("n_leaves"))).alias("l"), F.sum(F.when(F.col("alone"), F.col("saved_tokens"))).alias("s"))
    zero = F.lit(0)
    shared = merged.filter("shards > 1 or depth = 0").join(below, "key", "left").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", "ends", (F.col("in_children") + F.coalesce("k", zero)).alias("n_children"),
        (F.col("in_leaves") + F.coalesce("l", zero)).alias("n_leaves"),
        (F.col("in_saved") + F.coalesce("s", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), F.col("parent_key").alias("up"))
    shared = materialise(shared.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))))
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:  # sums so far reach ``step`` levels down; ``up`` is as far up
        risen = shared.filter("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        next_up = shared.select(F.col("key").alias("up"), F.col("up").alias("up2"))
        done = shared
        shared = materialise(shared.join(risen, "key", "left").join(next_up, "up", "left").select(
            "key", "parent_key", "conv_id", "depth", "n_convs", "ends", "n_children", (F.col("n_leaves") + F.coalesce("l", zero)).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", zero)).alias("saved_tokens"), F.col("up2").alias("up")))
        forget(done)
        step *= 2
    columns = [*_LONGS, "ends"]
    ids = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up_conv"))

    def with_parent(df: DataFrame) -> DataFrame:
        return df.drop("parent_conv_id").join(ids, "parent_key", "left").withColumnRenamed("up_conv", "parent_conv_id").select(*columns)

    # nodes under a shared one learn its id from their own shard's row of it: no key is larger than a shard
    here = edges.select("shard", F.col("key").alias("parent_key")).join(ids, "parent_key")
    inner = nodes.filter("key is null")
    under = inner.filter("parent_key is not null").drop("parent_conv_id").join(here, ["shard", "parent_key"]) \
        .withColumnRenamed("up_conv", "parent_conv_id").select(*columns)
    return inner.filter("parent_key is null").select(*columns).unionByName(under) \
        .unionByName(with_parent(alone)).unionByName(with_parent(shared))


def build_trie(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends), one row per node.

    ``sequences`` has conv_id, ids and words, one row per conversation. No rows give no node. A conversation's turns are
    numbers in one row, a shard holds about ``SHARD_TURNS`` of them.
    """
    spark = sequences.sparkSession
    distinct = materialise(distinct_sequences(sequences))
    turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    nodes = materialise(shard_nodes(distinct, shards))
    forget(distinct)
    return merge_boundaries(nodes)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations; ``ends_sha256`` is the digest of the members that end at a node.

    Null roles and texts read as empty, a null turn comes first. Rows of one turn stand by role, then by the
    digest of role and text; repeated rows are turns of their own. Rows without a conversation id belong to none and are
    passed over. Long texts travel as digests. Other columns are ignored. No rows give no nodes.
    """
    sequences = materialise(rebuild(encode_turns(turns_of(conversations))))
    nodes = build_trie(sequences)
    none = hashlib.sha256(b"").hexdigest()
    return nodes.select(*_LONGS, F.coalesce("ends", F.lit(none)).alias("ends_sha256"))
