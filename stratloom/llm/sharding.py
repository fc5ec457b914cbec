"""Shards of a corpus by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # a prime; one hundred slots or more for each shard keep shares within about one per cent


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str, below: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big") % below


def lookup_table(shards: list[str], weights: list[int] | None = None, slots: int = SLOTS) -> np.ndarray:
    """For each slot the number of its shard.

    Each shard has an order of preference over all slots: a start and a step of its own, which reach every slot
    because their number is prime. Shards take turns, in the order given, and claim the first slot of their order
    that is free; a weight gives as many claims a turn. When a shard goes, mostly its own slots change hands.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots or not is_prime(slots):
        raise ValueError("distinct shards, and a prime number of slots not below theirs, are needed")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("one positive weight for each shard is needed")
    at = [_number(s, "start", slots) for s in shards]
    step = [_number(s, "step", slots - 1) + 1 for s in shards]
    table = np.full(slots, -1, np.int32)
    left = slots
    while True:
        for i, w in enumerate(weights):
            for _ in range(w):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % slots
                table[at[i]] = i
                left -= 1
                if not left:
                    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: its MD5 modulo the number of slots; a null key is like an empty one."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str | Column, shards: list[str], weights: list[int] | None = None, slots: int = SLOTS) -> DataFrame:
    """Append ``slot`` and ``shard``; columns of these names are replaced.

    The table has a fixed number of rows and is broadcast, so placing a row is one look-up without a shuffle. Rows
    with equal keys, and so repeated rows and null keys, share a shard. A hot key fills its shard: the key should
    be that of a row or document where shares matter.
    """
    spark = df.sparkSession
    table = lookup_table(shards, weights, slots)
    known = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table.tolist())], "slot int, shard string")
    column = F.col(key) if isinstance(key, str) else key
    names = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    rows = df.select(*names, slot_of(column, slots).alias("slot"))
    return rows.join(F.broadcast(known), "slot").select(*names, "slot", "shard")


def write_shards(df: DataFrame, path: str, key: str | Column, shards: list[str], files: int = 1, **options) -> None:
    """Write one folder per shard with about ``files`` files each, dealt by slot so that no task holds a whole shard."""
    placed = place(df, key, shards, **options)
    part = F.pmod(F.col("slot"), F.lit(files))
    placed.withColumn("_part", part).repartition(len(shards) * files, "shard", "_part").drop("_part", "slot") \
        .write.partitionBy("shard").parquet(path)
