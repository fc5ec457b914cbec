"""Ordering, ranking and packing that stay distributed when one group holds most of the rows."""

from __future__ import annotations

import gc
import os
import tempfile
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .groups import place_of


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the session's setting.

    Without the setting a session on one machine gets a fresh folder; on a cluster that is an error, as
    executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stratloom-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints for tables one job writes and reads back."""
    return os.path.join(checkpoint_root(spark), f"{name}-{os.urandom(6).hex()}")


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage through a table in the shared checkpoint folder.

    Lost executors then re-read files instead of repeating a loop, and later stages read only the columns
    they need.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[table] = path
    return table


# folders of the tables that materialise() has written, as long as their DataFrames live
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def forget(*tables: DataFrame | None) -> None:
    """Delete the folders of materialised tables; everything built on them must have been written by now.

    DataFrames that materialise() did not write are left alone. Spark removes the shuffle files of finished steps when the
    driver collects its garbage, by default every half hour; long loops would fill the disks until then, so it is asked for here.
    """
    spark = None
    for table in tables:
        path = _WRITTEN.pop(table, None) if table is not None else None
        if path:
            spark = table.sparkSession
            remove(spark, path)
    if spark is not None:
        gc.collect()
        spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its values take at most ``most`` bytes; a larger one is left to shuffle joins.

    The size is counted, not estimated, so ``df`` should be a written table.
    """
    return F.broadcast(df) if fits(df, most) else df


def fits(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the values of a written table take at most ``most`` bytes."""
    width = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(8) for f in df.schema]
    size = df.agg(F.sum(sum(width, F.lit(16)))).first()[0] or 0
    return size <= most


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Give a scan of few splits to all cores; a scan that already has enough splits stays unshuffled.

    A Parquet file is split by row groups, so a small file with one row group would keep all the text work
    of its rows in one task.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots, *by)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row.

    A plain column is put in the place of its name wherever it is used, also in filters that move below joins, and is
    computed anew there; the result of a generator is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordinal(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "ordinal",
            start: int = 0, total: str | None = None) -> DataFrame:
    """Number the rows of each group (of the whole table when ``keys`` is empty) by ``order``.

    A window over a group would put that group into one task. Here the rows are range-partitioned by
    (keys, order), so a large group spans many partitions; each partition numbers its own rows and adds
    the count of the group's rows in earlier partitions. Ids depend on the order alone, so it must be
    total. ``total`` names an optional column for the group size.
    """
    spark = df.sparkSession
    by = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = materialise(df.repartitionByRange(_parallelism(spark), *by)
                         .withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per group and partition: the offsets are small even for a group that fills the cluster
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    # keys may be NULL: offsets meet their rows by null-safe equality
    offsets = counts.withColumn("_base", F.coalesce(
        F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_n").over(w))
    local = Window.partitionBy(*keys, "_part").orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    known = offsets.select(F.col("_part").alias("_p"), "_base", *([total] if total else []), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = ranged.withColumn("_row", F.row_number().over(local)).join(known, same)
    return out.withColumn(name, F.col("_base") + F.col("_row") - 1 + start).drop("_part", "_p", "_base", "_row", *[f"_k{i}" for i in range(len(keys))])


def first_rows(df: DataFrame, keys: list[str], order: list[Column], k: int | None = 1) -> DataFrame:
    """First ``k`` rows of each group, all for None; the limit is applied on the map side too, so hot groups stay small."""
    if k is None:
        return df
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def melt_values(df: DataFrame, keys: list[str], fields: dict[str, Column], order: str = "ord",
                inner_order: bool = False, known: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per (group, field, distinct value) with its first and last position and its row count.

    Each field is a Column of array<string>. The aggregate combines on the map side and spreads a hot
    group over its distinct values. With ``inner_order`` a position also counts the place in the array; it stays one
    number (:func:`groups.place_of`), as the least of two structs would need all rows sorted first. ``known`` words of a
    field have no rows, the others keep their places.
    """
    def tagged(field: str):
        return lambda x, i: F.struct(F.lit(field).alias("f"), x.alias("v"), i.alias("i"))

    def tagged_list(f: str, c: Column) -> Column:
        pairs = F.transform(c, tagged(f))
        return F.filter(pairs, lambda p: ~p["v"].isin(known[f])) if f in (known or {}) else pairs

    pairs = F.concat(*[tagged_list(f, c) for f, c in fields.items()])
    rows = df.select(*keys, F.col(order).alias("_o"), F.explode(pairs).alias("_p"))
    pos = place_of("_o", F.col("_p.i")) if inner_order else F.col("_o")
    return rows.groupBy(*keys, F.col("_p.f").alias("f"), F.col("_p.v").alias("v")).agg(
        F.min(pos).alias("first"), F.max(pos).alias("last"), F.count(F.lit(1)).alias("n"))


def keep_first(melted: DataFrame, keys: list[str], cap: int | None) -> DataFrame:
    """The ``cap`` values of each (group, field) seen first."""
    return first_rows(melted, [*keys, "f"], [F.col("first"), F.col("v")], cap)


def melt_capped(df: DataFrame, keys: list[str], fields: dict[str, Column], caps: dict[str, int],
                order: str = "ord", inner_order: bool = False) -> DataFrame:
    """:func:`melt_values` of all fields in one pass; capped fields keep only their first values.

    The distinct values are written once and read by both branches, so the input is parsed once.
    """
    melted = melt_values(df, keys, fields, order, inner_order)
    if not caps:
        return melted
    melted = materialise(melted)
    capped = F.col("f").isin(list(caps))
    return melted.filter(~capped).unionByName(keep_first(melted.filter(capped), keys, max(caps.values())))


def values_sorted(field: str) -> Column:
    """Aggregate over melted rows: distinct values of a field in alphabetical order."""
    return F.sort_array(F.collect_list(F.when(F.col("f") == field, F.col("v"))))


def first_value(field: str) -> Column:
    """Aggregate over melted rows: the value of a field seen first."""
    return F.min(F.when(F.col("f") == field, F.struct("first", "v")))["v"]


def last_value(field: str) -> Column:
    """Aggregate over melted rows: the value of a field seen last."""
    return F.max(F.when(F.col("f") == field, F.struct("last", "v")))["v"]


def values_seen(field: str, cap: int | None = None) -> Column:
    """Aggregate over melted rows: distinct values of a field in order of first appearance."""
    packed = F.sort_array(F.collect_list(F.when(F.col("f") == field, F.struct("first", "v"))))
    if cap is not None:
        packed = F.slice(packed, 1, cap)
    return F.transform(packed, lambda s: s["v"])


def one_or_none(c: Column) -> Column:
    return F.array_compact(F.array(c))


def text_or_nd(arr: Column, sep: str = "; ") -> Column:
    return F.when(F.size(arr) > 0, F.array_join(arr, sep)).otherwise("ND")
