"""Sets and lists of large groups: bits and first places for fixed words, keyed rows for open values.

A group aggregate over these has a fixed number of plain numbers, combined on the map side, however many rows a group
has. Open values stay rows (group, field, value) with the place they were first seen at; only a sink that writes one
cell per group puts them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INNER = 1 << 20  # places inside one list that are told apart; later ones share the last place and go by value


def word_bits(tags: Column, words: list[str]) -> Column:
    """Bit i is set if the i-th word is among the tags; combine with ``bit_or``."""
    out = F.lit(0).cast("long")
    for i, w in enumerate(words):
        out = out + F.when(F.array_contains(tags, F.lit(w)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return out


def words_of_bits(mask: Column, words: list[str]) -> Column:
    """Array of the words whose bit is set, in their order."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, w) for i, w in enumerate(words)]))


def other_words(tags: Column, words: list[str]) -> Column:
    """Tags that are none of the words."""
    return F.array_except(tags, F.array(*[F.lit(w) for w in words]))


def place_of(order: Column | str, i: Column | int = 0) -> Column:
    """One number for the order of a row and a place in one of its lists."""
    inner = F.least(i, F.lit(_INNER - 1)) if isinstance(i, Column) else F.lit(i)
    return (F.col(order) if isinstance(order, str) else order).cast("long") * _INNER + inner


def first_places(field: str, tags: Column, words: list[str], order: str) -> list[Column]:
    """One aggregate per word: the first place at which the group has it."""
    def place(w: str) -> Column:
        at = F.array_position(tags, F.lit(w))
        return F.min(F.when(at > 0, place_of(order, (at - 1).cast("int"))))
    return [place(w).alias(f"_{field}{i}") for i, w in enumerate(words)]


def words_in_order(field: str, words: list[str], others: Column) -> Column:
    """Array of the words seen and of ``others`` (array<struct<first, v>>), by first place, then value."""
    known = F.array(*[F.when(F.col(f"_{field}{i}").isNotNull(), F.struct(F.col(f"_{field}{i}").alias("first"), F.lit(w).alias("v"))) for i, w in enumerate(words)])
    empty = F.array().cast("array<struct<first:bigint,v:string>>")
    return F.transform(F.sort_array(F.concat(F.array_compact(known), F.coalesce(others, empty))), lambda x: x["v"])


def open_values(df: DataFrame, keys: list[str], fields: dict[str, Column], order: str = "ord") -> DataFrame:
    """(keys, f, v, first, n): one row per distinct value of a field (array<string>) in a group.

    Rows of a hot group are dealt by value and combined on the map side.
    """
    arrays = [F.transform(c, (lambda f: lambda x, i: F.struct(F.lit(f).alias("f"), x.alias("v"), place_of(order, i).alias("p")))(f)) for f, c in fields.items()]
    rows = df.select(*keys, F.explode(F.concat(*arrays)).alias("e")).select(*keys, "e.f", "e.v", "e.p").filter("v is not null")
    return rows.groupBy(*keys, "f", "v").agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n"))


def seen(field: str) -> Column:
    """Aggregate of a sink: array<struct<first, v>> of a field's values, unsorted."""
    return F.collect_list(F.when(F.col("f") == field, F.struct("first", "v")))


def by_place(values: Column) -> Column:
    return F.transform(F.sort_array(values), lambda x: x["v"])


def by_name(values: Column) -> Column:
    return F.sort_array(F.transform(values, lambda x: x["v"]))
