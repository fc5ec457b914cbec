"""Helpers shared by the operators: Arrow maps that append columns, text slices, rolling hashes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer text is a slice of its own

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(key: Column, parts: int, part: int) -> Column:
    """True where crc32 of the key's text falls in the held-out part; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows that hold about ``limit`` characters; null reads as empty."""
    part, start, size = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if part and size + len(text) > limit:
            yield start, part
            part, start, size = [], i, 0
        part.append(text)
        size += len(text)
    if part:
        yield start, part


def append_columns(df: DataFrame, text: str, fields: list[T.StructField],
                   start: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """``df`` with columns computed from its text column, task by task and slice by slice.

    ``start()`` runs once in each task and returns a function from a list of texts to one array or list per
    field. Columns of ``df`` that bear the name of a field are replaced.
    """
    kept = df.drop(*[f.name for f in fields])
    types = [pa_type(f.dataType) for f in fields]
    names = kept.columns + [f.name for f in fields]
    at = kept.columns.index(text)

    def run(batches):
        compute = start()
        for batch in batches:
            for first, texts in text_slices(batch.column(at)):
                out = [pa.array(c, t) for c, t in zip(compute(texts), types, strict=True)]
                yield pa.RecordBatch.from_arrays(batch.slice(first, len(texts)).columns + out, names=names)

    return kept.mapInArrow(run, T.StructType(kept.schema.fields + fields))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


class RollingHash:
    """64-bit polynomial hashes of all spans of an integer array, from one prefix sum.

    Values are mixed first; the hash of [s, e) is (S[e] - S[s]) / base**s modulo 2**64, so equal spans have
    equal hashes wherever they stand. Two bases give an identity of 128 bits.
    """

    BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)

    def __init__(self, which: int = 0):
        self.base = self.BASES[which]
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = 1 << int(n).bit_length()
            self.powers = self._row(self.base, size)
            self.inverses = self._row(self.inverse, size)

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    @staticmethod
    def mixed(values: np.ndarray) -> np.ndarray:
        x = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))

    def prefix(self, mixed: np.ndarray) -> np.ndarray:
        self._grow(len(mixed))
        out = np.zeros(len(mixed) + 1, np.uint64)
        np.cumsum(mixed * self.powers[:len(mixed)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self.inverses[starts]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each (start, length), one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift
