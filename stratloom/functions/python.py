"""Arrow-batched functions for what SQL expressions cannot say, or only slowly: decomposition of any alphabet, search form of whole pages."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

_MARKS = re.compile("[" + "".join(map(chr, (c for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))))) + "]+")


_SLICE = 256  # texts that are Python strings at a time; a matter of memory, not of results


@F.arrow_udf(StringType())
def nfd_strip(s: pa.Array) -> pa.Array:
    """Text without combining marks after canonical decomposition."""
    def bare(x: str | None) -> str | None:
        return x if x is None or x.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", x))

    parts = [pa.array([bare(x) for x in s.slice(i, _SLICE).to_pylist()], pa.string()) for i in range(0, len(s), _SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _search_table() -> np.ndarray:
    """Of each character of 16 bits, after lower case, its byte in Windows-1251 if the search form keeps it, else a space."""
    table = np.full(1 << 16, 32, np.uint8)
    for c in "0123456789abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(ord("а"), ord("я") + 1))):
        table[ord(c)] = c.encode("cp1251")[0]
    table[ord("ё")] = table[ord("е")]
    return table


_SEARCH = _search_table()
_SEARCH_ASCII = bytes(_SEARCH[ord(chr(c).lower())] for c in range(128)) + bytes(128)


def search_bytes(text: bytes | None) -> bytes:
    """``text.norm_search`` of a text in UTF-8, one byte a character; equal texts give equal bytes."""
    if text is None:
        return b""
    if text.isascii():
        flat = text.translate(_SEARCH_ASCII)
    else:
        flat = _SEARCH[np.frombuffer(text.decode().lower().encode("utf-16-le"), "<u2")].tobytes()
    return b" ".join(flat.split())


def with_search_bytes(df: DataFrame, text: str, norm: str = "norm", end: bytes = b"", keep_text: bool = False) -> DataFrame:
    """``df`` with the search form of a text and ``end``; the text itself only if asked for."""
    kept = [f for f in df.schema if keep_text or f.name != text]

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, out = batch.column(text).cast(pa.binary()), []
            for i in range(0, len(raw), _SLICE):
                out += [search_bytes(x) + end for x in raw.slice(i, _SLICE).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(out, pa.binary())], names=[*[f.name for f in kept], norm])

    return df.mapInArrow(forms, StructType([*kept, StructField(norm, BinaryType())]))
