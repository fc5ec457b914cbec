"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space as Python's str.strip sees it, and the letters of a word in this corpus.
SPACE = r"\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"0-9A-Za-zА-Яа-яЁё_"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body`` without re-evaluating it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_SPACES = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(x) for x in range(0x2000, 0x200b))
           + "\u2028\u2029\u202f\u205f\u3000")


def strip(c: Column | str) -> Column:
    """Trim Unicode white space; a character-set trim, far cheaper than a regex."""
    return F.btrim(col(c), F.lit(_SPACES))


def squash(c: Column | str) -> Column:
    """Every run of white space becomes one space; the regex runs only where there is such a run."""
    flat = F.translate(col(c), _SPACES, " " * len(_SPACES))
    return let(flat, lambda s: F.when(F.contains(s, F.lit("  ")), F.regexp_replace(s, " {2,}", " ")).otherwise(s))


def contains_any(c: Column, words: list[str]) -> Column:
    """True when the text holds any of the literal words: plain substring tests on a value computed once."""
    return let(c, lambda s: reduce(lambda a, b: a | b, [F.contains(s, F.lit(w)) for w in words]))


def bounded(pattern: str) -> str:
    """Regex for ``pattern`` as a whole word, spelled without the engine-dependent word boundary."""
    return rf"(?<![{WORD}])(?:{pattern})(?![{WORD}])"


def not_missing(c: Column, *extra: str) -> Column:
    return c.isNotNull() & ~c.isin("", "ND", "None", *extra)


def dedupe_by(pairs: Column, key: str = "k") -> Column:
    """Keep the first struct of every key in an array of structs."""
    return let(pairs, lambda ps: F.filter(
        ps, lambda p, i: F.array_position(ps[key], p[key]) == i + 1))
