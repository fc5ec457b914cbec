"""Numbers and ranges written in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import SPACE, bounded, col, let, strip

RANGE_TYPE = "struct<lo:double,hi:double>"


def _null_double() -> Column:
    return F.lit(None).cast("double")


def numbers_in(c: Column) -> Column:
    """All unsigned numbers of a text as doubles; a comma counts as a decimal point."""
    found = F.regexp_extract_all(F.translate(c, ",", "."), F.lit(r"\d+[.]?\d*"), F.lit(0))
    return F.transform(found, lambda x: x.try_cast("double"))


def _one_sided(nums: Column, over: Column, under: Column) -> Column:
    lo, hi = F.array_min(nums), F.array_max(nums)
    return F.struct(
        F.when(under & ~over, _null_double()).otherwise(lo).alias("lo"),
        F.when(over, _null_double()).otherwise(hi).alias("hi"))


def parse_num(c: Column | str, *extra_missing: str) -> Column:
    """"до 5 м", "свыше 3", "120 см", "2–4" → struct(lo, hi) in metres; both NULL when there is no number."""
    missing = ["nd", "", "none", "-", *extra_missing]

    def body(s: Column) -> Column:
        cm = s.rlike(bounded("см|cm"))
        nums = F.transform(numbers_in(s), lambda x: F.when(cm, x / 100).otherwise(x))
        rng = let(nums, lambda n: _one_sided(n, s.rlike("свыше|более|>"), s.rlike(bounded("до") + "|<")))
        return F.when(~s.isin(missing), rng).otherwise(
            F.struct(_null_double().alias("lo"), _null_double().alias("hi")))

    return let(F.coalesce(F.lower(strip(c)), F.lit("")), body)


def parse_joined(c: Column | str) -> Column:
    """";"-joined measurements → struct(smallest low, largest high)."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), ";"), lambda p: parse_num(p))
    return let(parts, lambda ps: F.struct(
        F.array_min(ps["lo"]).alias("lo"), F.array_max(ps["hi"]).alias("hi")))


def parse_range(c: Column | str) -> Column:
    """Text written by :func:`format_range` back to struct(lo, hi), honouring ≥ ≤ > <."""
    def body(s: Column) -> Column:
        rng = let(numbers_in(s), lambda n: _one_sided(n, s.rlike("[≥>]"), s.rlike("[≤<]")))
        return F.when(~s.isin("", "ND", "None"), rng).otherwise(
            F.struct(_null_double().alias("lo"), _null_double().alias("hi")))

    return let(F.coalesce(strip(c), F.lit("")), body)


def _six_digits(v: Column) -> Column:
    """``d.ddddde±xx`` of a positive double, rounded half-even on its exact binary value.

    ``format_string`` rounds the shortest decimal half-up, which differs only where that decimal has exactly
    seven digits and ends in 5. There the sign of (value - decimal) is taken exactly: the value is split
    in two 26-bit halves whose products with a power of ten have no rounding error.
    """
    def settle(p: Column) -> Column:
        seven, v = p["seven"], p["v"]
        exp = F.substring_index(seven, "e", -1).try_cast("int")
        digits = F.translate(F.substring_index(seven, "e", 1), ".", "").try_cast("double")
        scale = F.concat(F.lit("1e"), (6 - exp).cast("string")).try_cast("double")
        big = v * F.lit(134217729.0)
        high = big - (big - v)
        side = F.when(exp >= 6, F.lit(0.0)).otherwise((high * scale - digits) + (v - high) * scale)
        down = (side < 0) | ((side == 0) & F.substring(seven, 7, 1).isin("0", "2", "4", "6", "8"))
        tie = (F.substring(seven, 8, 1) == "5") & (seven.try_cast("double") == v)
        cut = F.concat(F.substring(seven, 1, 7), F.lit("e"), F.substring_index(seven, "e", -1))
        return F.when(tie & down, cut).otherwise(F.format_string("%.5e", v))

    return let(F.struct(F.format_string("%.6e", v).alias("seven"), v.alias("v")), settle)


def fmt_g(c: Column | str) -> Column:
    """Six significant digits without trailing zeros, exponent form below 1e-4 and from 1e6 on."""
    v = col(c)

    def body(sci: Column) -> Column:
        exp = F.substring_index(sci, "e", -1).try_cast("int")
        digits = F.translate(F.substring_index(sci, "e", 1), ".", "")
        fixed = (F.when(exp < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits))
                 .when(exp == 5, digits)
                 .otherwise(F.concat(F.substr(digits, F.lit(1), exp + 1), F.lit("."),
                                     F.substr(digits, exp + 2))))
        tidy = F.when(F.contains(fixed, F.lit(".")), F.regexp_replace(fixed, r"\.?0+$", "")).otherwise(fixed)
        big = F.concat(F.regexp_replace(F.substring_index(sci, "e", 1), r"\.?0+$", ""), F.lit("e"),
                       F.substring_index(sci, "e", -1))
        return F.when((exp < -4) | (exp >= 6), big).otherwise(tidy)

    text = let(_six_digits(F.abs(v)), body)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(v), "nan").when(v == float("inf"), "inf").when(v == float("-inf"), "-inf")
            .when(v == 0, "0").when(v < 0, F.concat(F.lit("-"), text)).otherwise(text))


def format_range(lo: Column, hi: Column, text=fmt_g) -> Column:
    """``x``, ``lo–hi``, ``≥lo``, ``≤hi`` or ``ND``."""
    return (F.when(lo.isNull() & hi.isNull(), "ND")
            .when(hi.isNull(), F.concat(F.lit("≥"), text(lo)))
            .when(lo.isNull(), F.concat(F.lit("≤"), text(hi)))
            .when(lo == hi, text(lo))
            .otherwise(F.concat(text(lo), F.lit("–"), text(hi))))


def elev_bounds(c: Column | str) -> Column:
    """First and last number of a text, as text with a decimal point; empty when there is none."""
    nums = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"-?\d+(?:[.,]\d+)?"), F.lit(0))
    return let(nums, lambda n: F.struct(
        F.coalesce(F.translate(F.get(n, F.lit(0)), ",", "."), F.lit("")).alias("first"),
        F.coalesce(F.translate(F.try_element_at(n, F.lit(-1)), ",", "."), F.lit("")).alias("last")))


def clean_thickness(c: Column | str, limit: float) -> Column:
    """Drop years 1900–2030 and values above ``limit``; tidy what is left, ND when no number is left.

    Cells in which nothing is dropped come back as they are (stripped).
    """
    hole = "\u0000"
    dash = "-–—"

    def bad(tok: Column) -> Column:
        x = F.translate(tok, ",", ".").try_cast("double")
        year = x.between(1900, 2030) & (x == F.floor(x))
        return F.when(tok.rlike(r"^\d"), year | (x > limit)).otherwise(False)

    def trim_edges(part: Column, chars: str) -> Column:
        return F.btrim(part, F.lit(chars))

    def body(s: Column) -> Column:
        toks = F.regexp_extract_all(s, F.lit(r"\d+(?:[.,]\d+)?|\D+"), F.lit(0))

        def rebuild(ts: Column) -> Column:
            holed = F.array_join(F.transform(ts, lambda t: F.when(bad(t), hole).otherwise(t)), "")
            parts = F.transform(F.split(holed, ";"), lambda p: trim_edges(p, f" {dash};,"))
            parts = F.transform(parts, lambda p: trim_edges(F.translate(p, hole, ""), f" {dash}"))
            parts = F.transform(parts, lambda p: strip(
                F.regexp_replace(F.regexp_replace(p, f"[{SPACE}]*[{dash}][{SPACE}]*$", ""),
                                 f"^[{SPACE}]*[{dash}][{SPACE}]*", "")))
            kept = F.filter(parts, lambda p: p.rlike(r"\d"))
            return F.when(~F.exists(ts, bad), s).when(F.size(kept) > 0, F.array_join(kept, "; ")).otherwise("ND")

        return F.when(s.isin("", "ND", "None"), s).otherwise(let(toks, rebuild))

    return let(F.coalesce(strip(c), F.lit("")), body)


def _bin(v: Column, width: int) -> Column:
    lo = (F.floor(v / width) * width).cast("long")
    return _bin_label(lo, width)


def _bin_label(lo: Column, width: int) -> Column:
    return F.concat(lo.cast("string"), F.lit("–"), (lo + width).cast("string"), F.lit(" m"))


def bin20(v: Column) -> Column:
    return _bin(v, 20)


def bin5(v: Column) -> Column:
    return _bin(v, 5)


def bins_span(lo: Column, hi: Column, width: int = 20) -> Column:
    """Labels of every bin a range touches; a missing bound counts as the other one."""
    a = F.floor(F.least(lo, hi) / width) * width
    b = F.floor(F.greatest(lo, hi) / width) * width
    labels = F.transform(F.sequence(a.cast("long"), b.cast("long"), F.lit(width).cast("long")),
                         lambda x: _bin_label(x, width))
    return F.when(lo.isNull() & hi.isNull(), F.array().cast("array<string>")).otherwise(labels)


def bin_low(label: Column) -> Column:
    """Sort key of a bin label: its lower bound, ND last, unreadable labels first."""
    return F.when(label == "ND", F.lit(10 ** 9)).otherwise(
        F.coalesce(strip(F.substring_index(label, "–", 1)).try_cast("int"), F.lit(0)))


def acc_bin(v: Column) -> Column:
    return (F.when(v < 20, "0–20 m").when(v < 100, "20–100 m").when(v < 500, "100–500 m")
            .when(v < 1000, "500–1,000 m").when(v < 2000, "1–2 km").when(v < 5000, "2–5 km")
            .otherwise("≥5 km"))


def kind_value(measures: Column, kind: str) -> Column:
    """Values of one kind out of an array of "kind: value м" texts, joined by "; "."""
    pattern = rf"^[{SPACE}]*([0-9A-Za-zА-Яа-яЁё_]+)[{SPACE}]*:[{SPACE}]*(.+?)[{SPACE}]*м?[{SPACE}]*$"
    hits = F.filter(measures, lambda m: F.regexp_extract(m, pattern, 1) == kind)
    return F.array_join(F.transform(hits, lambda m: F.regexp_extract(m, pattern, 2)), "; ")
