"""Flat records → consolidated sections → tiers and customer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import numbers as n
from ..functions import text as t
from ..functions.common import not_missing, strip
from . import groups, tools


def _located(raw: DataFrame) -> DataFrame:
    """Records that name a place, with the normalised place and administrative unit."""
    names = F.struct(strip("nearest_locality").alias("name"), t.norm_locality("nearest_locality").alias("loc"), t.norm_admin("administrative_unit").alias("adm"))
    named = tools.once(raw, "_n", names).filter(not_missing(F.col("_n.name")))
    return named.select(*raw.columns, "_n.loc", "_n.adm")


def with_origin(raw: DataFrame, words: list[str] | None = None) -> DataFrame:
    """Records that name a place, and whether it is ``foreign``: a Latin letter or a foreign keyword in the name decides."""
    # a column of its own: plain tests on it are compiled, tests inside a function over an array are interpreted
    rows = tools.once(_located(raw), "_low", F.lower("loc"))
    return rows.withColumn("foreign", t.is_foreign(F.col("loc"), words, low=F.col("_low"))).drop("_low")


def split_foreign(raw: DataFrame, words: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(domestic, international), for who needs one of them; both together are :func:`with_origin`, read once."""
    rows = with_origin(raw, words)
    return rows.filter(~F.col("foreign")).drop("foreign"), rows.filter("foreign").drop("foreign")


def _text(c: str, *drop: str) -> Column:
    s = strip(c)
    return tools.one_or_none(F.when(not_missing(s, *drop), s))


# tag columns with a fixed vocabulary
_TAGS = {"dep": vocab.DEPOSITS, "str": vocab.AGES, "dat": vocab.DATING, "exc": vocab.EXCAVATIONS, "srck": vocab.SOURCE_KINDS}
_KEYS = ["lk", "ak"]


def _tagged(rows: DataFrame, fields: dict[str, Column], numbers: dict[str, Column]) -> DataFrame:
    """Place keys, tag arrays, and the bounds (lo, hi) of the parts of each number cell, computed once per row."""
    rows = rows.withColumn("lk", F.lower("loc")).withColumn("ak", F.lower("adm"))
    return rows.select("*", *[c.alias(f"t_{f}") for f, c in fields.items()], *[c.alias(f"r_{f}") for f, c in numbers.items()])


def section_lists(rows: DataFrame, open_fields: dict[str, Column], tags: list[str]) -> DataFrame:
    """(lk, ak, f, v, first, n): sources, texts and tags outside the vocabularies, one row per distinct value of a place."""
    strange = {f: groups.other_words(F.col(f"t_{f}"), _TAGS[f]) for f in tags}
    return groups.open_values(rows, _KEYS, {**open_fields, **strange})


def _cells(lists: DataFrame, tags: list[str], sorted_: list[str], placed: list[str]) -> DataFrame:
    """The sink: one row per place with the joined lists, as a table of sections needs them."""
    return lists.groupBy(*_KEYS).agg(
        *[groups.by_name(groups.seen(f)).alias(f"x_{f}") for f in [*tags, *sorted_]], *[groups.by_place(groups.seen(f)).alias(f"x_{f}") for f in placed],
        F.count_if(F.col("f") == "src").alias("n_sources"))


def _tag_set(f: str) -> Column:
    return F.sort_array(F.concat(groups.words_of_bits(F.col(f"b_{f}"), _TAGS[f]), F.col(f"x_{f}")))


def _measures(c: str) -> Column:
    """Bounds of each part of a cell that has a digit."""
    parts = F.filter(F.split(F.coalesce(F.col(c), F.lit("ND")), ";"), lambda p: p.rlike(r"\d"))
    return F.transform(parts, lambda p: n.parse_num(strip(p)))


def consolidate_v2(raw: DataFrame) -> DataFrame:
    """Sections keyed by (place, administrative unit), both case-insensitive.

    Tags become alphabetical sets, thickness kinds stay apart, the first spelling wins, landform texts and
    quotes are kept in order of appearance. Tags of the fixed vocabularies are bits and numbers are bounds in one
    aggregate; other texts are rows of their own (:func:`section_lists`) until the cells are written.
    """
    dom, _ = split_foreign(raw)
    tags = {"dep": t.split_tags("type_of_deposits"), "str": t.split_tags("stratigraphic_position"), "dat": t.split_tags("dating_methods"),
            "exc": _text("excavation_type", "unspecified"), "srck": _text("source_kind")}
    cells = {**{k: f"thickness_{k}" for k in vocab.THICKNESS_KINDS}, "el": "absolute_elevation_m"}
    numbers = {k: _measures(c) if k != "el" else F.array(n.parse_num(F.coalesce(F.col(c), F.lit("ND")))) for k, c in cells.items()}
    rows = _tagged(dom, tags, numbers)

    def spelling(c: str) -> Column:
        return F.coalesce(F.min(F.when(F.col(c) != "", F.struct("ord", c)))[c], F.lit(""))

    core = rows.groupBy(*_KEYS).agg(
        F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_records"), spelling("loc").alias("nearest_locality"), spelling("adm").alias("administrative_unit"),
        *[F.bit_or(groups.word_bits(F.col(f"t_{f}"), _TAGS[f])).alias(f"b_{f}") for f in tags],
        *[F.min(F.array_min(f"r_{k}.lo")).alias(f"{k}_lo") for k in cells], *[F.max(F.array_max(f"r_{k}.hi")).alias(f"{k}_hi") for k in cells])
    lists = section_lists(rows, {"raw": t.split_tags("deposit_raw_terms"), "src": F.array(F.coalesce(F.col("source_file"), F.lit("None"))),
                                 "geo": _text("geomorphic_position"), "ev": _text("evidence_locality")}, list(tags))
    g = core.join(_cells(lists, list(tags), ["raw", "src"], ["geo", "ev"]), _KEYS)
    scrub = t.scrub_control_chars
    return g.select(
        "ord", scrub("nearest_locality").alias("nearest_locality"),
        scrub("administrative_unit").alias("administrative_unit"),
        tools.text_or_nd(_tag_set("exc")).alias("excavation_type"),
        scrub(tools.text_or_nd(F.col("x_geo"))).alias("geomorphic_position"),
        tools.text_or_nd(_tag_set("dep")).alias("type_of_deposits"),
        scrub(tools.text_or_nd(F.col("x_raw"))).alias("deposit_raw_terms"),
        *[n.format_range(F.col(f"{k}_lo"), F.col(f"{k}_hi")).alias(f"thickness_{k}") for k in vocab.THICKNESS_KINDS],
        F.coalesce(F.col("el_lo").cast("string"), F.lit("ND")).alias("elevation_min_m"),
        F.coalesce(F.col("el_hi").cast("string"), F.lit("ND")).alias("elevation_max_m"),
        tools.text_or_nd(_tag_set("str")).alias("stratigraphic_position"),
        tools.text_or_nd(_tag_set("dat")).alias("dating_methods"),
        tools.text_or_nd(_tag_set("srck")).alias("source_kinds"), "n_records", "n_sources",
        scrub(F.array_join("x_src", " | ")).alias("sources"),
        scrub(tools.text_or_nd(F.col("x_ev"), " || ")).alias("evidence"))


def consolidate_v1(raw: DataFrame, thickness: str = "thickness_studied") -> DataFrame:
    """First-version sections: bounds of all rows pooled, ages in time order, the last spelling wins."""
    dom, _ = split_foreign(raw, vocab.FOREIGN_NAMES_V1)
    tags = {"dep": t.split_tags("type_of_deposits"), "str": t.split_tags("stratigraphic_position"), "dat": t.split_tags("dating_methods")}
    numbers = {"th": n.parse_num(F.coalesce(F.col(thickness), F.lit("ND")), "evidence"),
               "el": n.parse_num(F.coalesce(F.col("absolute_elevation_m"), F.lit("ND")), "evidence")}
    rows = _tagged(dom, tags, numbers)

    def spelling(c: str) -> Column:
        return F.max(F.struct("ord", c))[c]

    core = rows.groupBy(*_KEYS).agg(
        F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_records"), spelling("loc").alias("nearest_locality"), spelling("adm").alias("administrative_unit"),
        *[F.bit_or(groups.word_bits(F.col(f"t_{f}"), _TAGS[f])).alias(f"b_{f}") for f in tags],
        *[F.min(F.least(f"r_{k}.lo", f"r_{k}.hi")).alias(f"{k}_min") for k in numbers], *[F.max(F.greatest(f"r_{k}.lo", f"r_{k}.hi")).alias(f"{k}_max") for k in numbers])
    lists = section_lists(rows, {"src": F.array(F.coalesce(F.col("source_file"), F.lit("None")))}, list(tags))
    # quotes repeat: rows count, not distinct texts
    quotes = rows.select(*_KEYS, F.lit("ev").alias("f"), F.coalesce(F.col("evidence_locality"), F.lit("None")).alias("v"),
                         groups.place_of("ord").alias("first"), F.lit(1).cast("bigint").alias("n")).filter("v <> ''")
    g = core.join(_cells(lists.unionByName(quotes), list(tags), ["src"], ["ev"]), _KEYS)

    def num(c: str) -> Column:
        return F.coalesce(F.round(c, 2).cast("string"), F.lit("ND"))

    return g.select(
        "ord", "nearest_locality", "administrative_unit",
        num("th_min").alias("thickness_min_m"), num("th_max").alias("thickness_max_m"),
        num("el_min").alias("elevation_min_m"), num("el_max").alias("elevation_max_m"),
        F.array_join(_tag_set("dep"), "; ").alias("type_of_deposits"),
        F.array_join(t.stratigraphic_order(_tag_set("str")), "; ").alias("stratigraphic_position"),
        F.array_join(_tag_set("dat"), "; ").alias("dating_methods"), "n_records", "n_sources",
        t.scrub_control_chars(F.array_join("x_src", " | ")).alias("sources"),
        t.scrub_control_chars(F.array_join("x_ev", " || ")).alias("evidence"))


def order_by_support(sections: DataFrame) -> DataFrame:
    """Most-recorded sections first; an unreadable count is 0."""
    return sections.orderBy(F.coalesce(F.col("n_records").cast("string").try_cast("int"), F.lit(0)).desc(), "ord")


def clean_thickness_columns(sections: DataFrame, limit: float = 300, borehole_limit: float = 1000) -> DataFrame:
    for k in vocab.THICKNESS_KINDS:
        cap = borehole_limit if k == "borehole_depth" else limit
        sections = sections.withColumn(f"thickness_{k}", n.clean_thickness(f"thickness_{k}", cap))
    return sections


# ---------------------------------------------------------------- customer table and tiers
def _range_text(lo: str, hi: str) -> Column:
    def known(c: str) -> Column:
        return F.when(~F.coalesce(F.col(c), F.lit("ND")).isin("ND", ""), F.col(c))
    return n.format_range(known(lo), known(hi), text=lambda c: c)


def gold_projection(sections: DataFrame, with_n_sources: bool = False,
                    contributor: str = "auto-extraction") -> DataFrame:
    """Customer columns; ``sections`` carries ``row_id`` and the first-version columns plus lat, lon."""
    nd = F.lit("ND")
    srcs = t.split_sources("sources")  # the customer table has columns for four
    geo = F.col("lat").isNotNull()
    dating = strip(F.coalesce(F.col("dating_methods"), F.lit("")))

    def text(c: Column) -> Column:
        return t.scrub_control_chars(t.nd_normalise(c))

    def pub(k: int) -> Column:
        return text(F.coalesce(F.get(srcs, F.lit(k)), F.lit("")))

    cells = [
        F.col("row_id"), F.col("lat"), F.col("lon"), F.when(geo, F.lit(5000)),
        _range_text("thickness_min_m", "thickness_max_m"), _range_text("elevation_min_m", "elevation_max_m"),
        nd, nd, nd, text(F.col("nearest_locality")), text(F.col("nearest_locality")),
        text(F.col("administrative_unit")), text(F.col("type_of_deposits")), text(F.col("stratigraphic_position")),
        F.when((dating != "") & (dating != "ND"), "Yes").otherwise("No"), text(dating),
        nd, nd, nd, nd, nd, pub(0), nd, pub(1), nd, pub(2), nd, pub(3), nd, nd,
        text(F.concat(F.lit("консолидировано из "), F.col("n_sources").cast("string"), F.lit(" источн.; "),
                      F.coalesce(F.col("evidence"), F.lit("")))),
        F.lit(contributor)]
    out = [c.alias(name) for c, name in zip(cells, vocab.GOLD_COLUMNS)]
    if with_n_sources:
        out.append(F.col("n_sources"))
    return sections.select(*out)


def confidence_tier(gold: DataFrame) -> DataFrame:
    """A located and confirmed or rich, B located, C has data, D sparse."""
    def nd(c: str) -> Column:
        v = F.col(f"`{c}`").cast("string")
        return v.isNull() | v.isin("", "ND", "No", "None")

    geo = ~nd("N")
    rich = ~nd("Thickness, m") & ~nd("Dating method") & ~nd("Stratigraphic position")
    data = ~nd("Type of deposits") & ~nd("Stratigraphic position")
    sources = F.coalesce(F.col("n_sources").cast("string").try_cast("int"), F.lit(1))
    sources = F.when(sources == 0, 1).otherwise(sources)
    return gold.withColumn("n_sources", sources).withColumn(
        "confidence_tier", F.when(geo & ((sources >= 2) | rich), "A").when(geo, "B").when(data, "C").otherwise("D"))


def tier_counts(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("confidence_tier").agg(F.count(F.lit(1)).alias("n"))


class MisalignedError(ValueError):
    """Two tables that must describe the same rows do not."""


def aligned_join(gold: DataFrame, clean: DataFrame, key: str = "ID") -> DataFrame:
    """Combine two tables row by row through an explicit id; fail when they do not hold each id once."""
    both = gold.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).union(clean.select(key, F.lit(0), F.lit(1)))
    off = both.groupBy(key).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a <> 1 or b <> 1")
    if not off.isEmpty():
        raise MisalignedError(f"tables do not hold the same {key} values once each")
    return gold.join(clean, key)
