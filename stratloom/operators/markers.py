"""Sections → map markers, facet legends and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo as g
from ..functions import numbers as n
from ..functions import text as t
from ..functions.common import strip
from . import groups, tools

KEYS = ["lat6", "lon6"]


def _text(c: str) -> Column:
    return F.coalesce(strip(c), F.lit("ND"))


def _number(c: str) -> Column:
    return F.translate(F.col(c).cast("string"), ",", ".").try_cast("double")


def _or_nd(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr).otherwise(F.array(F.lit("ND")))


def marker_records(sections: DataFrame, acc: DataFrame | None = None) -> DataFrame:
    """Located sections with their marker and everything the marker draws from one record."""
    s = sections.withColumn("lat", _number("lat")).withColumn("lon", _number("lon")).filter(
        F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if acc is None:
        s = s.withColumn("accuracy", F.lit(float(vocab.DEFAULT_RADIUS)))
    else:
        a = acc.select(F.col("lat5").alias("_a"), F.col("lon5").alias("_o"), F.col("v").cast("double").alias("_v"))
        s = s.join(a, (F.round("lat", 5) == F.col("_a")) & (F.round("lon", 5) == F.col("_o")), "left").withColumn(
            "accuracy", F.coalesce("_v", F.lit(float(vocab.DEFAULT_RADIUS)))).drop("_a", "_o", "_v")
    for k in vocab.THICKNESS_KINDS:
        s = s.withColumn(f"th_{k}", _text(f"thickness_{k}"))
    ranges = F.array(*[n.parse_range(f"th_{k}") for k in vocab.THICKNESS_KINDS])
    s = s.withColumn("_r", ranges).withColumn("thmin", F.array_min("_r.lo")).withColumn("thmax", F.array_max("_r.hi"))
    s = s.withColumn("elmin", _number("elevation_min_m")).withColumn("elmax", _number("elevation_max_m"))
    adm = F.when(_text("administrative_unit") == "", "ND").otherwise(_text("administrative_unit"))
    return s.select(
        "ord", "lat", "lon", F.round("lat", 6).alias("lat6"), F.round("lon", 6).alias("lon6"),
        g.marker_key(F.col("lat"), F.col("lon")).alias("marker"),
        _text("nearest_locality").alias("locality"), adm.alias("admin"),
        F.when(adm == "ND", _text("nearest_locality")).otherwise(F.concat(_text("nearest_locality"), F.lit(", "), adm)).alias("feature"),
        t.split_tags("type_of_deposits").alias("dep"), t.split_tags("deposit_raw_terms").alias("raw"),
        t.split_tags("stratigraphic_position").alias("strat"), t.split_tags("dating_methods").alias("dat"),
        t.split_tags("source_kinds").alias("srck"), t.split_tags("excavation_type").alias("exc"),
        _text("geomorphic_position").alias("geom"), t.split_sources("sources").alias("pubs"),
        t.split_quotes("evidence").alias("quotes"), *[f"th_{k}" for k in vocab.THICKNESS_KINDS],
        "thmin", "thmax", "elmin", "elmax", "accuracy", "loc_confidence",
        F.coalesce(_number("n_sources").cast("int"), F.lit(1)).alias("nsrc"))


def data_confidence(grounded: Column, sources: Column, has_quotes: Column) -> Column:
    """How sure the deposit type is: not the same as how sure the place is."""
    return (F.when(grounded & (sources >= 3), "high").when(grounded | (sources >= 2) | has_quotes, "medium").otherwise("low"))


def build_markers(records: DataFrame, evidence: DataFrame | None = None, kinds: DataFrame | None = None) -> DataFrame:
    """One marker per coordinate (six digits): ordered tag lists, ranges, bins, quotes, flags.

    ``evidence``: locality, phrase, n, grounded; ``kinds``: marker, kind. Single records stay in
    :func:`marker_records`, keyed by marker.
    """
    def single(c: str, *drop: str) -> Column:
        return tools.one_or_none(F.when(~F.col(c).isin(*drop), F.col(c)) if drop else F.col(c))

    dated = F.when(F.size("dat") > 0, "Yes").otherwise("No")
    th = F.coalesce("thmax", "thmin")
    def lists(fields: dict[str, Column], known: dict[str, list[str]], seen) -> DataFrame:
        melted = tools.melt_values(records, KEYS, fields, inner_order=True, known=known)
        return melted.groupBy(*KEYS).agg(*[seen(f).alias(f) for f in fields])

    # tags of fixed vocabularies are first places in the one aggregate of plain numbers
    tags = {"dep": _or_nd(F.col("dep")), "strat": _or_nd(F.col("strat")), "dat": _or_nd(F.col("dat")), "exc": _or_nd(F.col("exc")), "srck": F.col("srck"),
            "chrono": F.array(dated), "accbin": F.array(n.acc_bin(F.col("accuracy")))}
    words = {"dep": [*vocab.ORDER_DEPOSITS, "ND"], "strat": [*vocab.ORDER_AGES, "ND"], "dat": vocab.ORDER_DATING, "exc": [*vocab.ORDER_EXCAVATION, "unspecified"],
             "srck": vocab.SOURCE_KINDS, "chrono": vocab.ORDER_CHRONO, "accbin": vocab.ORDER_ACCURACY}
    # what the facets are made of, and other texts: who needs the first only does not pay for the second
    faceted = {"elbin": n.bins_span(F.col("elmin"), F.col("elmax"), 20), "thbin": tools.one_or_none(n.bin5(th)), "ev": F.col("quotes")}
    strange = {f: tags[f] for f in ("dep", "strat", "dat", "exc", "srck")}
    texts = {"loc": single("locality"), "adm": single("admin"), "feat": single("feature"), "pub": F.col("pubs"), "geom": single("geom", "ND", ""), "raw": F.col("raw"),
             **{f"th_{k}": single(f"th_{k}", "ND", "", "None") for k in vocab.THICKNESS_KINDS}}
    nums = records.groupBy(*KEYS).agg(
        F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("source_count"),
        F.min("thmin").alias("min_thickness"), F.max("thmax").alias("max_thickness"),
        F.min("elmin").alias("min_elevation"), F.max("elmax").alias("max_elevation"),
        F.min("accuracy").alias("min_accuracy"), F.max("accuracy").alias("max_accuracy"),
        F.max("nsrc").alias("max_sources"), F.bool_or(F.col("loc_confidence") == "uncertain").alias("loc_uncertain"),
        *[c for f in tags for c in groups.first_places(f, tags[f], words[f], "ord")])
    nums = nums.withColumn("marker", g.marker_key(F.col("lat6"), F.col("lon6")))
    # every marker has its rows in nums; left joins fall away where no list is asked for
    m = nums.join(lists({**faceted, **strange}, words, lambda f: groups.seen(f) if f in strange else tools.values_seen(f)).withColumnsRenamed({f: f"o_{f}" for f in strange}), KEYS, "left") \
        .join(lists(texts, {}, tools.values_seen), KEYS, "left")
    m = m.withColumns({f: groups.words_in_order(f, words[f], F.col(f"o_{f}") if f in strange else F.lit(None).cast("array<struct<first:bigint,v:string>>")) for f in tags})
    none = F.array().cast("array<string>")
    m = m.withColumns({f: F.coalesce(f, none) for f in (*faceted, *texts)})
    if evidence is not None:
        from .links import evidence_by_locality_join
        names = records.groupBy("marker", "locality").agg(F.min("ord").alias("pos"))
        m = m.join(evidence_by_locality_join(names, evidence), "marker", "left")
    else:
        m = m.withColumn("grounded", F.lit(False)).withColumn("phrases", F.array().cast("array<string>"))
    phrases = F.coalesce("phrases", F.array().cast("array<string>"))
    m = m.withColumn("grounded", F.coalesce("grounded", F.lit(False))).withColumn(
        "quotes", F.array_distinct(F.concat("ev", phrases)))
    m = m.withColumn("exc_ids", t.working_ids(F.col("quotes")))
    m = m.join(kinds.select("marker", "kind"), "marker", "left") if kinds is not None else m.withColumn("kind", F.lit(None).cast("string"))
    level = t.object_level(F.col("kind"), F.col("quotes"), F.col("exc_ids"))
    title = F.coalesce(F.get("loc", F.lit(0)), F.get("feat", F.lit(0)))
    mid_el = (F.col("min_elevation") + F.col("max_elevation")) / 2
    mid_th = (F.col("min_thickness") + F.col("max_thickness")) / 2
    return m.select(
        "marker", F.col("lat6").alias("lat"), F.col("lon6").alias("lon"), "first_ord", title.alias("title"), "source_count",
        F.col("exc").alias("type_excavation"), F.col("dep").alias("deposit_type"), F.col("strat").alias("stratigraphic_position"),
        F.col("dat").alias("dating_method"), F.col("chrono").alias("chronological_data"),
        _or_nd(F.col("elbin")).alias("elevation_ranges"), _or_nd(F.col("thbin")).alias("thickness_ranges"),
        F.col("accbin").alias("accuracy_ranges"), F.col("loc").alias("localities"), F.col("adm").alias("admins"),
        F.col("feat").alias("features"), F.col("pub").alias("publications"), F.col("geom").alias("geom_positions"),
        F.col("raw").alias("raw_terms"), F.col("srck").alias("source_kinds"),
        *[tools.text_or_nd(F.col(f"th_{k}")).alias(f"thickness_{k}") for k in vocab.THICKNESS_KINDS],
        "min_accuracy", "max_accuracy", "min_elevation", "max_elevation", "min_thickness", "max_thickness",
        n.bin20(mid_el).alias("representative_elevation_range"), n.bin5(mid_th).alias("representative_thickness_range"),
        n.acc_bin(F.col("max_accuracy")).alias("representative_accuracy_range"),
        t.search_text(F.col("first_ord").cast("string"), F.array_join("loc", "; "), F.array_join("adm", "; "),
                      F.array_join("dep", "; "), F.array_join("strat", "; "), F.array_join("dat", "; "),
                      F.coalesce(F.get("pub", F.lit(0)), F.lit(""))).alias("search_text"),
        "quotes", "grounded", "loc_uncertain",
        t.unit_name_warning(title, F.array_join("quotes", " ")).alias("unit_warn"),
        level.alias("object_level"), "exc_ids",
        F.when(level == "", "не определено").otherwise(level).alias("object_kind"),
        data_confidence(F.col("grounded"), F.col("max_sources"), F.size(phrases) > 0).alias("confidence"))


def enrich_markers(markers: DataFrame, heights: DataFrame | None = None, links: DataFrame | None = None, figures: DataFrame | None = None,
                   part_of: DataFrame | None = None, includes: DataFrame | None = None) -> DataFrame:
    """Markers with what other steps know of them; each table is keyed by ``marker`` and may be missing.

    ``heights``: elev_dem; ``links``: src, page; ``figures``: section_name, units, page; ``part_of``: part_of;
    ``includes``: name, at. Lists are distinct and sorted; they belong to one marker and are small by nature.
    """
    def listed(df: DataFrame, name: str, *cols: str) -> DataFrame:
        return df.groupBy("marker").agg(F.sort_array(F.collect_set(F.struct(*cols))).alias(name))

    out = markers
    if heights is not None:
        out = out.join(heights.groupBy("marker").agg(F.max("elev_dem").alias("elev_dem")), "marker", "left")
    for name, df, cols in (("page_links", links, ("src", "page")), ("figures", figures, ("page", "section_name", "units")),
                           ("part_of", part_of, ("part_of",)), ("includes", includes, ("name", "at"))):
        if df is not None:
            out = out.join(listed(df, name, *cols), "marker", "left").withColumn(name, F.coalesce(name, F.array()))
    return out


FACETS = {
    "type_excavation": vocab.ORDER_EXCAVATION, "deposit_type": vocab.ORDER_DEPOSITS,
    "stratigraphic_position": vocab.ORDER_AGES, "dating_method": vocab.ORDER_DATING,
    "chronological_data": vocab.ORDER_CHRONO, "object_kind": vocab.ORDER_KIND,
    "elevation_ranges": None, "thickness_ranges": None, "accuracy_ranges": vocab.ORDER_ACCURACY}


def facet_categories(markers: DataFrame) -> DataFrame:
    """(facet, value, pos): distinct values, canonical order first, then alphabetical; bins by lower bound."""
    pairs = []
    for f, canon in FACETS.items():
        values = F.array("object_kind") if f == "object_kind" else F.col(f)
        order = F.array(*[F.lit(c) for c in canon]) if canon else None

        def one(v, f=f, order=order):
            rank = F.when(F.array_position(order, v) > 0, F.array_position(order, v).cast("long")).otherwise(
                10 ** 9) if order is not None else n.bin_low(v).cast("long")
            return F.struct(F.lit(f).alias("facet"), v.alias("value"), rank.alias("rank"))

        pairs.append(F.transform(values, (lambda fn: lambda v: fn(v))(one)))
    vals = markers.select(F.explode(F.concat(*pairs)).alias("p")).select("p.*").distinct()
    return tools.ordinal(vals, ["facet"], ["rank", "value"], "pos").select("facet", "value", "pos")


def dataset_summary(markers: DataFrame) -> DataFrame:
    return markers.agg(F.sum("source_count").alias("raw_records"), F.count(F.lit(1)).alias("markers"),
                       F.count_if(F.col("source_count") > 1).alias("duplicate_groups"),
                       F.min("max_accuracy").alias("accuracy_min"), F.max("max_accuracy").alias("accuracy_max"))


def publication_thickness(records: DataFrame) -> DataFrame:
    """Distinct range texts of each thickness kind per marker, in order of appearance."""
    def known(c: str) -> Column:
        return tools.one_or_none(F.when(~F.col(c).isin("ND", "", "None"), F.col(c)))
    fields = {f"th_{k}": known(f"th_{k}") for k in vocab.THICKNESS_KINDS}
    every = {**fields, "marker": F.array("marker")}
    g_ = tools.melt_values(records, ["marker"], every).groupBy("marker").agg(*[tools.values_seen(f).alias(f) for f in fields])
    return g_.select("marker", *[tools.text_or_nd(F.col(f)).alias(f) for f in fields])


def collate_objects(records: DataFrame) -> DataFrame:
    """What a reviewer or a model needs to judge a marker: names, units, workings, quotes."""
    exc = F.when(F.size("exc") > 0, F.array_join("exc", "; "))
    names = {"loc": F.array("locality"), "adm": tools.one_or_none(F.when(~F.col("admin").isin("ND", ""), F.col("admin"))), "exc": tools.one_or_none(exc)}
    # quotes are most of the text: on their own a task holds them or the names, not both
    n_ = tools.melt_values(records, KEYS, names, inner_order=True).groupBy(*KEYS).agg(*[tools.values_sorted(f).alias(f) for f in names])
    q = tools.melt_values(records, KEYS, {"ev": F.col("quotes")}, inner_order=True).groupBy(*KEYS).agg(tools.values_seen("ev").alias("ev"))
    o = n_.join(q, KEYS, "left").withColumn("ev", F.coalesce("ev", F.array().cast("array<string>"))).withColumn("marker", g.marker_key(F.col("lat6"), F.col("lon6")))
    return o.select("marker", F.array_join("loc", "; ").alias("names"), F.array_join("adm", "; ").alias("admins"),
                    F.array_join("exc", "; ").alias("workings"),
                    F.array_join("ev", "\n").alias("quotes"))
