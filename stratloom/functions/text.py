"""Text normalisation, tags, names of files and publications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .common import SPACE, WORD, bounded, col, contains_any, dedupe_by, let, not_missing, squash, strip

_ND_WORDS = ["none", "nan", "", "nd", "no data", "null"]


def nd_normalise(c: Column | str, words: list[str] | None = None) -> Column:
    """Trim; NULL and every spelling of "no data" become ``ND``."""
    t = F.coalesce(strip(c), F.lit(""))
    return let(t, lambda s: F.when(F.lower(s).isin(words or _ND_WORDS), "ND").otherwise(s))


def scrub_control_chars(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def split_tags(c: Column | str) -> Column:
    """";"-list → trimmed array without empty, ND and None."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), ";"), strip)
    return F.filter(parts, lambda t: not_missing(t))


def split_list(c: Column | str, sep: str) -> Column:
    """Literal-separator list → trimmed array without empty parts."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), sep), strip)
    return F.filter(parts, lambda t: t != "")


def split_sources(c: Column | str) -> Column:
    return split_list(c, r"\|")


def split_quotes(c: Column | str) -> Column:
    return split_list(c, r"\|\|")


_PREFIX = r"(?iu)^(г|с|пос|дер|д|х|ст|пгт|аул|село|город|станица|хутор|деревня|оз|р)\.?[" + SPACE + r"]+"


def norm_locality(c: Column | str) -> Column:
    """Collapse spaces, drop one settlement prefix, strip " .,-"."""
    return F.btrim(F.regexp_replace(squash(strip(c)), _PREFIX, ""), F.lit(" .,-"))


def norm_admin(c: Column | str) -> Column:
    return let(F.coalesce(strip(c), F.lit("")),
               lambda s: F.when(s.isin("ND", "None", ""), "").otherwise(squash(s)))


def norm_search(c: Column | str) -> Column:
    """Lower case, ё as е, everything but digits and letters becomes one space."""
    low = F.translate(F.lower(F.coalesce(col(c), F.lit(""))), "ё", "е")
    return F.btrim(F.regexp_replace(low, "[^0-9a-zа-я]+", " "), F.lit(" "))


_MARK = rf"(?iu)[{SPACE}]*\(загружено пользователем\)[{SPACE}]*$"


def drop_upload_mark(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), _MARK, "")


def norm_pubname(c: Column | str) -> Column:
    return squash(F.lower(strip(drop_upload_mark(c))))


def basename(c: Column | str) -> Column:
    return F.substring_index(F.translate(col(c), "\\", "/"), "/", -1)


def stem(c: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(c, r"(?s)\.[^.]*$", "")


def strip_marks(c: Column | str) -> Column:
    """Letters without accents; й counts as и and ё as е, in line with canonical decomposition."""
    return F.translate(F.regexp_replace(col(c), r"\p{Mn}", ""), "йЙёЁ", "иИеЕ")


def plain_key(c: Column | str) -> Column:
    """Name key: no accents, single spaces, lower case."""
    return F.lower(strip(squash(strip_marks(F.coalesce(col(c), F.lit(""))))))


def md5_hex(c: Column | str) -> Column:
    return F.md5(col(c).cast("binary"))


def _start(c: Column, size: int | None) -> Column:
    """The first ``size`` characters; all of them for None."""
    return c if size is None else F.substring(c, 1, size)


def pub_slug(c: Column | str, size: int | None = None) -> Column:
    base = F.btrim(F.regexp_replace(stem(col(c)), "[^0-9A-Za-zА-Яа-яЁё]+", "_"), F.lit("_"))
    return F.concat(_start(base, size), F.lit("_"), F.substring(md5_hex(c), 1, 6))


def safe_name(c: Column | str, size: int | None = None) -> Column:
    return _start(F.regexp_replace(basename_slash(c), r"""[ ?*:<>|"\\/\t\n\r]""", "_"), size)


def basename_slash(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", -1)


def safe_job_id(c: Column | str, size: int | None = None) -> Column:
    return _start(F.regexp_replace(col(c), r"[^0-9A-Za-z\-_]", ""), size)


def file_ext(c: Column | str) -> Column:
    name = basename_slash(c)
    return F.when(F.contains(name, F.lit(".")),
                  F.concat(F.lit("."), F.lower(F.substring_index(name, ".", -1)))).otherwise("(no ext)")


def natural_key(c: Column | str) -> Column:
    """Array that sorts digit runs as numbers and the rest as lower-case text.

    A number is its count of digits, always ten digits long, and then the digits, so numbers of any length compare.
    """
    toks = F.regexp_extract_all(col(c), F.lit(r"\d+|\D+"), F.lit(0))

    def number(t: Column) -> Column:
        return let(F.ltrim(t, F.lit("0")), lambda d: F.concat(F.lpad(F.length(d).cast("string"), 10, "0"), d))

    return F.transform(toks, lambda t: F.when(t.rlike(r"^\d"), number(t)).otherwise(F.lower(t)))


def stable_job_id(c: Column | str) -> Column:
    return F.concat(F.lit("cl-"), F.substring(md5_hex(c), 1, 12))


def is_foreign(loc: Column, words: list[str] | None = None, low: Column | None = None) -> Column:
    """A Latin letter or one of the words; ``low`` is the lower-cased name where it is a column already."""
    words = words or vocab.FOREIGN_NAMES
    named = contains_any(F.lower(loc), words) if low is None else reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return loc.rlike("[A-Za-z]") | named


def skip_geocode_foreign(loc: Column) -> Column:
    return contains_any(F.lower(loc), vocab.FOREIGN_GEOCODE)


def unwrap_cell(value: Column, is_array: bool = False, drop_math: bool = False) -> Column:
    """``{value, evidence}`` wrapper's value as text: lists deduped and joined by "; ", empty → ND."""
    if drop_math:
        cut = lambda v: F.regexp_replace(v, "^math::", "")
    else:
        cut = lambda v: v
    if not is_array:
        return F.when(value.isNull() | (value == ""), "ND").otherwise(cut(value))
    vals = F.array_distinct(F.transform(value, cut))
    if not drop_math:
        vals = F.filter(vals, lambda v: not_missing(strip(v)))
    return F.coalesce(F.array_join(vals, "; "), F.lit("ND"))


def evidence_cell(evidence: Column, size: int | None = None) -> Column:
    return _start(F.coalesce(evidence, F.lit("")), size)


def thickness_by_kind(measures: Column, kind: str) -> Column:
    """Distinct values of one thickness kind joined by "; "; ND when there is none."""
    hits = F.filter(measures, lambda t: (t["kind"] == kind) & t["value_m"].isNotNull()
                    & ~t["value_m"].isin("", "ND"))
    vals = F.array_distinct(F.transform(hits, lambda t: t["value_m"]))
    vals = F.filter(vals, lambda v: not_missing(strip(v)))
    return F.when(F.size(F.coalesce(hits, F.array())) > 0, F.array_join(vals, "; ")).otherwise("ND")


def stratigraphic_order(tags: Column) -> Column:
    """Fixed age order, unknown tags last."""
    ages = F.array(*[F.lit(a) for a in vocab.AGES])
    keyed = F.transform(tags, lambda v: F.struct(
        F.when(F.array_position(ages, v) > 0, F.array_position(ages, v)).otherwise(9).alias("p"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def search_text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


# ---------------------------------------------------------------- quotes and objects
_LET = f"[{WORD}]"
# fixed pattern: designations of boreholes, pits, outcrops and numbered sites
_WORKING = (rf"(?iu)(скв(?:ажин{_LET}*|\.)?\s*№?\s*[\dIVX][\d/IVX]{{0,4}}"
            rf"|шурф{_LET}*\s*№?\s*\d[\d/]{{0,4}}"
            rf"|расчистк{_LET}*\s*№?\s*\d[\d/]{{0,4}}"
            rf"|обн(?:ажени{_LET}*|\.)\s*№?\s*\d[\d/]{{0,3}}"
            r"|разрез\s*№\s*\d[\d/]{0,3}"
            r"|Site\s*\d{1,3}"
            r"|[A-Z]{2}-\d{2}[A-Z\d\-]{0,6})")
_YEAR = bounded(r"1[89]\d{2}|20[0-3]\d")


def working_ids(quotes: Column, cap: int | None = None) -> Column:
    """Distinct designations of workings named in quotes, in order of mention."""
    found = F.flatten(F.transform(quotes, lambda q: F.regexp_extract_all(q, F.lit(_WORKING), F.lit(0))))
    found = F.transform(found, lambda v: F.btrim(squash(v), F.lit(" .,;")))
    found = F.filter(found, lambda v: ~v.rlike(_YEAR))

    def keyed(v: Column) -> Column:
        low = F.lower(v)
        letters = F.regexp_replace(F.regexp_extract(low, r"^([^\d]*)", 1), "[^a-zа-я]", "")
        number = strip(F.regexp_extract(low, r"^[^\d]*(.*)$", 1))
        return F.struct(F.concat(F.substring(letters, 1, 5), F.lit("|"), number).alias("k"), v.alias("v"))

    uniq = dedupe_by(F.transform(found, keyed))
    ids = F.transform(uniq, lambda s: s["v"])
    return ids if cap is None else F.slice(ids, 1, cap)


# fixed pattern: phrases that announce a summary section
_SUMMARY = (rf"(?iu)(сводн{_LET}+\s+(?:разрез|колонк)|обобщённ{_LET}+\s+разрез|обобщенн{_LET}+\s+разрез"
            rf"|типов{_LET}+\s+разрез|опорн{_LET}+\s+разрез)")


def object_level(verdict: Column, quotes: Column, ids: Column) -> Column:
    """Reviewed kind when present, else what the quotes suggest."""
    return (F.when(F.coalesce(verdict, F.lit("")) != "", verdict)
            .when(F.array_join(quotes, " ").rlike(_SUMMARY), "сводный разрез")
            .when(F.size(ids) > 0, "конкретные выработки").otherwise(""))


_SUFFIXES = ["ский", "ская", "ское", "ского", "ской", "ском", "ий", "ая", "ое", "а", "ы", "и"]
# fixed pattern: stratigraphic units named after places
_UNIT = r"(?iu)([А-ЯЁ][а-яё]+ск)(?:ий|ая|ое|ого|ой|ом|ую)\s+(?:лесс|лёсс|свит|горизонт|почв|толщ|слои)"


def name_stem(c: Column) -> Column:
    """Name without its adjective or case ending."""
    low = F.translate(F.lower(F.coalesce(c, F.lit(""))), "ё", "е")

    def cut(s: Column) -> Column:
        out = s
        for suf in reversed(_SUFFIXES):
            out = F.when(F.endswith(s, F.lit(suf)), F.substr(s, F.lit(1), F.length(s) - len(suf))).otherwise(out)
        return out

    return let(low, cut)


def unit_name_warning(title: Column, text: Column) -> Column:
    """True when the object's name shares its stem with a unit named after a place."""
    unit = F.regexp_extract(text, _UNIT, 1)
    pair = F.struct(name_stem(title).alias("a"), name_stem(unit).alias("b"))
    return F.coalesce((unit != "") & let(pair, lambda p: (F.length(p["a"]) >= 5) & (F.length(p["b"]) >= 5)
                      & (F.substring(p["a"], 1, 6) == F.substring(p["b"], 1, 6))), F.lit(False))


# ---------------------------------------------------------------- places named in prose
_OBL = rf"([А-ЯЁ][а-яё\-]+ск)(?:ая|ой|ую|ом)[{SPACE}]+(?:област[ьия]|обл\.)"
_KRAI = rf"([А-ЯЁ][а-яё\-]+ск)(?:ий|ого|ом)[{SPACE}]+кра[йея]"
_RESP = rf"[Рр]еспублик[аиеу][{SPACE}]+([А-ЯЁ][а-яё\-]+)"
_RAION = rf"([А-ЯЁ][а-яё\-]+ск)(?:ий|ого|ом)[{SPACE}]+район"


def _tail(c: Column, pattern: str, before: str = "", after: str = "") -> Column:
    hit = F.regexp_extract(c, pattern, 1)
    return F.when(hit != "", F.concat(F.lit(before), hit, F.lit(after)))


def admin_from_text(c: Column | str) -> Column:
    """struct(region, district) in the nominative; NULL when not named."""
    t = F.coalesce(col(c), F.lit(""))
    return F.struct(
        F.coalesce(_tail(t, _OBL, after="ая область"), _tail(t, _KRAI, after="ий край"),
                   _tail(t, _RESP, before="Республика ")).alias("region"),
        _tail(t, _RAION, after="ий район").alias("district"))


_RIVER = (rf"(?:р\.|реки|реке|рекой|река|бассейн[{WORD}]*[{SPACE}]+р(?:еки|\.)|долин[{WORD}]*[{SPACE}]+р(?:еки|\.)"
          rf"|берег[{WORD}]*[{SPACE}]+р(?:еки|\.))[{SPACE}]*([А-ЯЁ][а-яё\-]{{2,}})")
_RIVER_ON = rf"(?<![{WORD}])на[{SPACE}]+([А-ЯЁ][а-яё\-]{{3,}}[еиы])(?![{WORD}])"


def river_from_text(c: Column | str) -> Column:
    t = F.coalesce(col(c), F.lit(""))
    return F.coalesce(_tail(t, _RIVER), _tail(t, _RIVER_ON))


def river_variants(c: Column | str) -> Column:
    """The name as written, then nominative guesses, case-insensitively distinct."""
    def body(w: Column) -> Column:
        cut = F.substr(w, F.lit(1), F.length(w) - 1)
        two = F.substr(w, F.lit(1), F.greatest(F.length(w) - 2, F.lit(0)))
        raw = F.array(
            w,
            F.when(F.length(w) > 2, F.concat(cut, F.lit("а"))),
            F.when(F.length(w) > 2, F.concat(cut, F.lit("я"))),
            F.when(F.endswith(w, F.lit("ой")) | F.endswith(w, F.lit("ей")), F.concat(two, F.lit("а"))))
        keyed = F.transform(F.filter(raw, lambda v: v.isNotNull()),
                            lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))
        return F.transform(dedupe_by(keyed), lambda s: s["v"])

    return let(strip(c), body)


_NUM_TAIL = rf"(?iu)[{SPACE}\-–]+(?:[IVXLC]{{1,5}}|\d{{1,3}}[а-яa-z]?)[{SPACE}]*$"
_NAME_PREFIX = rf"(?iu)^[{SPACE}]*(?:с|д|пос|г|ст|хут|пгт|аул|разрез|скв)\.?[{SPACE}]+"


def name_variants(c: Column | str) -> Column:
    """Raw name, name without prefix, name without a trailing numeral."""
    def body(n: Column) -> Column:
        def more(bare: Column) -> Column:
            short = strip(F.regexp_replace(bare, _NUM_TAIL, ""))
            raw = F.array(n, F.when(bare != n, bare),
                          F.when((short != bare) & (F.length(short) >= 4), short))
            keyed = F.transform(F.filter(raw, lambda v: v.isNotNull() & (F.length(v) >= 3)),
                                lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))
            return F.transform(dedupe_by(keyed), lambda s: s["v"])
        return let(strip(F.regexp_replace(n, _NAME_PREFIX, "")), more)

    return let(F.coalesce(strip(c), F.lit("")), body)


_SIZE_WORD = rf"(?iu)^(восточн|западн|северн|южн|верхн|нижн|больш|мал|нов|стар|средн)[{WORD}]*[{SPACE}]+"


def drop_side_word(c: Column) -> Column:
    """"Восточный Красный Яр" → "Красный Яр"."""
    return strip(F.regexp_replace(c, _SIZE_WORD, ""))


def not_place_reason(c: Column | str) -> Column:
    """Why a name cannot be looked up as a settlement; NULL when it can."""
    n = F.coalesce(col(c), F.lit(""))
    nb, na = f"(?<![{WORD}])", f"(?![{WORD}])"
    return (F.when(n.rlike(rf"(?iu)^[{SPACE}]*\d+[{SPACE},.]*км"), "расстояние по трассе")
            .when(n.rlike(r"^[A-ZА-Я]{2,5}[-–]?\d{2,}"), "номер выработки")
            .when(n.rlike(rf"(?iu)^(?:скв|обн|шурф|расчистк|разрез|profile|core){na}"), "обозначение выработки")
            .when(n.rlike(rf"(?iu){nb}(?:море|озеро|залив|пролив|хребет|плато|равнин|низменност|возвышенност"
                          "|бассейн|междуречь)"), "объект-площадь, а не точка")
            .when(n.rlike(rf"(?iu){nb}(?:район|область|край|округ|республик|уезд|губерни){na}"),
                  "административная единица")
            .when(~n.rlike("[А-Яа-яЁёA-Za-z]{4,}"), "нет словесной основы"))


# fixed pattern
INTERNAL_LABEL = (rf"^[{SPACE}]*(site|участок|площадк[{WORD}]*|section|разрез|скв[{WORD}]*|borehole|pit|шурф)?"
                  rf"[{SPACE}]*[\-{WORD}]{{0,3}}[\-{SPACE}]?\d+[\-{WORD}]*[{SPACE}]*$")


def is_internal_label(c: Column | str) -> Column:
    """"Site 1", "OT-22V": a designation inside one publication, not a place name."""
    return col(c).rlike("(?iu)" + INTERNAL_LABEL)


def is_hedged(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit("")).rlike(
        "(?iu)вероятн|возможно|скорее всего|по-видимому|предполож|наверное|может быть")


def display_chrono(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.isin("true", "yes", "1"), "Yes").when(low.isin("false", "no", "0"), "No").otherwise("ND")


# ---------------------------------------------------------------- topical screening
def word_parts(words) -> list[list[str]]:
    """Entries of a topic list as lists of the parts that must all occur."""
    return [list(w) if isinstance(w, tuple) else [w] for w in words]


def _count_hits(t: Column, words) -> Column:
    pats = F.array(*[F.array(*[F.lit(p) for p in parts]) for parts in word_parts(words)])
    return F.size(F.filter(pats, lambda ps: F.forall(ps, lambda p: F.contains(t, p))))


def is_relevant(title: Column, abstract: Column) -> Column:
    """Two-level screening of a title and an abstract."""
    return let(norm_search(F.concat(title, F.lit(" "), abstract)), lambda t: F.when(
        _count_hits(t, vocab.TOPIC_NEG) > 0, False).when(
        _count_hits(t, vocab.TOPIC_STRONG) > 0, True).when(
        _count_hits(t, vocab.TOPIC_OLD) > 0, False).otherwise(
        _count_hits(t, vocab.TOPIC_WEAK) >= 3))


# ---------------------------------------------------------------- HTML
def strip_html(c: Column) -> Column:
    return strip(squash(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")))


_ITEM = (r'(?s)<a href="/article/n/([a-z0-9\-]+)">\s*<div class="title">(.*?)</div>'
         r"\s*<p>(.*?)</p>\s*<span>(.*?)</span>")


def html_list_items(html: Column) -> Column:
    """array<struct<slug,title,abstract,meta>> of one listing page."""
    whole = F.regexp_extract_all(html, F.lit(_ITEM), F.lit(0))
    return F.transform(whole, lambda m: F.struct(
        F.regexp_extract(m, _ITEM, 1).alias("slug"),
        strip_html(F.regexp_extract(m, _ITEM, 2)).alias("title"),
        strip_html(F.regexp_extract(m, _ITEM, 3)).alias("abstract"),
        strip_html(F.regexp_extract(m, _ITEM, 4)).alias("meta")))


def meta_values(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf'<meta name="{name}" content="([^"]*)"'), F.lit(1))


def _first_meta(html: Column, name: str) -> Column:
    return F.coalesce(F.get(meta_values(html, name), F.lit(0)), F.lit(""))


def html_article(html: Column) -> Column:
    """Citation tags and body text of an article page."""
    mark = 'itemprop="articleBody"'
    at = F.locate(mark, html)
    body = F.when(at > 0, strip_html(F.substr(html, at + len(mark)))).otherwise("")
    return F.struct(
        _first_meta(html, "citation_title").alias("title"),
        meta_values(html, "citation_author").alias("authors"),
        _first_meta(html, "citation_publication_date").alias("year"),
        _first_meta(html, "citation_journal_title").alias("journal"),
        _first_meta(html, "citation_issn").alias("issn"),
        _first_meta(html, "citation_pdf_url").alias("pdf"),
        body.alias("text"))


def chunk_text(text: Column, size: int = 5000, min_len: int = 200) -> Column:
    """array<struct<idx,text>> of fixed-size slices; short slices drop out, indexes stay."""
    n = F.length(text)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda s, i: F.struct(
        i.cast("int").alias("idx"), F.substr(text, s + 1, F.lit(size)).alias("text")))
    return F.filter(parts, lambda p: F.length(strip(p["text"])) > min_len)


def split_on_line(text: Column, min_len: int = 900) -> Column:
    """Cut a chunk in two at the last newline of its first half; short chunks stay whole."""
    def body(t: Column) -> Column:
        half = F.floor(F.length(t) / 2).cast("int")
        head = F.substr(t, F.lit(1), half)
        back = F.locate("\n", F.reverse(head))
        cut = F.when((back > 0) & (half - back > 0), half - back).otherwise(half)
        return F.when(F.length(t) < min_len, F.array(t)).otherwise(
            F.array(F.substr(t, F.lit(1), cut), F.substr(t, cut + 1)))
    return let(text, body)


def split_deep(text: Column, min_len: int = 900, depth: int = 2) -> Column:
    parts = F.array(text)
    for _ in range(depth):
        parts = F.flatten(F.transform(parts, lambda p: split_on_line(p, min_len)))
    return parts


# fixed pattern: captions that announce a column or section figure
_CAPTION = (rf"(?iu)(литологическ{_LET}*\s+колонк|стратиграфическ{_LET}*\s+колонк|колонк{_LET}*\s+разрез"
            rf"|строени{_LET}*\s+разрез|схематическ{_LET}*\s+разрез|геологическ{_LET}*\s+разрез"
            rf"|разрез\s+скважин|сводн{_LET}*\s+колонк|литолого-стратиграфическ)")


def has_caption(c: Column, pattern: str = _CAPTION) -> Column:
    return c.rlike(pattern)
