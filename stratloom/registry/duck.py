"""Snippets of check SQL that several statements share."""

from __future__ import annotations

SPACE = r"\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = "0-9A-Za-zА-Яа-яЁё_"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(items) -> str:
    return "[" + ", ".join(q(w) for w in items) + "]"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def squash(e: str) -> str:
    return f"regexp_replace({e}, '[{SPACE}]+', ' ', 'g')"


def any_word(e: str, items) -> str:
    return f"regexp_matches({e}, {q('|'.join(items))})"


def missing(e: str) -> str:
    return f"({e} is null or {e} in ('', 'ND', 'None'))"


def split_tags(e: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({e}, ''), ';'), lambda t: {strip('t')}), "
            "lambda t: t not in ('', 'ND', 'None'))")


def split_list(e: str, sep: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({e}, ''), {q(sep)}), lambda t: {strip('t')}), "
            "lambda t: t <> '')")


def norm_search(e: str) -> str:
    return (f"trim(regexp_replace(replace(lower(coalesce({e}, '')), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g'))")


PREFIX = r"(?i)^(г|с|пос|дер|д|х|ст|пгт|аул|село|город|станица|хутор|деревня|оз|р)\.?\s+"


def norm_locality(e: str) -> str:
    return f"trim(regexp_replace({squash(strip(e))}, {q(PREFIX)}, ''), ' .,-')"


def norm_admin(e: str) -> str:
    return f"case when {missing(strip(e))} then '' else {squash(strip(e))} end"


def nums(e: str) -> str:
    return (f"list_transform(regexp_extract_all(replace({e}, ',', '.'), '\\d+[.]?\\d*'), "
            "lambda x: cast(x as double))")


def num_lo_hi(e: str) -> tuple[str, str]:
    """(lo, hi) of a measurement in prose, in metres."""
    s = f"lower({strip(f'coalesce({e}, {q(chr(32))})')})"
    edge = f"[^{WORD}]"
    cm = f"regexp_matches({s}, '(^|{edge})(см|cm)($|{edge})')"
    over = f"regexp_matches({s}, 'свыше|более|>')"
    under = f"regexp_matches({s}, '(^|{edge})до($|{edge})|<')"
    n = f"list_transform({nums(s)}, lambda x: case when {cm} then x / 100 else x end)"
    ok = f"{s} not in ('nd', '', 'none', '-')"
    lo = f"case when {ok} and not ({under} and not {over}) then list_min({n}) end"
    hi = f"case when {ok} and not {over} then list_max({n}) end"
    return lo, hi


def joined_lo_hi(e: str) -> tuple[str, str]:
    lo, hi = num_lo_hi("p")
    parts = f"string_split(coalesce({e}, ''), ';')"
    return (f"list_min(list_transform({parts}, lambda p: {lo}))",
            f"list_max(list_transform({parts}, lambda p: {hi}))")


def range_lo_hi(e: str) -> tuple[str, str]:
    """(lo, hi) of formatted range text."""
    s = strip(f"coalesce({e}, '')")
    ok = f"{s} not in ('', 'ND', 'None')"
    over, under = f"regexp_matches({s}, '[≥>]')", f"regexp_matches({s}, '[≤<]')"
    return (f"case when {ok} and not ({under} and not {over}) then list_min({nums(s)}) end",
            f"case when {ok} and not {over} then list_max({nums(s)}) end")


def fmt_range(lo: str, hi: str) -> str:
    return (f"case when {lo} is null and {hi} is null then 'ND' when {hi} is null then '≥' || printf('%g', {lo}) "
            f"when {lo} is null then '≤' || printf('%g', {hi}) when {lo} = {hi} then printf('%g', {lo}) "
            f"else printf('%g', {lo}) || '–' || printf('%g', {hi}) end")


def haversine(a: str, b: str, c: str, d: str) -> str:
    return (f"(2 * 6371 * asin(least(1.0, sqrt(power(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * "
            f"cos(radians({c})) * power(sin(radians({d} - {b}) / 2), 2)))))")


def planar(a: str, b: str, c: str, d: str, m: str = "111320") -> str:
    return (f"sqrt(power(({c} - {a}) * {m}, 2) + power(({d} - {b}) * {m} * cos(radians({a})), 2))")


def first_box(e: str, table, part: str) -> str:
    """Name or one bound of the first table entry with a keyword in the text."""
    pos = {"lat0": 0, "lat1": 1, "lon0": 2, "lon1": 3}
    arms = []
    for name, bb, ws in table:
        value = q(name) if part == "name" else f"cast({float(bb[pos[part]])} as double)"
        arms.append(f"when {any_word(e, ws)} then {value}")
    return "case " + " ".join(arms) + " end"


def dedupe(pairs: str) -> str:
    """Keep the first struct of every key k in a list of structs."""
    return (f"list_filter({pairs}, lambda p, i: list_position(list_transform({pairs}, lambda z: z.k), p.k) = i)")


def marker_key(lat: str, lon: str) -> str:
    return f"(cast(round({lat}, 6) as varchar) || ',' || cast(round({lon}, 6) as varchar))"


SETTLE = ("class in ('place', 'boundary') and type in ('city', 'town', 'village', 'hamlet', 'municipality', "
          "'administrative', 'suburb', 'borough', 'isolated_dwelling', 'locality', 'quarter')")
BOUNDS = "lat between 41 and 82 and lon between 19 and 180"
