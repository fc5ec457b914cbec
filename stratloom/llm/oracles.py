"""The results of queries 11, 12 and 13 in DuckDB's SQL, by plain rules instead of the operators' methods."""

from . import mixing, prefix_trie, turn_repair

# CRC-32 by its rule: the table of 256 remainders, then one step per byte of ASCII text
CRC_TABLE = """bits(i, k, v) as (select i, 0, i from range(256) r(i) union all
    select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
crc as (select list(v order by i) as tab from bits where k = 8)"""


def crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)),
        lambda acc, b: xor(tab[(xor(acc, b) & 255) + 1], acc >> 8)), 4294967295)"""


def words(text: str) -> str:
    return f"len(list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))"


def trie() -> str:
    return f"""
with recursive {CRC_TABLE},
o as (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) order by turn nulls first, role, text) as s
    from conversations where conv_id is not null group by conv_id),
h as (select *, {crc32("conv_id::varchar")} % {prefix_trie.HEAD + 1} as h from o, crc),
r as (select h.conv_id, list_concat(coalesce(b.s[1:h.h], []), h.s[h.h + 1:]) as s
    from h left join o b on b.conv_id = h.conv_id - h.conv_id % {prefix_trie.FAMILY}),
p as (select conv_id, d, s[1:d] as pre, len(s) = d as ended from r, unnest(range(0, len(s) + 1)) u(d)),
n as (select pre, d, min(conv_id) as conv_id, count(*) as n, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends
    from p group by pre, d),
k as (select a.*, b.conv_id as up, (select count(*) from n c where c.d = a.d + 1 and c.pre[1:a.d] = a.pre) as kids
    from n a left join n b on b.d = a.d - 1 and a.d > 0 and b.pre = a.pre[1:a.d - 1]),
w as (select *, case when d = 0 then 0 else (n - 1) * {words("pre[d].t")} end as own from k),
below as (select x.pre[1:a] as pre, a as d, count(*) filter (kids = 0) as leaves, sum(own) as saved from w x, unnest(range(0, x.d + 1)) u(a) group by 1, 2)
select w.conv_id, w.d::bigint as depth, w.up as parent_conv_id, w.n as n_convs, w.kids as n_children, below.leaves as n_leaves,
    below.saved::bigint as saved_tokens, w.ends as ends_sha256 from w join below on below.pre = w.pre and below.d = w.d"""


def repair() -> str:
    t = turn_repair
    cost = f"case when fault = {t.TRUNCATED} then {t.UNFINISHED} else 0 end"
    far = "{'c': 1000000000::bigint, 'a': ''}"

    def plus(state: int, price: str, edit: str, when: str = "true") -> str:
        return f"case when {when} then {{'c': q[{state + 1}].c + {price}, 'a': q[{state + 1}].a || '{edit}'}} else {far} end"

    stays = f"fault not in ({t.BLANK}, {t.DUPLICATE})"
    options: dict[int, list[str]] = {s: [plus(s, str(t.DELETE), "D")] for s in t.STATES}
    for (state, initial), to in t.KEPT.items():
        options[to].append(plus(state, f"{cost} + {t.KEEP}", "K", f"{stays} and initial = '{initial}'"))
    for state, to in enumerate(t.TURNED):
        options[to].append(plus(state, f"{cost} + {t.REROLE}", "R", stays))
    taken = ", ".join(f"list_min([{', '.join(options[s])}])" for s in t.STATES)
    fresh = ", ".join(f"{{'c': q[{s + 1}].c + {t.INSERT}, 'a': q[{s + 1}].a || 'I'}}" for s in (t.NOTHING, t.SYSTEM, t.ASSISTANT))
    with_user = f"[q[1], q[2], list_min([q[3], {fresh}]), q[4]]"
    with_both = f"[q[1], q[2], q[3], list_min([q[4], {{'c': q[3].c + {t.INSERT}, 'a': q[3].a || 'I'}}])]"
    return f"""
with recursive {CRC_TABLE},
raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations, crc),
damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text
    from raw, unnest(case when kind = 3 then [0, 1] else [0] end) u(copy) where kind <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
judged as (select conv_id, i, turn, role, text, left(role, 1) as initial,
    case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then {t.BLANK}
         when row_number() over (partition by conv_id, role, text order by i) > 1 then {t.DUPLICATE}
         when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then {t.TRUNCATED} else {t.SOUND} end as fault,
    lead(left(role, 1)) over (partition by conv_id order by i) as following from placed),
steps(conv_id, i, q) as (
    select distinct conv_id, 0::bigint, [{{'c': 0::bigint, 'a': ''}}, {far}, {{'c': {t.INSERT}::bigint, 'a': 'I'}}, {{'c': {2 * t.INSERT}::bigint, 'a': 'II'}}] from conversations
    union all
    select conv_id, i, {with_both} from (select conv_id, i, {with_user} as q from (
        select s.conv_id, j.i, [{taken}] as q from steps s join judged j on j.conv_id is not distinct from s.conv_id and j.i = s.i + 1))),
found as (select conv_id, list_min([q[1], q[4]]) as best from steps qualify row_number() over (partition by conv_id order by i desc) = 1),
stats as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = {t.BLANK}) as blank,
    count(*) filter (fault = {t.DUPLICATE}) as duplicate, count(*) filter (fault = {t.TRUNCATED}) as truncated,
    count(*) filter (following is not null and initial || following not in ('su', 'ua', 'au')) as illegal from judged group by conv_id),
e as (select conv_id, p, best.a[p] as edit, (len(best.a) - len(replace(best.a, 'D', ''))) as deleted, len(best.a) as n from found, unnest(range(1, len(best.a) + 1)) u(p)),
f as (select *, sum(case when edit = 'I' then 0 else 1 end) over w as i, sum(case when edit = 'D' then 0 else 1 end) over w as out, (n - deleted) % 2 as odd
    from e window w as (partition by conv_id order by p)),
g as (select f.conv_id, p, case when edit = 'K' then role when (out - odd) % 2 = 1 then 'user' else 'assistant' end || ':' || case when edit = 'I' then '' else text end as line
    from f left join judged j on j.conv_id is not distinct from f.conv_id and j.i = f.i where edit <> 'D'),
d as (select conv_id, string_agg(line, chr(10) order by p) as lines from g group by conv_id)
select found.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, best.c as cost, best.a as audit, sha256(coalesce(lines, '')) as repaired_sha256
from found left join stats on stats.conv_id is not distinct from found.conv_id left join d on d.conv_id is not distinct from found.conv_id"""


def mix() -> str:
    weights, epochs = list(mixing.WEIGHTS), mixing.EPOCHS
    return f"""
with d as (select doc_id, coalesce(source, '') as src, source is not null as named, {words("coalesce(text, '')")}::bigint as size,
    md5(coalesce(doc_id::varchar, '')) as k from documents),
s as (select src, named, sum(size)::bigint as n, {weights}[((row_number() over (order by named desc, src) - 1) % {len(weights)} + 1)::int] as w from d group by src, named),
t as (select *, {mixing.SHARE} * sum(n) over () as total, row_number() over o as i, coalesce(sum({epochs} * n) over b, 0) as held, sum(w) over () - coalesce(sum(w) over b, 0) as open
    from s window o as (order by {epochs} * n / w, src), b as (order by {epochs} * n / w, src rows between unbounded preceding and 1 preceding)),
l as (select arg_min((total - held) / open, i) filter ((total - held) / open < {epochs} * n / w) as level from t),
g as (select t.*, case when level is null then {epochs}.0 * n else least({epochs}.0 * n, level * w) end::double as target from t, l),
p as (select d.*, g.n, g.target, least(round(g.target)::bigint, {epochs} * g.n) as want,
    coalesce(sum(size) over (partition by d.src, d.named order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0) as a
    from d join g on g.src = d.src and g.named = d.named)
select doc_id, size, n as source_size, target, ({" + ".join(f"greatest(0, least(a + size + {e} * n, want) - (a + {e} * n))" for e in range(epochs))})::bigint as taken from p"""
