"""DuckDB SQL for the operators that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from .chat import CONTROL
from .queries import CONTROL_TURN

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CONTROLS = "|".join("".join("\\" + c if c in "|[]()<>/.*+?" else c for c in x) for x in CONTROL).replace("\\<", "<").replace("\\>", ">").replace("\\/", "/")


def _escaped(text: str) -> str:
    """Characters of a text once control strings are escaped."""
    return f"length({text}) + length({text}) - length(replace({text}, '\\', '')) + len(regexp_extract_all({text}, '{_CONTROLS}'))"


_OP1 = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, 0, 'user', '{CONTROL_TURN}'
    union all
    select -1, 1, 'assistant', '{CONTROL_TURN}'
)
select
    conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(33 + {_escaped("role")} + {_escaped("text")})::bigint as formatted_chars
from turns
group by conv_id
"""

_OP7 = rf"""
with recursive worded as (
    select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w from documents
),
shingled as (
    select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) = 1 then w
        else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
    from worded
),
classes as (select min(doc_id) as id, list_sort(s) as s, len(s) as n from shingled where len(s) > 0 group by list_sort(s), len(s)),
flat as (select id, n, unnest(s) as x from classes),
pairs as (
    select a.id as a, b.id as b from flat a join flat b on a.x = b.x and a.id < b.id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
links as (select a, b from pairs union select b, a from pairs),
reach as (select a as id, a as seen from links union select r.id, l.b from reach r join links l on r.seen = l.a),
roots as (select id, min(seen) as root from reach group by id)
select s.doc_id, len(s.s)::bigint as n_shingles,
    coalesce(r.root, c.id, s.doc_id) as component_id, s.doc_id = coalesce(r.root, c.id, s.doc_id) as kept
from shingled s left join classes c on list_sort(s.s) = c.s left join roots r on c.id = r.id
"""

_OP8 = rf"""
with doc_words as (
    select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
),
item_words as (
    select item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
),
windows as (
    select distinct item_id, least(len(w), 13) as n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as x
    from item_words, unnest(range(1, len(w) - least(len(w), 13) + 2)) as t(i) where len(w) > 0
),
spans as (
    select d.doc_id, i as pos, n, array_to_string(w[i : i + n - 1], ' ') as x
    from doc_words d, (select distinct n from windows) k, unnest(range(1, len(w) - n + 2)) as t(i)
),
hits as (select s.doc_id, s.pos, s.n, v.item_id from spans s join windows v on s.n = v.n and s.x = v.x),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as p from hits) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id
)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words d left join hit_words h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""

_BITS = "array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(strpos('0123456789abcdef', hex[i]) - 1), 4)), '')"
_OP9 = f"""
with hashed as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
bits as (select page_id, html, hex, {_BITS} as b from hashed),
coded as (
    select page_id, octet_length(encode(html))::bigint as payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
            1 + 16 * b[5 * i + 1]::int + 8 * b[5 * i + 2]::int + 4 * b[5 * i + 3]::int + 2 * b[5 * i + 4]::int + b[5 * i + 5]::int]), '') as payload_digest,
        max(page_id) over (partition by html) as newest
    from bits
)
select page_id, payload_bytes, payload_digest, case when page_id = newest then 'response' else 'revisit' end as record_type,
    case when page_id <> newest then newest end as refers_to
from coded
"""

_OP12 = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from worded group by lang),
grams as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
    from worded, unnest([1, 2, 3, 4]) as t(k), unnest(range(1, len(w) - k + 2)) as u(i)
),
f as (select lang, k, phrase, count(*) as f from grams group by lang, k, phrase),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 30),
cuts as (
    select c.lang, c.k, c.phrase, c.a, x.f as l, y.f as r, cut, (2000000::hugeint * c.a) // (x.f + y.f) as score
    from (select *, unnest(range(1, k)) as cut from candidates) c
    join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : cut], ' ')
    join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1 :], ' ')
),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
    select lang, array_to_string(w[i : i + m - 1], ' ') as phrase, max(a) as longer
    from candidates, unnest(range(2, k)) as t(m), unnest(range(1, k - m + 2)) as u(i) group by all
),
kept as (
    select c.* from lowest c left join inside i on c.lang = i.lang and c.phrase = i.phrase
    where coalesce(100::hugeint * i.longer < 80::hugeint * c.a, true)
),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score::bigint as score from ranked k join totals t on k.lang = t.lang where k.rank <= 2000
"""

#: CRC-32 by bits: a character is taken in, then shifted out eight times.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}::varchar, ''),
    lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))"""


def _tree(name: str, start: str, start_paths: str, levels: int = 6) -> str:
    """Levels of trees over (tree, pos, digest, n), and paths (row, tree, pos, now, others) up them."""
    made = [f"{name}_0 as ({start})", f"{name}_paths_0 as ({start_paths})"]
    for k in range(levels):
        made.append(f"""{name}_runs_{k} as (
    select tree, pos // 16 as pos, list(digest order by pos) as run, any_value(n) as n from {name}_{k} group by tree, pos // 16)""")
        made.append(f"""{name}_{k + 1} as (
    select tree, pos, case when n = 1 then run[1] else sha256(array_to_string(run, '')) end as digest, (n + 15) // 16 as n from {name}_runs_{k})""")
        made.append(f"""{name}_paths_{k + 1} as (
    select p.row, p.tree, p.pos // 16 as pos,
        case when n = 1 then now
            else sha256(array_to_string(run[1 : p.pos % 16], '') || now || array_to_string(run[p.pos % 16 + 2 :], '')) end as now,
        case when n = 1 then others
            else others || array_to_string(run[1 : p.pos % 16], '') || array_to_string(run[p.pos % 16 + 2 :], '') end as others
    from {name}_paths_{k} p join {name}_runs_{k} r on p.tree = r.tree and p.pos // 16 = r.pos)""")
    return ",\n".join(made)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP13 = f"""
with hashed as (
    select doc_id, source, {_leaf("text")} as leaf,
        case when {_CRC.format("doc_id")} % 5 = 0 then {_leaf(_LOWER.format("text"))} else {_leaf("text")} end as now
    from documents
),
trees as (select source, row_number() over (order by source nulls first) - 1 as tree from (select distinct source from documents)),
leaves as (
    select row_number() over () as row, doc_id, leaf, now, tree,
        row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n
    from hashed h join trees t on h.source is not distinct from t.source
),
{_tree("own", "select tree, pos, leaf as digest, n from leaves", "select row, tree, pos, now, '' as others from leaves")},
{_tree(
    "top",
    "select 0 as tree, tree as pos, digest, count(*) over () as n from own_6",
    "select row, 0 as tree, tree as pos, now, others from own_paths_6",
)}
select l.doc_id, l.leaf, s.digest as subroot, r.digest as root, sha256(p.others) as proof_sha256, p.now as folded_root, p.now = r.digest as verified
from leaves l join own_6 s on l.tree = s.tree join top_paths_6 p on l.row = p.row cross join top_6 r
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": _OP1, "op7_minhash": _OP7, "op8_decontamination": _OP8, "op9_warc": _OP9, "op12_phrases": _OP12, "op13_manifest": _OP13}
