"""DuckDB SQL for the queries whose results SQL can say.

Plain restatements: exact shingle joins instead of signatures, string keys
instead of hashes.
"""

from __future__ import annotations

from maillens.llm import chat, decontam, logtree, superminhash

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _shingles(source: str, key: str, lowered: str) -> str:
    """(key, s): distinct five-word shingles; fewer words: all as one."""
    return f"""
    select distinct {key}, case when len(ws) >= 5 then list_aggregate(ws[i:i+4], 'string_agg', chr(1))
                                else list_aggregate(ws, 'string_agg', chr(1)) || chr(2) end as s
    from (select {key}, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i
          from (select {key}, list_filter(regexp_split_to_array({lowered}, '[\\x09-\\x0D\\x20]+'),
                                          lambda x: x <> '') as ws from {source})
          where len(ws) > 0)"""


_OP5 = f"""
with recursive sh as materialized ({_shingles('documents', 'doc_id', f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")}),
size as (select doc_id, count(*) as n from sh group by doc_id),
met as (select a.doc_id as a, b.doc_id as b, count(*) as s from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id
        group by 1, 2),
link as (select a, b from met join size x on x.doc_id = a join size y on y.doc_id = b
         where 100 * s >= {superminhash.PERCENT} * (x.n + y.n - s)),
both_ways as (select a, b from link union all select b, a from link),
reach(a, b) as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
low as (select a, least(a, min(b)) as c from reach group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(c, d.doc_id) as component_id,
       coalesce(c, d.doc_id) = d.doc_id as kept
from documents d left join size using (doc_id) left join low on low.a = d.doc_id
"""

_OP7 = f"""
with item as materialized ({_shingles('benchmark', 'item_id', "lower(coalesce(text, ''))")}),
doc as materialized ({_shingles('documents', 'doc_id', "lower(coalesce(text, ''))")}),
size as (select item_id, count(*) as n_item from item group by item_id),
met as (select doc_id, item_id, count(*) as n_shared from doc join item using (s) group by 1, 2)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from met join size using (item_id) where 100 * n_shared >= {decontam.CONTAINED} * n_item
"""

_D = logtree.DEPTH
_NEEDED = "case " + " ".join(f"when t >= {n} then {d}" for n, d in logtree.RECURS) + " end"
_MASKED = "list_transform(ts, lambda x, i: case when i between p and p + w - 1 then '<*>' else x end)"
_OP10 = f"""
with parts as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
line as (select doc_id, pos, trim(ls[pos + 1], ' ') as l from (select doc_id, ls, unnest(range(len(ls))) as pos from parts)),
field as (select doc_id, pos, string_split(l, ' ') as raw, list_transform(string_split(l, ' '),
                 lambda t: case when regexp_matches(t, '[0-9]') then '<*>' else t end) as ms from line where l <> ''),
form as (select doc_id, pos, case when 2 * len(list_filter(ms, lambda t: t = '<*>')) > len(ms) then raw else ms end as ts
         from field),
kept as materialized (select doc_id, pos, len(ts) as t, ts, [len(ts)::varchar] || ts[1:{_D}] as leaf from form),
body as materialized (select distinct leaf, ts, t from kept where leaf in (
    select leaf from kept where t >= {_D + logtree.ONE} group by leaf
    having count(distinct ts) > 1 and count(distinct doc_id) > 1)),
variant as materialized (
    select leaf, ts, w, p, {_MASKED} as v from (
        select *, unnest(range({_D + 1}, t - w + 2)) as p from body, (values (1, {logtree.ONE}), (2, {logtree.TWO})) x(w, least)
        where t - {_D} >= least)),
shared as (select leaf, w, p, v, count(*) as c from variant group by all having count(*) > 1),
member as (select leaf, ts, v from variant join shared using (leaf, w, p, v)
           qualify row_number() over (partition by leaf, ts order by c desc, w, p) = 1),
keyed as (select doc_id, pos, t, leaf, coalesce(m.v, k.ts) as tail from kept k left join member m using (leaf, ts)),
often as (select leaf, tail, min(doc_id) as first_doc from keyed group by leaf, tail, t
          having count(distinct doc_id) >= {_NEEDED}),
gone as (select doc_id, list(pos) as ps from keyed join often using (leaf, tail) where doc_id <> first_doc group by doc_id)
select doc_id, coalesce(len(ls), 0) as n_lines, coalesce(len(ps), 0) as n_dropped,
       case when ps is null then text
            else array_to_string(list_transform(list_filter(range(len(ls)), lambda i: not list_contains(ps, i)), lambda i: ls[i + 1]), chr(10)) end as text
from parts left join gone using (doc_id)
"""

_CONTROL = r"(/?s>|\||/?INST\])"
_OP9 = rf"""
with raw as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
             union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
             union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc as (select *, regexp_replace(body, '([<\[]\\*){_CONTROL}', '\1\\\2', 'g') as e from raw),
tok as (select *, cast(ceil(strlen(e) / 4.0) as bigint) + 4 as tokens,
               row_number() over (partition by conv_id order by turn, role, body) as i from esc),
lead as (select conv_id, arg_min(tokens, i) as st from tok where role = '{chat.SYSTEM}' group by conv_id),
room as (select *, case when st <= {chat.BUDGET // 2} then st else 0 end as kept from tok left join lead using (conv_id)),
cellular as (select *, ({chat.BUDGET - chat.HISTORY} - kept) // 2 as size_c from room),
pre as (select *, cast(sum(tokens) over w as bigint) as fin, tokens > size_c as big,
               cast(sum((tokens > size_c)::int) over w as bigint) as nb from cellular
        window w as (partition by conv_id order by i rows unbounded preceding)),
placed as (select *, fin - tokens as start, 2 * (nb - big::int) + big::int as part,
                  case when big then 0 else (fin - 1) // size_c end as cell,
                  length(role) + length(e) + {len('<||>') + 1 + len(chat.END)} as size from pre),
span as (select conv_id, part, cell, min(start) as s, sum(tokens) as own, max(kept) as kept from placed group by all),
sys as (select conv_id, arg_min(part, start) as part, arg_min(cell, start) as cell, min(start) as a, arg_min(size, start) as size
        from placed where role = '{chat.SYSTEM}' group by conv_id),
extra as (select span.conv_id, sum(sys.size) as n from span join sys using (conv_id)
          where (sys.part, sys.cell) <> (span.part, span.cell) and a < s and kept > 0 and own + kept <= {chat.BUDGET}
          group by 1
          union all
          select span.conv_id, sum(p.size) from span join placed p using (conv_id) left join sys using (conv_id)
          where p.start < s and p.start >= s - {chat.HISTORY} and (a is null or a <> p.start)
            and span.own + span.kept + {chat.HISTORY} <= {chat.BUDGET} group by 1),
total as (select conv_id, sum(n) as n from (select conv_id, n from extra union all select conv_id, size from placed) group by 1),
loss as (select conv_id, coalesce(string_agg(body, '' order by i) filter (where role = '{chat.TARGET}'), '') as l,
                string_agg(role || chr(10) || body || chr(10), '' order by i) as said, count(*) as n_turns
         from tok group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(l) as loss_chars, sha256(l) as loss_sha256,
       cast(n as bigint) as formatted_chars
from loss join total using (conv_id)
"""

_OP12 = """
with r as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
           list_inner_product(a.v, b.v)::bigint as score
    from r a join r b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
pos as (select anchor_id, other, score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, p.other as positive_id,
       row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other)::int as rank,
       n.other as negative_id, p.score as positive_score, n.score as negative_score
from pos p join s n using (anchor_id)
where not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""

ORACLE: dict[str, str] = {
    "op5_superminhash": _OP5,
    "op7_containment": _OP7,
    "op9_chat_windows": _OP9,
    "op10_line_templates": _OP10,
    "op12_angular_negatives": _OP12,
}
