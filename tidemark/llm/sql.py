"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"


#: crc32 by the usual table of 256 remainders, a byte at a time.
_CRC = """bits as (
    select b, b as r, 0 as k from range(256) t(b)
    union all select b, case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, k + 1 from bits where k < 8),
crc as (select list(r order by b) as t from bits where k = 8)"""


def _crc32(raw: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex({raw}), '..'), lambda h: ('0x' || h)::bigint)), "
            "lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295)::bigint")


_OP1 = f"""
with recursive {_CRC},
texts as (select doc_id, encode(coalesce(text, '')) as raw from documents),
sums as (
    select doc_id, octet_length(raw) + 1 as size,
           {_crc32('raw')} as text_crc32
    from texts, crc),
bids as (
    select doc_id, s, -1.0 / ln((('0x' || md5(doc_id::varchar || ':' || s)[1:13])::bigint::double + 0.5) / 4503599627370496.0) as bid
    from documents, range(17) t(s)),
best as (select doc_id, arg_max(s, bid) filter (s < 16) as shard, arg_max(s, bid) as grown_shard from bids group by doc_id)
select doc_id, size::bigint as size, text_crc32, 'key' as law, shard::int as shard,
       row_number() over (partition by shard order by md5(doc_id::varchar)[1:3], doc_id) - 1 as slot, grown_shard::int as grown_shard
from sums join best using (doc_id)
"""

_OP3 = rf"""
with docs as (select doc_id, case when coalesce(text, '') = '' then []::varchar[] else regexp_extract_all(text, '{_WORD}') end as w from documents),
places as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from docs where len(w) >= 13),
grams as (select doc_id, i, array_to_string(w[i : i + 12], ' ') as gram from places),
firsts as (select gram, min(doc_id) as owner from grams group by gram),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as i from grams join firsts using (gram) where owner < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from docs),
kept as (select doc_id, string_agg(word, ' ' order by i) as text, count(*) as n from words anti join gone using (doc_id, i) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (doc_id)
"""


def _render(turns: str) -> str:
    return f"array_to_string(list_transform({turns}, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '')"


def _mask(turns: str) -> str:
    return (f"array_to_string(list_transform({turns}, lambda t: (length(t.role) + 13)::varchar || ':0,' || (length(t.text) + 11)::varchar || "
            "case when t.role = 'assistant' then ':1' else ':0' end), ',')")


_OP10 = f"""
with convs as (
    select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as c
    from conversations group by conv_id),
placed as (
    select conv_id, c, coalesce(nullif(len(c) - coalesce(list_position(list_reverse(list_transform(c, lambda t: t.role)), 'assistant'), 0), len(c)), len(c)) as i from convs),
replies as (select conv_id, c, i, coalesce(c[i + 1].text, '') as reply from placed),
nexts as (
    select conv_id, c, i, coalesce(lead(reply) over o, first_value(reply) over o) as other from replies window o as (order by conv_id nulls first)),
pairs as (select conv_id, c, list_concat(list_concat(c[1:i], [{{'role': 'assistant', 'text': other}}]), c[i + 2:]) as r from nexts),
counted as (
    select conv_id, c, r, coalesce(list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda k: c[k] = r[k]), false), 0) as p from pairs),
cut as (select conv_id, c, r, (case when p > 0 then p - 1 when len(c) = len(r) then len(c) else least(len(c), len(r)) end)::int as n_common from counted),
parts as (select conv_id, n_common, c[1:n_common] as prompt, c[n_common + 1:] as c, r[n_common + 1:] as r from cut)
select conv_id, n_common, {_render('prompt')} as prompt, {_render('c')} as chosen, {_mask('c')} as chosen_mask,
       {_render('r')} as rejected, {_mask('r')} as rejected_mask
from parts
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"unnest(regexp_extract_all({lower}, '{_TERM}'))"


_OP12 = f"""
with docs as (select doc_id, row_number() over () as k, text from documents),
words as (select k, doc_id, {_terms('text')} as term from docs),
found as (select k, doc_id, term, count(*) as tf from words group by all),
lengths as (select k, sum(tf)::bigint as n from found group by k),
whole as (select count(*) as docs, sum(n)::bigint as total from lengths),
terms as (select distinct item_id, {_terms('text')} as term from benchmark),
weights as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from found, whole where term in (select term from terms) group by term),
scores as (select item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * docs) // total)))))::bigint as score
           from terms join weights using (term) join found using (term) join lengths using (k), whole group by item_id, k, doc_id),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls first) as place, doc_id, score from scores where score > 0)
select item_id, place::int as rank, doc_id, score from ranked where place <= 50
"""


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
                                   for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_OP13 = f"""
with recursive {_CRC},
leaves as (
    select doc_id, lang, {_leaf('n_chars')} as leaf,
           case when {_crc32('encode(doc_id::varchar)')} % 7 = 0 then {_leaf('(n_chars + 1)')} else {_leaf('n_chars')} end as shown from documents, crc),
placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n,
           row_number() over () as k from leaves),
nodes as (
    select lang, 0 as level, i, n, leaf as h from placed
    union all
    select lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i)) from nodes where n > 1 group by lang, level, i // 2, n),
subroots as (select lang, level as height, h, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from nodes where n = 1),
crown as (
    select 0 as level, i, n, h from subroots
    union all
    select level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i)) from crown where n > 1 group by level, i // 2, n),
steps as (
    select k, v.level, v.i as me, s.i as other, s.h
    from placed p join (select distinct lang, level, n from nodes where n > 1) l on l.lang is not distinct from p.lang
    join nodes v on v.lang is not distinct from p.lang and v.level = l.level and v.i = p.i >> l.level
    left join nodes s on s.lang is not distinct from p.lang and s.level = l.level and s.i = xor(p.i >> l.level, 1)
    union all
    select k, r.height + c.level, c.i, s.i, s.h
    from placed p join subroots r on r.lang is not distinct from p.lang
    join crown c on c.n > 1 and c.i = r.i >> c.level left join crown s on s.level = c.level and s.i = xor(c.i, 1)),
proofs as (select k, sha256(string_agg(coalesce(h, ''), '' order by level)) as proof from steps group by k),
folds as (
    select k, 0 as level, shown as h from placed
    union all
    select f.k, f.level + 1, sha256(case when s.other < s.me then s.h || f.h else f.h || coalesce(s.h, '') end)
    from folds f join steps s on s.k = f.k and s.level = f.level)
select doc_id, leaf, r.h as subroot, t.h as root, coalesce(proof, sha256('')) as proof_sha256, f.h as folded_root, f.h = t.h as verified
from placed p join subroots r on r.lang is not distinct from p.lang join crown t on t.n = 1 left join proofs using (k)
join (select k, arg_max(h, level) as h from folds group by k) f using (k)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP8 = rf"""
with recursive docs as (select doc_id, case when coalesce(text, '') = '' then []::varchar[] else regexp_extract_all({_LOWER}, '{_WORD}') end as w from documents),
sets as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                                        else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as gram from docs),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as k from sets a join sets b using (gram) where a.doc_id < b.doc_id group by all),
links as (select x, y from shared join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 100 * k >= 85 * (s.n + t.n - k)),
edges as (select x, y from links union all select y, x from links),
reached as (select doc_id, doc_id as other from documents union select r.doc_id, e.y from reached r join edges e on e.x = r.other),
groups as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from documents join groups using (doc_id) left join sizes using (doc_id)
"""

ORACLES: dict[str, str] = {"op1_sharding": _OP1, "op3_substring_dedup": _OP3, "op8_minhash_near_dedup": _OP8,
                           "op10_preference_format": _OP10, "op12_lexical_search": _OP12, "op13_merkle_manifest": _OP13}
