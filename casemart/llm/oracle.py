"""SQL answers to the registered queries that SQL can express."""

from __future__ import annotations

_WARC = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as bytes, sha1(coalesce(html, '')) as digest from pages),
owners as (
    select digest, max(page_id) as page from payloads where bytes >= 1000 group by digest)
select page_id, cast(bytes as bigint) as payload_bytes, digest as payload_digest,
    case when page > page_id then 'revisit' else 'response' end as record_type,
    case when page > page_id then page end as refers_to
from payloads left join owners using (digest)"""

_JACCARD = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (
    select doc_id, list_distinct(case when len(w) >= 5 then
        [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
elements as (select doc_id, unnest([hash(x) for x in s]) as e from sets),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n from elements a join elements b
    on a.e = b.e and a.doc_id <> b.doc_id group by all),
links as materialized (
    select a, b from shared join sets x on x.doc_id = a join sets y on y.doc_id = b
    where 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
reach as (
    select doc_id, doc_id as other from sets
    union select reach.doc_id, links.b from reach join links on reach.other = links.a)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, coalesce(n_links, 0) as n_links
from sets join (select doc_id, min(other) as component_id from reach group by doc_id) using (doc_id)
left join (select a as doc_id, count(*) as n_links from links group by a) using (doc_id)"""


_TRIE = r"""
with recursive turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first,
        sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) as p,
        {'role': coalesce(role, ''), 'text': coalesce(text, '')} as turn
    from conversations where conv_id is not null),
heads as (
    select conv_id, list_reduce(list_prepend(4294967295::bigint, flatten([
        [ascii(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for d in string_split(conv_id::varchar, '')])),
        lambda crc, b: case when b >= 0 then xor(crc, b) when crc % 2 = 1 then xor(crc // 2, 3988292384) else crc // 2 end) as crc
    from (select distinct conv_id from turns)),
lengths as (select conv_id, xor(crc, 4294967295) % 9 as h from heads),
taken as (
    select c.conv_id, t.p, t.turn, 0 as own from lengths c join turns t on t.conv_id = c.conv_id - c.conv_id % 5 and t.p <= c.h
    union all select c.conv_id, t.p, t.turn, 1 from lengths c join turns t on t.conv_id = c.conv_id and t.p > c.h),
whole as materialized (
    select conv_id, coalesce(list(turn order by own, p) filter (turn is not null), []) as path from lengths left join taken using (conv_id) group by conv_id),
members as (select conv_id, path[1 : d] as node, d as depth, len(path) = d as ends from whole, unnest(range(len(path) + 1)) as u(d)),
nodes as materialized (
    select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256,
        case when depth > 0 then (count(*) - 1) * octet_length(encode(node[depth].text)) else 0 end as cost
    from members group by node, depth),
children as (select node[1 : depth - 1] as node, count(*) as n from nodes where depth > 0 group by 1),
sums as (
    select u.node[1 : d] as node, count(*) filter (c.n is null) as n_leaves, sum(u.cost) as saved
    from nodes u left join children c using (node), unnest(range(u.depth + 1)) as r(d) group by 1)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
    s.n_leaves, cast(s.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join sums s using (node) left join children c using (node)
left join nodes p on n.depth > 0 and p.node = n.node[1 : n.depth - 1]"""

_FILTERS = r"""
with read as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as w from documents),
smallest as (select text, min(doc_id) as least from read group by text),
said as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
    from labels where doc_id is not null group by doc_id),
failures as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
        case when len(w) < 50 then 1 else 0 end
        + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
        + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) then 4 else 0 end
        + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
        + case when doc_id > least then 16 else 0 end as f
    from read join smallest using (text) left join said using (doc_id)),
counts as (select part, f, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as t from failures group by all),
letters as (select unnest(range(5)) as k),
orders as (
    select [a.k, b.k, c.k, d.k, e.k] as o from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps as (
    select array_to_string([substr('ABCDE', x + 1, 1) for x in o], '') as filter_order, step, (1 << o[step])::int as own,
        list_sum([(1 << x)::int for x in o[1 : step - 1]]) as before from orders, unnest(range(1, 6)) as u(step)),
applied as (
    select part, filter_order, step, own,
        sum(n) filter (f & (coalesce(before, 0)::int + own) = 0) as kept, sum(n) filter (f & coalesce(before, 0)::int = 0 and f & own > 0) as removed,
        sum(n) filter (f & coalesce(before, 0)::int > 0 and f & own > 0) as redundant, sum(n) filter (f = own) as unique_fails,
        sum(g) filter (f & coalesce(before, 0)::int = 0 and f & own > 0) as good_lost, sum(t) filter (f & coalesce(before, 0)::int = 0 and f & own > 0) as toxic_lost
    from counts, steps group by all)
select part, filter_order, cast(step as int) as step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
    cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
    cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
    cast(coalesce(sum(removed) over (partition by part, own), 0) as bigint) as shapley
from applied"""

_LINES = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
    from documents),
keyed as materialized (
    select doc_id, line, i, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
common as (select key, true as gone from keyed where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (gone is null), '')) as kept_sha256
from keyed left join common using (key) group by doc_id"""


def oracle_queries() -> dict[str, str]:
    """The others rest on tokenizers, learned models or spans of regexes; tests/llm compares them with plain Python."""
    return {
        "op4_warc": _WARC,
        "op7_ngram_jaccard_join": _JACCARD,
        "op11_prefix_trie": _TRIE,
        "op12_filter_audit": _FILTERS,
        "op13_line_dedup": _LINES,
    }
