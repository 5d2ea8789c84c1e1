"""DuckDB SQL for the queries that SQL can express. Scores, tokenisers and test batteries are not among them."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
with sized as (
  select doc_id, source, len({WORDS.format('text')})::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, chr(0) || 'null')), 1, 15))::bigint as h
  from documents),
src as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
         source_size * 3.0::double as ceiling from src),
lev as (
  select *, ((sum(source_size) over () * 1.0::double) - coalesce(sum(ceiling) over (o rows between unbounded preceding and 1 preceding), 0.0))
            / (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0.0)) as level,
         row_number() over o as rnk
  from weighed window o as (order by ceiling / weight, source nulls last)),
fst as (select min(rnk) as rnk, arg_min(level, rnk) as level from lev where level * weight < ceiling),
tgt as (
  select lev.source, source_size, case when fst.rnk is null or lev.rnk < fst.rnk then ceiling else fst.level * weight end as target
  from lev, fst),
part as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from tgt),
same as (select source, h, sum(size) as n from sized group by source, h),
cums as (select *, sum(n) over (partition by source order by h) as cum from same)
select s.doc_id, s.size, p.source_size, p.target,
  ((p.whole + case when c.cum <= p.part or (c.cum - c.n < p.part and p.part - (c.cum - c.n) > c.cum - p.part) then 1 else 0 end) * s.size)::bigint as taken
from sized s
join (select *, target - whole * source_size as part from part) p on s.source is not distinct from p.source
join cums c on s.source is not distinct from c.source and s.h = c.h
"""

OP4 = f"""
with recursive d as (select doc_id, {WORDS.format(LOWER.format('text'))} as w from documents),
sh as (select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda k: array_to_string(w[k:k+4], ' '))) as s from d where len(w) > 0),
n as (select doc_id, count(*) as n from sh group by 1),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from sh a join sh b using (s) group by 1, 2),
links as (select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * shared >= 75 * (na.n + nb.n - shared)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.c, d.doc_id)::bigint as component_id
from d left join n on n.doc_id = d.doc_id left join (select a, min(b) as c from reach group by a) c on c.a = d.doc_id
"""

OP6 = f"""
with d as (select doc_id, {WORDS.format(LOWER.format('text'))} as w from documents),
i as (select item_id, {WORDS.format(LOWER.format('text'))} as w from benchmark),
wd as (select distinct least(len(w), 5) as k from i where len(w) > 0),
ds as (select distinct doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j+k-1], ' '))) as s from d, wd where len(w) >= k),
si as (select distinct item_id, least(len(w), 5) as k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda j: array_to_string(w[j:j+4], ' '))) as s from i where len(w) > 0),
n as (select item_id, count(*) as n_item from si group by 1)
select doc_id, ds_i.item_id, n_item::int as n_item, count(*)::int as n_shared
from ds join si as ds_i using (s, k) join n on n.item_id = ds_i.item_id
group by 1, 2, 3 having count(*) * 100 >= 75 * n_item
"""

OP7 = f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select doc_id, pos, line, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from l),
f as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
m as (select k.doc_id, k.pos, k.line, f.key is not null and k.doc_id > f.first as dropped from k left join f on k.key = f.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from m group by doc_id
"""

OP8 = """
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest as g, min(page_id) as first from p where payload_bytes >= 100 group by 1 having count(*) > 1)
select page_id, payload_bytes, payload_digest, case when page_id > first then 'revisit' else 'response' end as record_type,
  case when page_id > first then first end as refers_to
from p left join f on payload_digest = g
"""

OP10 = f"""
with d as (select doc_id, {WORDS.format('text')} as w from documents),
x as (select doc_id, unnest(range(1, len(w) - 11)) as i, w from d where len(w) >= 13),
win as (select doc_id, i, array_to_string(w[i:i+12], ' ') as s from x),
f as (select s, min(doc_id) as first from win group by s having count(distinct doc_id) > 1),
hit as (select doc_id, i from win join f using (s) where doc_id > first),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as j from hit),
g as (select doc_id, list(j) as js from gone group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(js), 0)::bigint as n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda j: js is null or not list_contains(js, j)), lambda j: w[j]), ' ')) as kept_sha256
from d left join g using (doc_id)
"""

_ESC = r"replace(replace(replace(replace(replace({0}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"
OP9 = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 1 + case when role = 'assistant' then 9 else 15 end)::bigint as formatted_chars
from c group by conv_id
"""


# crc32 of a decimal number: each byte comes in by xor, then eight steps (-1) of the reflected polynomial
CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split({0}::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: case when x >= 0 then xor(c, x) else xor(c // 2, case when c % 2 = 1 then 3988292384 else 0 end) end), 4294967295::bigint)"""

OP13 = f"""
with given as (select doc_id, {WORDS.format('text')} as w, {CRC32.format('doc_id')} as h from documents),
plan as (select *, len(w)::bigint as n, case when len(w) > 0 then (h // 10) % len(w) end as a from given),
period as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from plan),
d as (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) else w end as w from period),
six as (select doc_id, i, array_to_string(w[i + 1 : i + 6], ' ') as s from (select doc_id, w, unnest(range(n - 5)) as i from d where n >= 12)),
pair as (select x.doc_id, x.i, y.i - x.i as q from six x join six y on x.doc_id = y.doc_id and x.s = y.s and x.i < y.i),
stretch as (select doc_id, q, min(i) as start, count(*) + 5 + q as length from (select *, i - row_number() over (partition by doc_id, q order by i) as island from pair) group by doc_id, q, island),
run as (select doc_id, start, length, min(q) as period from stretch where length >= greatest(12, 2 * q) group by 1, 2, 3),
told as (
  select doc_id, count(*) as n_runs, arg_max([start, length, period], [length, -start, -period]) as best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from run group by 1),
gone as (select doc_id, list(distinct i) as js from (select doc_id, unnest(range(start + period, start + length)) as i from run) group by 1),
kept as (
  select d.doc_id, string_agg(x, ' ' order by i) as body
  from (select doc_id, unnest(w) as x, unnest(range(n)) as i from d) d left join (select doc_id, unnest(js) as i from gone) g using (doc_id, i) where g.doc_id is null group by 1)
select d.doc_id, coalesce(n_runs, 0)::bigint as n_runs, best[1]::bigint as start, best[2]::bigint as length, best[3]::bigint as period, (1000 * best[2] // best[3])::bigint as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(body, '')) as collapsed_sha256
from d left join told using (doc_id) left join kept using (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1, "op4_parity_join": OP4, "op6_decontaminate": OP6, "op7_line_dedup": OP7, "op8_warc_zip": OP8, "op9_chat_format": OP9, "op10_substring_dedup": OP10, "op13_periodic_runs": OP13}
