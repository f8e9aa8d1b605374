"""SQL text of the operators that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
with items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from items where len(w) > 0)),
docs as (select row_number() over () as row_id, doc_id, {_WORDS} as w from documents),
grams as (
  select row_id, n, i, array_to_string(w[i:i + n - 1], ' ') as phrase
  from (select row_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, (select distinct n from windows))),
hits as (select g.row_id, g.i, g.n, v.item_id from grams g join windows v on g.n = v.n and g.phrase = v.phrase),
hit_words as (
  select row_id, count(distinct p) as n_hit from (select row_id, unnest(range(i, i + n)) as p from hits) group by row_id),
hit_items as (
  select row_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct row_id, item_id::varchar as item from hits where item_id is not null) group by row_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, n_hit is not null as contaminated
from docs left join hit_words using (row_id) left join hit_items using (row_id)
"""

REPEATS = """
with docs as (
  select row_number() over () as row_id, doc_id, octet_length(encode(coalesce(text, ''))) as n,
    hex(encode(coalesce(text, ''))) as digits from documents),
strings as (
  select row_id, doc_id, i, substr(digits, 2 * i + 1, 100) as string
  from (select row_id, doc_id, digits, unnest(range(0, n - 49)) as i from docs)),
firsts as (select string, min(doc_id) as first_id from strings group by string),
removed as (select row_id, i from strings join firsts using (string) where first_id < doc_id),
marked as (
  select row_id, i, case when i <= lag(i) over (partition by row_id order by i) + 50 then 0 else 1 end as begins from removed),
runs as (
  select row_id, min(i) as a, max(i) + 50 as b
  from (select row_id, i, sum(begins) over (partition by row_id order by i) as run from marked) group by row_id, run),
pieces as (
  select row_id, a, b, coalesce(lag(b) over (partition by row_id order by a), 0) as since from runs),
kept as (
  select row_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last_end,
    string_agg(substr(digits, 2 * since + 1, 2 * (a - since)), '' order by a) as front
  from pieces join docs using (row_id) group by row_id)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(front, '') || substr(digits, 2 * coalesce(last_end, 0) + 1))) as kept_sha256
from docs left join kept using (row_id)
"""

_DIGIT = "(strpos('0123456789abcdef', substr(digest, (5 * i) // 4 + {}, 1)) - 1)"

ARCHIVE = f"""
with payloads as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest,
    max(page_id) over (partition by coalesce(html, '')) as last_id from pages)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((({_DIGIT.format(1)} * 16 + {_DIGIT.format(2)}) >> (3 - (5 * i) % 4)) & 31)::int, 1) for i in range(0, 32)], '')
    as payload_digest,
  case when page_id = last_id then 'response' else 'revisit' end as record_type,
  case when page_id = last_id then null else last_id end as refers_to
from payloads
"""

FILTER_AUDIT = r"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
judged as (
  select doc_id, part,
    case when len(w) < 200 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
    || case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when min(doc_id) over (partition by t) < doc_id then 'E' else '' end as fails
  from docs),
marked as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
counted as (
  select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from judged left join marked using (doc_id) group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || r.x || s.x || t.x as filter_order from letters p, letters q, letters r, letters s, letters t
  where p.x <> q.x and r.x not in (p.x, q.x) and s.x not in (p.x, q.x, r.x) and t.x not in (p.x, q.x, r.x, s.x)),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from (select filter_order, unnest(range(1, 6)) as step from orders)),
sums as (
  select part, filter_order, step, own,
    sum(n) filter (where translate(fails, before || own, '') = fails) as kept,
    sum(n) filter (where contains(fails, own) and translate(fails, before, '') = fails) as removed,
    sum(n) filter (where contains(fails, own) and translate(fails, before, '') <> fails) as redundant,
    sum(n) filter (where fails = own) as unique_fails,
    sum(good) filter (where contains(fails, own) and translate(fails, before, '') = fails) as good_lost,
    sum(toxic) filter (where contains(fails, own) and translate(fails, before, '') = fails) as toxic_lost
  from counted, steps group by part, filter_order, step, own)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  (sum(coalesce(removed, 0)) over (partition by part, own))::bigint as shapley
from sums
"""

ORACLE = {
    "op1_decontamination": DECONTAMINATION, "op9_pfp": REPEATS, "op10_warc": ARCHIVE, "op13_filter_audit": FILTER_AUDIT,
}
