"""SQL for the operators that SQL can express, written on its own."""

from __future__ import annotations

_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
), largest as (
  select html, max(page_id) as first from p where payload_bytes >= 1000 group by html
)
select p.page_id, p.payload_bytes, sha1(p.html) as payload_digest,
  case when first is null or first = p.page_id then 'response' else 'revisit' end as record_type,
  case when first is null or first = p.page_id then null else first end as refers_to
from p left join largest using (html)
"""

OP5 = f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') as words from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '{_WORDS}') as words from benchmark
), windows as (
  select item, words[i : i + 9] as w
  from (select item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from b where len(words) > 0)
), lengths as (
  select distinct len(w) as size from windows
), places as (
  select r, size, i, words[i : i + size - 1] as w
  from (select r, words, size, unnest(range(1, len(words) - size + 2)) as i from d, lengths where len(words) >= size)
), hits as (
  select r, i, size, item from places join windows using (w)
), words_hit as (
  select r, count(distinct place) as n_hit from (select r, unnest(range(i, i + size)) as place from hits) group by r
), items as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hits group by r
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words_hit using (r) left join items using (r)
"""

OP11 = """
with v as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.r as a, a.vec_id as anchor_id, a.label = c.label as same, c.vec_id as id,
    cast(list_inner_product(a.q, c.q) as bigint) as score
  from v a, v c where a.vec_id % 100 = 0
), positive as (
  select a, anchor_id, id as positive_id, score as positive_score,
    row_number() over (partition by a order by score desc, id nulls last) as p
  from scored where same and id is distinct from anchor_id
  qualify p <= 5
), negative as (
  select a, p, positive.anchor_id, positive_id, positive_score, id as negative_id, score as negative_score,
    row_number() over (partition by a, p order by score desc, id nulls last) as rank
  from positive join scored using (a)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
  qualify rank <= 10
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from negative
"""

ORACLES = {"op4_warc": OP4, "op5_decontamination": OP5, "op11_hard_negatives": OP11}
