with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents
), s as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as shingles
  from w
), e as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
both_ as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as common
  from e a join e b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), links as (select a, b from both_ where 100 * common >= 80 * (n + m - common)),
reach(node, other) as (
  select doc_id, doc_id from documents
  union
  select reach.node, links.b from reach join links on reach.other = links.a
)
select s.doc_id, any_value(len(shingles)) as n_shingles, min(other) as component_id
from s join reach on reach.node = s.doc_id group by s.doc_id
