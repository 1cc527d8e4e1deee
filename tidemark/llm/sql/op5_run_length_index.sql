with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as i from d),
g as (select doc_id, i, substr(h, 2 * i + 1, 100) as gram from w),
f as (select gram, min(doc_id) as first_id from g group by gram having count(*) > 1),
hit as (select doc_id, i from g join f using (gram) where first_id < doc_id),
head as (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from hit),
grp as (select *, sum(new) over (partition by doc_id order by i) as s from head),
cut as (select doc_id, s, min(i) as a, max(i) + 50 as z from grp group by doc_id, s),
stops as (select doc_id, list(a order by a) as starts, list(z order by a) as ends, sum(z - a) as removed, count(*) as spans from cut group by doc_id)
select d.doc_id, len(h) // 2 as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(spans, 0) as n_spans,
  sha256(from_hex(case when starts is null then h else
    array_to_string(list_transform(range(1, len(starts) + 2), lambda k:
      substr(h, 2 * (case when k = 1 then 0 else ends[k - 1] end) + 1,
        2 * ((case when k > len(starts) then len(h) // 2 else starts[k] end) - (case when k = 1 then 0 else ends[k - 1] end)))), '') end)) as kept_sha256
from d left join stops using (doc_id)
