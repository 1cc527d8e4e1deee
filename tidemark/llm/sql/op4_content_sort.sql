with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by body) as group_size,
  row_number() over w = 1 as kept, sha256(body) as text_sha256
from d window w as (partition by body order by doc_id nulls last)
