with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
  select *, row_number() over w as pos, lag(role) over w as previous,
    length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(text, '<', '')))
      + 5 * (length(text) - length(replace(text, '[', ''))) as text_chars,
    length(role) + 4 * (length(role) - length(replace(role, '&', ''))) + 3 * (length(role) - length(replace(role, '<', '')))
      + 5 * (length(role) - length(replace(role, '[', ''))) as role_chars
  from rows_ window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(text_chars + case when previous is distinct from role then 24 + role_chars else 8 end) as bigint) as formatted_chars
from placed group by conv_id
