"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLES: dict[str, str] = {
    "op2_warc": r"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first_page from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and first_page < page_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and first_page < page_id then first_page end as refers_to
from f
""",
    "op3_chat_formatting": r"""
with every as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), stepped as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
           lead(role) over (partition by conv_id order by turn, role, text) as after
    from every
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('### ') + length(': ') + length('</turn>' || chr(10)) + length(text)
           + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
           + case role when 'system' then length('System') when 'user' then length('User') when 'assistant' then length('Assistant')
             else 1 + 2 * length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', '')) end
       )::bigint as formatted_chars,
       bool_and(case when before is null then role in ('system', 'user')
                     when before in ('system', 'assistant') then role = 'user'
                     when before = 'user' then role = 'assistant' else false end
                and (after is not null or role = 'assistant')) as valid
from stepped group by conv_id
""",
    "op11_hard_negative_mining": r"""
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id, list_dot_product(a.v, r.v)::bigint as score
    from rows a join rows r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), negatives as (
    select p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
           row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
    from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
     and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
""",
    "op13_filter_interaction_audit": r"""
with recursive words as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), failed as (
    select d.doc_id, part,
           case when len(w) < 50 then 1 else 0 end
           + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
           + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end
           + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
           + case when min(d.doc_id) over (partition by t) < d.doc_id then 16 else 0 end as failed
    from words d
), marked as (
    select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from failed left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) using (doc_id)
    group by part, failed
), orders(filter_order, step, before, own) as (
    select letter, 1, 0, bit from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)
    union all
    select filter_order || letter, step + 1, before | own, bit
    from orders, (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)
    where step < 5 and (before | own) & bit = 0
), steps as (
    select o.filter_order, s.step, s.before, s.own from orders o join orders s on o.step = 5 and starts_with(o.filter_order, s.filter_order)
), counted as (
    select part, filter_order, step, own,
           coalesce(sum(n) filter (failed & (before | own) = 0), 0)::bigint as kept,
           coalesce(sum(n) filter (failed & before = 0 and failed & own > 0), 0)::bigint as removed,
           coalesce(sum(n) filter (failed & before > 0 and failed & own > 0), 0)::bigint as redundant,
           coalesce(sum(n) filter (failed = own), 0)::bigint as unique_fails,
           coalesce(sum(good) filter (failed & before = 0 and failed & own > 0), 0)::bigint as good_lost,
           coalesce(sum(toxic) filter (failed & before = 0 and failed & own > 0), 0)::bigint as toxic_lost
    from steps, marked group by all
)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from counted
""",
}
