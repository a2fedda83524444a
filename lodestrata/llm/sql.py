"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_exact_top_k": """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from usable q join usable c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 20
""",
    "op6_url_filter": """
with split as (
  select page_id,
    case when instr(coalesce(url, ''), '://') = 0 then '' else substr(url, instr(url, '://') + 3) end as rest
  from pages
),
parts as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from split
),
rules(rule_host, rule_path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
named as (
  select page_id, host, path,
    (select rule_host || rule_path from rules where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
     order by length(rule_host || rule_path) desc, length(rule_host) desc limit 1) as rule
  from parts
),
ruled as (select n.*, r.verdict as ruled from named n left join rules r on n.rule = r.rule_host || r.rule_path),
hosts as (
  select host, count(ruled)::double as n, count_if(ruled = 'block')::double as k,
    array_to_string(string_split(regexp_replace(host, ':[0-9]*$', ''), '.')[-2:], '.') as domain,
    string_split(regexp_replace(host, ':[0-9]*$', ''), '.')[-1] as suffix
  from ruled group by host
),
root as (select (sum(k) + 0.5) / (sum(n) + 1.0) as m from hosts),
domains as (select suffix, domain, sum(n) as n, sum(k) as k from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k, (select m from root) as m from domains group by suffix),
fit_suffix as (
  select 1 / least(0.99, greatest(0.01, coalesce((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5))) - 1 as s
  from suffixes where n > 0
),
by_suffix as (select suffix, (k + s * m) / (n + s) as m from suffixes, fit_suffix),
in_suffix as (select d.*, m from domains d join by_suffix using (suffix)),
fit_domain as (
  select 1 / least(0.99, greatest(0.01, coalesce((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5))) - 1 as s
  from in_suffix where n > 0
),
by_domain as (select suffix, domain, (k + s * m) / (n + s) as m from in_suffix, fit_domain),
in_domain as (select h.*, m from hosts h join by_domain using (suffix, domain)),
fit_host as (
  select 1 / least(0.99, greatest(0.01, coalesce((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / nullif(sum((n - 1) * m * (1 - m)), 0), 0.5))) - 1 as s
  from in_domain where n > 0
),
beta as (select host, k + s * m as a, n - k + s * (1 - m) as b from in_domain, fit_host),
bounds as (select host, a / (a + b) - 1.2816 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from beta)
select page_id, r.host, path, rule, coalesce(ruled, case when bound > 0.5 then 'block' else 'allow' end) as verdict
from ruled r join bounds using (host)
""",
    "op10_decontamination": """
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
),
windows as (
  select distinct item_id, least(len(w), 13) as size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from item_words where len(w) > 0)
),
sizes as (select distinct size from windows),
found as (
  select d.doc_id, d.i, x.size, x.item_id
  from (
    select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as s
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from doc_words, sizes where len(w) >= size)
  ) d join windows x on d.s = x.s and d.size = x.size
),
hits as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, i, size from found)) group by doc_id
),
items as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select d.doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
  sha256(coalesce(i.names, '')) as items_sha256,
  coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) as contaminated
from doc_words d left join hits h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
""",
}
