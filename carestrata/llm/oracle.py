"""The same results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

_FINE = "embedding is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))"

_OP1 = f"""
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and {_FINE} and list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false)))
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 20
"""

_OP9 = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and {_FINE}
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5
"""

_OP8 = r"""
with recursive d as (
  select doc_id, source, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 16) as key
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
    [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::integer] as w
  from d group by source
), fill as (
  select 0 as round, source, source_size, w, false as capped,
    1.5 * sum(source_size) over () * w / sum(w) over () as target
  from s
  union all
  select round + 1, source, source_size, w, over,
    case when over then 2.0 * source_size
      else (1.5 * sum(source_size) over () - sum(case when over then 2.0 * source_size else 0 end) over ())
        * w / sum(case when over then 0 else w end) over () end
  from (select *, capped or target > 2.0 * source_size as over,
          bool_or(not capped and target > 2.0 * source_size) over () as more from fill)
  where more
), t as (
  select source, source_size, target, round_even(target, 0)::bigint as quota
  from fill where round = (select max(round) from fill)
), g as (
  select source, key, sum(size)::bigint as n, count(*) as c,
    (sum(sum(size)) over (partition by source order by key))::bigint as upto
  from d group by source, key
)
select d.doc_id, d.size, t.source_size, t.target,
  (case when t.source_size = 0 then 0 else
    t.quota // t.source_size * d.size
    + case when g.upto <= t.quota % t.source_size then d.size
        when g.upto - g.n < t.quota % t.source_size
          then least(d.size, (t.quota % t.source_size - g.upto + g.n) // g.c)
        else 0 end
  end)::bigint as taken
from d join t on d.source is not distinct from t.source
join g on d.source is not distinct from g.source and d.key = g.key
"""

_OP11 = r"""
with pieces as (
  select row_number() over () as piece, lang, words from (
    select coalesce(lang, 'und') as lang, unnest(list_transform(
      regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'),
      lambda p: regexp_extract_all(p, '[^\x20\x09]+'))) as words
    from documents)
  where len(words) > 0
), spots as (
  select lang, words, unnest(range(1, len(words) + 1)) as i from pieces
), total as (
  select lang, count(*)::bigint as n from spots group by lang
), f as (
  select lang, m, phrase, count(*)::bigint as a from (
    select lang, m, array_to_string(words[i:i + m - 1], ' ') as phrase
    from spots, (values (1), (2), (3)) t(m) where i + m - 1 <= len(words))
  group by lang, m, phrase having count(*) >= 10
), inner_ones as (
  select lang, phrase, max(a) as longer from (
    select lang, a, unnest([split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2),
      split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3)]) as phrase from f where m = 3)
  group by lang, phrase
), kept as (
  select f.* from f left join inner_ones i on f.lang = i.lang and f.phrase = i.phrase
  where f.m > 1 and (i.longer is null or 100 * i.longer < 50 * f.a)
), cuts as (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:m], ' ') as tail
  from (select *, string_split(phrase, ' ') as w, unnest(range(1, m)) as k from kept)
), s as (
  select c.lang, c.phrase, c.a, h.a as l, t.a as r, c.k,
    (1000000::hugeint * c.a * c.a // (h.a::hugeint * t.a))::bigint as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.head join f t on t.lang = c.lang and t.phrase = c.tail
), best as (
  select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1
), r as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best
)
select r.lang, r.rank::bigint as rank, r.phrase, r.a, r.l, r.r, total.n, r.score from r join total on total.lang = r.lang where r.rank <= 2000
"""

_OP12 = r"""
with u as (
  select page_id, coalesce(url, '') as url, instr(coalesce(url, ''), '://') as spot from pages
), rest as (
  select page_id, url, spot, case when spot > 0 then substr(url, spot + 3) else '' end as rest from u
), p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, url, spot, rest from rest
), rows_ as (
  select page_id, host, path, case when spot > 0 then host || substr(rest, length(host) + 1) else url end as text,
    case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
      when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from p
), ruled as (
  select *, case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block' end as verdict from rows_
), texts as (
  select distinct md5(text) as key, verdict, text from ruled
), g as (
  select key, verdict, length(text) + 1 as n,
    unnest(list_transform(range(1, length(text) + 2), lambda i: substr(repeat(chr(2), 5) || text || chr(3), i, 6))) as gram
  from texts
), suffixes as (
  select right(gram, n) as s, count(*) filter (verdict = 'allow') as a, count(*) filter (verdict = 'block') as r
  from (select verdict, gram from g where verdict is not null and key >= '4'), (values (1), (2), (3), (4), (5), (6)) t(n)
  group by 1
), ctx as (
  select left(s, length(s) - 1) as c, sum(a) as na, count(*) filter (a > 0) as ua, sum(r) as nr, count(*) filter (r > 0) as ur from suffixes group by 1
), targets as (
  select distinct gram from g where verdict is null or key < '4'
), seen as (
  select gram, n, coalesce(a, 0)::double as a, coalesce(na, 0)::double as na, coalesce(ua, 0)::double as ua,
    coalesce(r, 0)::double as r, coalesce(nr, 0)::double as nr, coalesce(ur, 0)::double as ur
  from (select gram, n, right(gram, n) as s, left(right(gram, n), n - 1) as c from targets, (values (1), (2), (3), (4), (5), (6)) t(n)) x
  left join suffixes using (s) left join ctx using (c)
), steps as (
  select gram, list({'a': a, 'na': na, 'ua': ua, 'r': r, 'nr': nr, 'ur': ur} order by n) as z from seen group by gram
), terms as (
  select gram, floor(1000000 * (
    ln(list_reduce(list_prepend(1.0::double / 256, list_transform(z, lambda x: 0.0::double)), lambda p, q, i:
      case when z[i - 1].nr > 0 then (z[i - 1].r + z[i - 1].ur * p) / (z[i - 1].nr + z[i - 1].ur) else p end))
    - ln(list_reduce(list_prepend(1.0::double / 256, list_transform(z, lambda x: 0.0::double)), lambda p, q, i:
      case when z[i - 1].na > 0 then (z[i - 1].a + z[i - 1].ua * p) / (z[i - 1].na + z[i - 1].ua) else p end))) + 0.5)::bigint as term
  from steps
), cells as (
  select key, verdict, greatest(-2048, least(2048, floor((sum(term) * 64)::double / (n * 1000000)::double)::integer)) as cell
  from g join terms using (gram) where verdict is null or key < '4' group by key, verdict, n
), hist as (
  select cell, count(*) filter (verdict = 'allow') as a, count(*) filter (verdict = 'block') as r from cells where verdict is not null group by cell
), tried as (
  select distinct unnest([1, cell, cell + 1]) as c from hist
), cut as (
  select coalesce(max(c), 1) as c from (
    select c from (
      select c, (select sum(r) from hist where cell >= c) as rr, (select sum(a) from hist where cell < c) as aa,
        (select sum(a) from hist) as a, (select sum(r) from hist) as r from tried)
    where a > 0 and r > 0
    order by coalesce(rr, 0) * a + coalesce(aa, 0) * r desc, abs(2 * c - 1), c desc limit 1)
)
select page_id, host, path, rule, coalesce(r.verdict, case when cells.cell >= cut.c then 'block' else 'allow' end) as verdict
from ruled r cross join cut left join cells on r.verdict is null and cells.verdict is null and cells.key = md5(r.text)
"""


def llm_sql() -> dict[str, str]:
    """SQL by query name; queries without an entry are tested by brute force."""
    return {"op1_vp_tree_search": _OP1, "op8_min_cost_flow_mix": _OP8, "op9_norm_bucketed_top_k": _OP9, "op11_son_collocations": _OP11, "op12_markov_url_filter": _OP12}
