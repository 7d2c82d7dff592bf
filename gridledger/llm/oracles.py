"""SQL for DuckDB that gives the rows of the queries in ``queries``."""

from __future__ import annotations

#: Words, word windows and lines of each document; the host verdict follows the same moments.
OP1 = r"""
with docs as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
listed as (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from docs),
words as (select r, unnest(words) as word, generate_subscripts(words, 1) as p from listed),
windows as (
  select r, p, word, lead(word, 1) over w as w2, lead(word, 2) over w as w3 from words window w as (partition by r order by p)),
repeated as (
  select r, p, count(*) over (partition by r, word, w2, w3) > 1 and w3 is not null as twice from windows),
covered as (
  select r, bool_or(twice) over (partition by r order by p rows between 2 preceding and current row) as hit from repeated),
repeats as (select r, count_if(hit) as n from covered group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from docs),
dups as (
  select r, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
measured as (
  select d.doc_id, d.source, cast(len(l.words) as bigint) as n_words,
    cast(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(dups.n, 0) as bigint) as n_dup_lines, cast(coalesce(repeats.n, 0) as bigint) as n_repeat_words
  from docs d join listed l using (r) left join dups using (r) left join repeats using (r)),
ruled as (
  select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2, 10 * n_symbols > word_chars as f3,
    2 * n_dup_lines > n_words as f4 from measured),
hosts as (
  select source, rule, count(*) as n, count_if(failed) as f
  from (select source, unnest([1, 2, 3, 4]) as rule, unnest([f1, f2, f3, f4]) as failed from ruled where source is not null)
  group by all),
moments as (
  select rule, sum(f) / sum(n) as m, sum(f * f / n) / sum(n) as sq, count(*) / sum(n) as share from hosts group by rule),
priors as (select rule, m, m * (1 - m) as noise, sq - m * m - m * (1 - m) * share as between_hosts from moments),
rates as (
  select source, case when noise = 0 or between_hosts <= noise * 1e-9 then m
    else (f + m * greatest(noise / between_hosts - 1, 0)) / (n + greatest(noise / between_hosts - 1, 0)) end as rate
  from hosts join priors using (rule)),
verdicts as (select source, max(rate) > 0.5 as rejected from rates group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 or f2 as base_failed,
  coalesce(rejected, false) as host_rejected, not (f1 or f2) and not coalesce(rejected, false) as kept
from ruled left join verdicts using (source)
"""

#: Equal texts by themselves, without a hash of them.
OP12 = r"""
with texts as (
  select doc_id, row_number() over () as r, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents),
placed as (
  select doc_id, norm, count(*) over (partition by norm) as group_size, min(doc_id) over (partition by norm) as keep_id,
    row_number() over (partition by norm order by doc_id nulls last, r) = 1 as kept from texts)
select doc_id, keep_id, group_size, kept, sha256(norm) as text_sha256 from placed
"""

#: Nodes as groups of equal prefixes; what lies under a node by the paths of the smallest members. The
#: first part is CRC-32 one bit after another.
OP11 = """
with recursive ids as (select distinct conv_id as c, cast(conv_id as varchar) as s from conversations where conv_id is not null),
crc(c, s, b, v) as (
  select c, s, 0, xor(cast(4294967295 as bigint), ascii(s[1])) from ids
  union all
  select c, s, b + 1, xor(case when v % 2 = 1 then xor(v >> 1, cast(3988292384 as bigint)) else v >> 1 end,
    case when (b + 1) % 8 = 0 and (b + 1) // 8 < length(s) then ascii(s[(b + 1) // 8 + 1]) else 0 end)
  from crc where b < 8 * length(s)),
taken as (
  select c, c - c % 5 as lender, xor(v, cast(4294967295 as bigint)) % 9 as h from crc where b = 8 * length(s)),
turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as nth
  from conversations where conv_id is not null),
rebuilt as (
  select t.c, 0 as own, x.nth, role, text from taken t join turns x on x.c = t.lender and x.nth <= t.h
  union all
  select t.c, 1, x.nth, role, text from taken t join turns x on x.c = t.c and x.nth > t.h),
marked as (
  select c, row_number() over w as d, strlen(text) as bytes,
    string_agg(md5(strlen(role) || ':' || role || ':' || text), ',') over w as k
  from rebuilt window w as (partition by c order by own, nth)),
paths as (select c, d, bytes, k from marked union all select c, 0, 0, '' from ids),
lengths as (select c, max(d) as len from paths group by c),
nodes as (
  select d, k, min(p.c) as c, count(*) as n, any_value(bytes) as bytes,
    coalesce(string_agg(cast(case when len = d then p.c end as varchar), ',' order by p.c), '') as ends
  from paths p join lengths l using (c) group by d, k),
linked as (
  select v.*, u.c as parent_c, u.k as parent_k from nodes v
  left join paths p on p.c = v.c and p.d = v.d - 1 left join nodes u on u.d = p.d and u.k = p.k),
children as (select parent_k as k, d - 1 as d, count(*) as children from linked where d > 0 group by all),
whole as (select l.*, coalesce(children, 0) as children from linked l left join children ch on ch.k = l.k and ch.d = l.d),
under as (
  select p.d, p.k, count_if(v.children = 0) as leaves, sum((v.n - 1) * v.bytes) as saved
  from whole v join paths p on p.c = v.c and p.d <= v.d group by p.d, p.k)
select w.c as conv_id, cast(w.d as bigint) as depth, parent_c as parent_conv_id, n as n_convs, children as n_children,
  cast(leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, sha256(ends) as ends_sha256
from whole w join under u on u.d = w.d and u.k = w.k
"""

#: Every anchor with every row.
OP13 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, b.label = a.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""


def build_oracles() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op11_prefix_trie": OP11, "op12_exact_dedup": OP12, "op13_hard_negatives": OP13}
