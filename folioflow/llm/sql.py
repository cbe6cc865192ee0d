"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

#: Lines that too many documents with different sets of lines hold at a host, then the documents without them.
ORACLE["op2_line_frequency"] = r"""
with docs as (
  select row_number() over () as row, doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents
), words as (
  select row, doc_id, host, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from docs
), windows as (
  select row, unnest(range(1, len(w) - 6)) as p, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as shingle
  from words where len(w) >= 8
), again as (
  select row, p from (select row, p, count(*) over (partition by row, shingle) as n from windows) where n > 1
), covered as (
  select row, sum(least(8, coalesce(p - before, 8)))::bigint as n_repeat_words
  from (select row, p, lag(p) over (partition by row order by p) as before from again) group by row
), counts as (
  select row, doc_id, host, len(w)::bigint as n_words,
    coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines
  from words
), lines as (
  select row, host, md5(line)[1:16] as key, n from (
    select row, host,
      translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line,
      len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n
    from (select row, host, unnest(lines) as line from words))
), sets as (
  select row, host, unnest(keys) as key, array_to_string(keys, ' ') as document
  from (select row, host, list_sort(list_distinct(list(key))) as keys from lines group by row, host)
), frequent as (
  select host, key from sets group by host, key having count(distinct document) > 20
), removed as (
  select row, sum(n)::bigint as n_removed from lines join frequent using (host, key) group by row
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from (
    select counts.*, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_removed, 0) as n_removed
    from counts left join covered using (row) left join removed using (row))
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * (n_words - n_removed) >= 30 * n_words as kept, n_removed
from judged
"""

#: Levels by filling the sources in the order of limit / weight, then down the Pareto order, document by document.
ORACLE["op4_pareto_mixture"] = r"""
with recursive docs as (
  select doc_id, source, coalesce(text, '') as text,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size
  from documents
), each as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from docs group by source
), limited as (
  select *, 2 * source_size as most, (2 * source_size)::double / weight as ratio from each
), levelled as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(most) over before, 0)::double)
    / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
  from limited window before as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)
), level as (
  select max(level) as level from levelled where ratio > level
), targets as (
  select source, source_size,
    case when l.level is null or ratio <= l.level then most::double else l.level * weight end as target
  from limited cross join level l
), rated as (
  select *, case when source_size > 0 then target / source_size::double else 0.0::double end as rate from targets
), rates as (
  select *, floor(rate)::bigint as whole, rate - floor(rate) as part,
    target - (floor(rate)::bigint * source_size)::double as rest from rated
), drawn as (
  select d.doc_id, d.source, size, source_size, target, whole, part, rest,
    md5(text) as t,
    (('0x' || substr(md5('11:' || coalesce(doc_id::varchar, '') || ':' || md5(text)), 1, 12))::bigint::double + 0.5) / 281474976710656::double as u
  from docs d join rates r on d.source is not distinct from r.source
), ranked as (
  select *, case when part > 0 then o / (1 + o) end as z
  from (select *, case when part > 0 then (u / (1 - u)) / (part / (1 - part)) end as o from drawn)
), ranks as materialized (
  select source, o, sum(size)::bigint as words, row_number() over (partition by source order by o) as place
  from (select source, size, row(z, coalesce(doc_id, -1), t) as o from ranked where part > 0) group by source, o
), walked as (
  select source, 0::bigint as place, rest as gap, false as fits from rates where part > 0
  union all
  select w.source, r.place, case when r.words <= w.gap then w.gap - r.words else w.gap end, r.words <= w.gap
  from walked w join ranks r on r.source is not distinct from w.source and r.place = w.place + 1
), ends as (
  select source, min(gap) as gap from walked group by source
), judged as (
  select r.*, w.fits, e.gap from ranks r
  join walked w on r.source is not distinct from w.source and r.place = w.place
  join ends e on r.source is not distinct from e.source
), closing as (
  select source, min(row(abs(words - gap), o)) as c from judged where not fits and abs(words - gap) < gap group by source
), chosen as (
  select j.source, j.o from judged j left join closing c on j.source is not distinct from c.source
  where j.fits or coalesce(j.o = struct_extract_at(c.c, 2), false)
)
select doc_id, size, source_size, target, size * (whole + (c.o is not null)::int)::bigint as taken
from ranked r left join chosen c on r.source is not distinct from c.source and row(z, coalesce(doc_id, -1), t) = c.o
"""

#: Parts of 64 turns, each rendered once for every speaker.
ORACLE["op9_perspective_rotation"] = r"""
with rows as (
  select conv_id, role, coalesce(replace(text, '<|', '< |'), '') as said,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as place
  from conversations
), speakers as (
  select distinct conv_id, role as speaker from rows where role is not null and role not in ('', 'system')
), rendered as (
  select r.conv_id, speaker, (place // 64)::integer as part, place, coalesce(role = speaker, false) as own,
    case when role = speaker then '<|assistant|>' || chr(10)
      when role = 'system' then '<|system|>' || chr(10)
      when role is null or role = '' then '<|user|>' || chr(10)
      else '<|user name=' || replace(role, '<|', '< |') || '|>' || chr(10) end as head,
    said || '<|end|>' as body
  from rows r join speakers s on r.conv_id is not distinct from s.conv_id
), placed as (
  select *, sum(length(head) + length(body) + 1) over (partition by conv_id, speaker, part order by place) - length(body) - 1 as start
  from rendered
)
select conv_id, speaker, part, count(*)::integer as n_turns,
  string_agg(head || body || chr(10), '' order by place) as text,
  coalesce(string_agg(start::bigint || ':' || (start + length(body))::bigint, ',' order by place) filter (where own), '') as mask,
  coalesce(sum(length(body)) filter (where own), 0)::integer as trained_chars
from placed group by conv_id, speaker, part
"""
