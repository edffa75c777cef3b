"""SQL for DuckDB that gives the rows of queries of this subpackage, by other means than theirs."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: One window over all copies in the order of their finish times.
MIX = rf"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), {_SPACED})) as bigint) as size,
         cast('0x' || substring(md5(coalesce(cast(doc_id as varchar), '') || chr(10) || coalesce(source, '') || chr(10) || md5(coalesce(text, ''))), 1, 15) as bigint) as k
  from documents
), sources as (
  select source, sum(size) as source_size, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w
  from sized group by source
), caps as (
  select *, 3 * source_size / w as cap, sum(source_size) over () as total from sources
), leveled as (
  select *, (total - 3 * (sum(source_size) over upto - source_size)) / (sum(w) over () - sum(w) over upto + w) as level
  from caps window upto as (order by cap, source nulls last rows unbounded preceding)
), targets as (
  select source, source_size, coalesce(least(3 * source_size::double, (select arg_min(level, cap) from leveled where level <= cap) * w), 0.0) as target, total from leveled
), placed as (
  select s.*, t.source_size, t.target, t.total, sum(s.size) over (partition by s.source order by k, doc_id rows unbounded preceding) as upto
  from sized s join targets t on s.source is not distinct from t.source
), copies as (
  select doc_id, k, copy, size, total, (source_size * copy + upto)::double / target as finish from placed, (values (0), (1), (2)) c(copy) where target > 0 and size > 0
), ordered as (
  select *, sum(size) over (order by finish, k, doc_id, copy rows unbounded preceding) as used from copies
), chosen as (select doc_id, k, count(*) as n from ordered where used <= total group by doc_id, k)
select p.doc_id, p.size, cast(p.source_size as bigint) as source_size, p.target, cast(p.size * coalesce(c.n, 0) as bigint) as taken, cast(coalesce(c.n, 0) as integer) as copies
from placed p left join chosen c on p.doc_id is not distinct from c.doc_id and p.k = c.k
"""

DECONTAMINATE = rf"""
with items as (
  select distinct coalesce(cast(item_id as varchar), '') as item, regexp_extract_all({_LOWER}, {_ALNUM}) as w from benchmark
), windows as (
  select distinct item, least(13, len(w)) as k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as t
  from items, unnest(range(1, len(w) - least(13, len(w)) + 2)) u(i) where len(w) > 0
), docs as (
  select doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from documents
), places as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as t
  from docs, (select distinct k from windows) ks, unnest(range(1, len(w) - k + 2)) u(i)
), hits as (
  select doc_id, i, p.k, item from places p join windows v on p.k = v.k and p.t = v.t
), hit as (
  select doc_id, count(distinct x) as n_hit from (select distinct doc_id, i, k from hits), unnest(range(i, i + k)) u(x) group by doc_id
), named as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated, coalesce(items, '') as items
from docs left join hit using (doc_id) left join named using (doc_id)
"""

JACCARD = rf"""
with recursive words as materialized (
  select doc_id, regexp_extract_all({_LOWER}, {_SPACED}) as w from documents
), shingles as materialized (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from words, unnest(range(1, greatest(2, len(w) - 2))) u(i) where len(w) > 0
), sizes as materialized (
  select doc_id, count(*) as n from shingles group by doc_id
), links as materialized (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach as (
  select doc_id as x, doc_id as y from words union select r.x, l.y from reach r join links l on l.x = r.y
)
select doc_id, coalesce(n, 0) as n_shingles, (select min(y) from reach where x = doc_id) as component_id from words left join sizes using (doc_id)
"""

#: What of op2's rows doesn't depend on the fitted model.
QUALITY_BASE = rf"""
with words as materialized (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents
), windows as materialized (
  select doc_id, i, array_to_string(w[i:i + 2], ' ') as t from words, unnest(range(1, greatest(1, len(w) - 1))) u(i)
), again as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, t) > 1
), repeats as (
  select doc_id, count(distinct i + j) as n from again, (values (0), (1), (2)) v(j) group by doc_id
), lines as (
  select doc_id, count(*) - count(distinct line) as n from words, unnest(string_split(text, chr(10))) u(line) where regexp_matches(line, {_SPACED}) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
       cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, coalesce(l.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
       len(w) < 50 or 100 * coalesce(r.n, 0) > 50 * len(w) as base_failed
from words left join lines l using (doc_id) left join repeats r using (doc_id)
"""

#: What of op10's rows doesn't depend on the automaton.
LICENCE_BASE = rf"""
with words as materialized (
  select doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from documents
), phrases as (
  select string_split(p, ' ') as p, label from (values ('under the mit license', 'mit'), ('apache license version 2', 'apache-2'), ('cc by nc', 'cc-by-nc')) v(p, label)
), places as (
  select doc_id, i - 1 as place, label from words, phrases, unnest(range(1, greatest(1, len(w) - len(p) + 2))) u(i) where w[i:i + len(p) - 1] = p
), per as (
  select doc_id, count(*) as n, min(place) as first_at, max(place) as last_at, string_agg(distinct label, ',' order by label) as labels from places group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, first_at as first_word, last_at as last_word, coalesce(labels, '') as base_labels from words left join per using (doc_id)
"""

def crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text of characters up to U+00FF, bit by bit over its UTF-8 bytes."""
    utf8 = f"flatten(list_transform(string_split({text}, ''), lambda ch: case when ord(ch) < 128 then [ord(ch)::bigint] else [(192 + ord(ch) // 64)::bigint, (128 + ord(ch) % 64)::bigint] end))"
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {utf8}), lambda c, b: {byte}), 4294967295::bigint)"


_ROW_SHA = "sha256(coalesce({0}.text, '~') || chr(10) || coalesce({0}.lang, '~') || chr(10) || coalesce({0}.source, '~'))"
_CHANGED = "concat_ws(',', case when e.text is distinct from l.text then 'text' end, case when e.lang is distinct from l.lang then 'lang' end, case when e.source is distinct from l.source then 'source' end)"

#: Row numbers per text, and full joins.
SNAPSHOTS = rf"""
with turned as (
  select *, {crc32("cast(doc_id as varchar)")} % 16 as turn from documents
), later as (
  select unnest(case when turn = 0 then [] when turn in (3, 4) then [-1 - doc_id] when turn = 5 then [doc_id, -1 - doc_id] else [doc_id] end) as doc_id,
         case when turn = 1 then coalesce(text, '') || '+' else text end as text, case when turn = 2 then source else lang end as lang,
         case when turn = 4 then null when turn = 2 then lang else source end as source
  from turned
), kept as (
  select l.doc_id as key, e.doc_id as old_key, {_CHANGED} as changed, {_ROW_SHA.format('l')} as row_sha256 from documents e join later l on e.doc_id = l.doc_id
), gone as (
  select *, row_number() over (partition by text order by doc_id) as i from documents where doc_id not in (select key from kept)
), come as (
  select *, row_number() over (partition by text order by doc_id) as i from later where doc_id not in (select key from kept)
)
select key, old_key, case when changed = '' then 'same' else 'update' end as op, changed, row_sha256 from kept
union all
select coalesce(l.doc_id, e.doc_id), e.doc_id, case when e.doc_id is null then 'insert' when l.doc_id is null then 'delete' else 'rekey' end,
       case when e.doc_id is null or l.doc_id is null then '' else {_CHANGED} end, case when l.doc_id is not null then {_ROW_SHA.format('l')} end
from gone e full join come l on e.text is not distinct from l.text and e.i = l.i
"""

#: Near words by the text without one place, at the same place or as a whole word.
SPELLING = rf"""
with recursive runs as (
  select coalesce(cast(doc_id as varchar), '') as id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents) where length(run) >= 7
), hashed as (
  select w, {crc32("id || ':' || w")} as h from runs
), each as (
  select case when h % 31 = 0 then w[1:h % length(w)] || w[h % length(w) + 2:] else w end as word from hashed
), words as materialized (
  select word, count(*) as n from each where length(word) >= 7 group by word having count(*) >= 2
), cut as materialized (
  select word, n, i, word[1:i - 1] || word[i + 1:] as rest from words, unnest(range(1, length(word) + 1)) u(i)
), pairs as (
  select a.word, a.n, b.word as other, b.n as m from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
  union
  select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word
), best as (
  select word, count(*) as n_near, arg_min(other, (-m, other)) as other, max(m) as m from pairs group by word
), formed as materialized (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * n then other end as form, case when m >= 10 * n then m end as form_n from words w left join best using (word)
), steps as (
  select word, word as here, 0 as step from formed
  union all
  select s.word, f.form, step + 1 from steps s join formed f on s.here = f.word where f.form is not null
)
select f.*, r.root from formed f join (select word, arg_max(here, step) as root from steps group by word) r using (word)
"""

LIKELIHOOD_BASE = rf"""
with docs as (
  select row_number() over () as row, doc_id, {crc32("cast(doc_id as varchar)")} % 5 = 1 as held_out, list_append(regexp_extract_all({_LOWER}, {_SPACED}), null) as w from documents
), tokens as (
  select row, held_out, unnest(w) as token from docs
), counts as (
  select token, count(*) as c from tokens where not held_out group by token
), totals as (
  select coalesce(sum(c), 0) as n, count(*) as v from counts
), per as (
  select row, count(*) as n_tokens, count(c) as n_known, sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))) as base
  from totals, tokens t left join counts c on t.token is not distinct from c.token group by row
)
select doc_id, held_out, n_tokens, n_known, cast(n as bigint) as train_tokens, round(base, 6) as base_score from docs join per using (row), totals
"""

ORACLES = {
    "base_of_op12_lattice_likelihood": LIKELIHOOD_BASE,
    "op11_snapshot_diff": SNAPSHOTS,
    "op13_spelling_variants": SPELLING,
    "op4_mix_sources": MIX,
    "op6_decontaminate": DECONTAMINATE,
    "op8_ngram_jaccard": JACCARD,
    "base_of_op2_quality_rules": QUALITY_BASE,
    "base_of_op10_licence_scan": LICENCE_BASE,
}
