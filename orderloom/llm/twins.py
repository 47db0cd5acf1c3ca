"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
with texts as (select coalesce(lang, 'und') as lang, {LOWERED} as t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as p from texts),
worded as (select lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, sum(len(w)) as n from worded group by lang),
grams as (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded cross join (values (1), (2), (3)) as s(k))
),
counted as (select lang, k as words, phrase, count(*)::hugeint as f from grams group by all having count(*) >= 10),
cuts as (
    select lang, words, phrase, f as a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as lp, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as rp
    from (select *, unnest(range(1, words)) as k from counted where words > 1)
),
scored as (
    select c.*, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f * y.f) as score
    from cuts c join counted x on x.lang = c.lang and x.phrase = c.lp join counted y on y.lang = c.lang and y.phrase = c.rp
),
worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
held as (select lang, case when k = 1 then rp else lp end as phrase, max(a) as longer from cuts where words = 3 group by all),
ranked as (
    select w.*, row_number() over (partition by w.lang order by score desc, a desc, w.phrase) as rank
    from worst w left join held h on h.lang = w.lang and h.phrase = w.phrase where longer is null or 100 * longer < 50 * a
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

LEXICAL_SEARCH = f"""
with d as (
    select row_number() over () as doc, doc_id,
           regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
    from documents
),
lengths as (select doc, doc_id, len(w) as n from d where len(w) > 0),
whole as (select count(*) as big_n, sum(n)::bigint as big_l from lengths),
norms as (select doc, doc_id, 75 + (25 * n * big_n) // big_l as m from lengths, whole),
posting as (select doc, term, count(*) as tf from (select doc, unnest(w) as term from d) group by all),
item as (
    select row_number() over () as query, item_id,
           regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
    from (select distinct item_id, text from benchmark)
),
asked as (select query, term, count(*) as repeats from (select query, unnest(w) as term from item) group by all),
weight as (
    select term, floor(1000 * ln((2 * any_value(big_n) + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
    from posting, whole where term in (select term from asked) group by term
),
scored as (
    select query, doc, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
    from asked join weight using (term) join posting using (term) join norms using (doc) group by all
),
ranked as (
    select query, doc_id, score, row_number() over (partition by query order by score desc, doc_id) as rank
    from scored join norms using (doc) where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked join item using (query) where rank <= 20
"""

#: Whatever reaches whatever by links (x, y) in both directions; for tables of test size.
_REACH = """
reach as (
    select {key} as x, {key} as y from {table}
    union
    select reach.x, links.y from reach join links on links.x = reach.y
)
"""

EMBEDDING_DEDUP = f"""
with recursive usable as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as x, b.vec_id as y
    from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98
),
{_REACH.format(key="vec_id", table="embeddings")},
counted as (select x, count(*) as n from links group by x)
select vec_id, coalesce(any_value(n), 0)::bigint as n_links, min(reach.y) as component_id, vec_id = min(reach.y) as kept
from embeddings join reach on reach.x = vec_id left join counted on counted.x = vec_id
group by vec_id
"""

_WORDS = "[^\\x20\\x09-\\x0D]+"

JACCARD_JOIN = f"""
with recursive worded as (select doc_id, regexp_extract_all({LOWERED}, '{_WORDS}') as w from documents),
shingles as (
    select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from worded where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as both_have
    from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
),
links as (
    select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * both_have >= 90 * (a.n + b.n - both_have)
),
{_REACH.format(key="doc_id", table="documents")}
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(reach.y) as component_id
from documents d join reach on reach.x = d.doc_id left join sizes on sizes.doc_id = d.doc_id group by d.doc_id
"""

_BUCKET = "case when v < 1024 then v else (v >> (length(bin(v)) - 10)) << (length(bin(v)) - 10) end"
#: Measures as whole numbers, what their spread counts as at least, and whether they have a lower bound.
_MEASURES = (
    ("symbol_share", "1000 * n_symbols // greatest(word_chars, 1)", 20, False),
    ("dup_line_share", "1000 * n_dup_lines // greatest(n_lines, 1)", 150, False),
    ("word_length", "100 * word_chars // greatest(n_words, 1)", 150, True),
)


def _fences(by: str) -> str:
    return f"""
    select {by}, measure, q1 - 3 * greatest(q3 - q1, least) as low, q3 + 3 * greatest(q3 - q1, least) as high
    from (
        select {by}, measure, any_value(least) as least, min(bucket) filter (4 * upto >= everything) as q1, min(bucket) filter (4 * upto >= 3 * everything) as q3
        from (
            select {by}, measure, least, bucket, sum(count(*)) over (partition by {by}, measure order by bucket) as upto,
                   sum(count(*)) over (partition by {by}, measure) as everything
            from buckets group by {by}, measure, least, bucket
        ) group by {by}, measure
    )"""


QUALITY_RULES = f"""
with texts as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
worded as (select *, regexp_extract_all(t, '{_WORDS}') as w from texts),
windows as (select r, i, array_to_string(w[i:i + 4], ' ') as s from (select r, w, unnest(range(1, len(w) - 3)) as i from worded where len(w) >= 5)),
twice as (select r, i from windows qualify count(*) over (partition by r, s) > 1),
repeated as (select r, count(distinct i + k) as n from twice cross join range(0, 5) as s(k) group by r),
lines as (select r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) as l from texts),
measured as (
    select r, doc_id, lang, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
           coalesce(n, 0) as n_repeat_words
    from worded join lines using (r) left join repeated using (r)
),
judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured),
valued as (
    {" union all ".join(f"select r, doc_id, lang, source, base_failed, '{m}' as measure, {least} as least, {lower} as lower, ({value})::bigint as v from judged" for m, value, least, lower in _MEASURES)}
),
buckets as (select *, {_BUCKET} as bucket from valued where not base_failed),
own as ({_fences("lang, source")}),
wider as ({_fences("lang")}),
outside as (
    select distinct r from valued x
    join own o on o.lang is not distinct from x.lang and o.source is not distinct from x.source and o.measure = x.measure
    join wider a on a.lang is not distinct from x.lang and a.measure = x.measure
    where v > greatest(o.high, a.high) or (x.lower and v < least(o.low, a.low))
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words, base_failed, not base_failed and r not in (select r from outside) as kept
from judged
"""
