"""DuckDB SQL of the queries that SQL can express, over the same tables.

The constants are written out here on purpose: they state the contract again instead of
importing it.
"""

from __future__ import annotations

OP2 = r"""
with t as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] as l
    from documents
), pos as (
    select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from t where len(w) >= 3
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as times from pos
), covered as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from windows, (values (0), (1), (2)) as x(k) where times > 1 group by doc_id
), counts as (
    select t.doc_id, text, len(w)::bigint as n_words,
           coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
           coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from t left join covered on covered.doc_id = t.doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words
            or 4 * n_symbols > n_words
            or (n_lines >= 4 and 2 * n_dup_lines > n_lines)
            or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^A-Za-z]', '', 'g'))
            or 4 * len(regexp_extract_all(text, '[!?][!?]+')) > n_words) as kept
from counts
"""

OP4 = r"""
with d as (
    select doc_id, source, text, string_split(text, chr(10)) as l from documents
), pages as (
    select source, count(distinct coalesce(text, '')) as pages from d group by source
), lines as (
    select source, trim(line, ' ' || chr(9) || chr(13)) as line, count(distinct text) as n
    from (select source, text, unnest(l) as line from d)
    where regexp_matches(line, '[^ \t\r]') group by 1, 2
), boilerplate as (
    select source, list(line) as gone from lines join pages using (source)
    where n >= 5 and n > 0.05 * pages group by source
), kept as (
    select doc_id, text, l, gone,
           [x for x in l if not list_contains(coalesce(gone, []), trim(x, ' ' || chr(9) || chr(13)))] as stay
    from d left join boilerplate using (source)
)
select doc_id, coalesce(len(l), 0)::bigint as n_lines,
       coalesce(len(l) - len(stay), 0)::bigint as n_dropped,
       case when text is null or gone is null then text else array_to_string(stay, chr(10)) end as text
from kept
"""

OP9 = r"""
with items as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null
), windows as (
    select item_id, least(13, len(w)) as m, w[i : i + least(13, len(w)) - 1] as win
    from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from items where len(w) > 0)
), docs as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents
), sizes as (
    select distinct m from windows
), runs as (
    select doc_id, m, i, w[i : i + m - 1] as win
    from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from docs, sizes where len(w) >= m)
), found as (
    select doc_id, item_id, runs.m, i from runs join windows on runs.m = windows.m and runs.win = windows.win
), hits as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + m)) as p from found) group by doc_id
), who as (
    select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
    from found group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       (coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w)) as contaminated
from docs left join hits using (doc_id) left join who using (doc_id)
"""

OP10 = r"""
with p as (
    select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), f as (
    select *, min(page_id) over (partition by payload_digest) as first from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and first <> page_id then first end as refers_to
from f
"""

OP11 = r"""
with d as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents where text is not null
), totals as (
    select count(*)::hugeint as nn, sum(len(w))::hugeint as ll from d where len(w) > 0
), docs as (
    select row, doc_id, (100 - 25 + (25 * len(w)::hugeint * nn) // ll)::bigint as m from d, totals where len(w) > 0
), tf as (
    select row, term, count(*)::bigint as tf from (select row, unnest(w) as term from d) group by 1, 2
), df as (
    select term, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
    from tf, totals group by term, nn
), wanted as (
    select item_id, term, count(*)::bigint as times
    from (select item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
    group by 1, 2
), scores as (
    select item_id, docs.row, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
    from wanted join df using (term) join tf using (term) join docs on docs.row = tf.row group by 1, 2, 3
), ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scores where score > 0
)
select * from ranked where rank <= 20
"""

OP12 = r"""
with pieces as (
    select row_number() over () as piece, lang, text from (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as text
        from documents)
), words as (
    select lang, piece, unnest(w) as word, generate_subscripts(w, 1) as i
    from (select lang, piece, regexp_extract_all(text, '[^\x20\x09]+') as w from pieces)
), places as (
    select lang, word as w1, lead(word, 1) over p as w2, lead(word, 2) over p as w3, lead(word, 3) over p as w4
    from words window p as (partition by piece order by i)
), grams as (
    select lang, 1 as k, w1 as phrase from places
    union all select lang, 2, w1 || ' ' || w2 from places where w2 is not null
    union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from places where w3 is not null
    union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 from places where w4 is not null
), totals as (
    select lang, count(*)::bigint as n from grams where k = 1 group by lang
), f as (
    select lang, k, phrase, count(*)::bigint as f from grams group by 1, 2, 3 having count(*) >= 30
), candidates as (
    select lang, k as size, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1
), cuts as (
    select c.lang, c.phrase, c.size, a, x.k, one.f as l, two.f as r,
           ((2000000::hugeint * a) // (one.f::hugeint + two.f))::bigint as score
    from candidates as c join (values (1), (2), (3)) as x(k) on x.k < c.size
    join f as one on one.lang = c.lang and one.phrase = array_to_string(w[1 : x.k], ' ')
    join f as two on two.lang = c.lang and two.phrase = array_to_string(w[x.k + 1 : c.size], ' ')
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
    select lang, array_to_string(w[i : i + m - 1], ' ') as phrase, max(a) as longer
    from candidates, (values (2), (3)) as x(m), (values (1), (2), (3)) as y(i)
    where m < size and i + m - 1 <= size group by 1, 2
), kept as (
    select lowest.* from lowest left join longer using (lang, phrase)
    where longer is null or 100 * longer::hugeint < 80 * a::hugeint
), ranked as (
    select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, encode(phrase))::bigint as rank,
           phrase, a, l, r, n, score
    from kept join totals on totals.lang = kept.lang
)
select * from ranked where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": OP2,
        "op4_line_dedup": OP4,
        "op9_decontamination": OP9,
        "op10_legacy_archives": OP10,
        "op11_ranked_search": OP11,
        "op12_collocations": OP12,
    }
