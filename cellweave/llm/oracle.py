"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
SPACED = r"'[^\x20\x09-\x0D]+'"
ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = """
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
        sha1(coalesce(html, '')) as payload_digest
    from pages
), w as (
    select *, max(page_id) over (partition by payload_digest) as last from p
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id < last then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id < last then last end as refers_to
from w
"""

OP3 = f"""
with recursive words as (
    select doc_id, regexp_extract_all({LOWER}, {SPACED}) as w from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as s
    from (select doc_id, w, unnest(range(0, greatest(len(w) - 4, least(len(w), 1)))) as i from words)
), sizes as (
    select doc_id, count(*) as n from shingles group by 1
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as k
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * k >= 80 * (x.n + y.n - k)
), ways as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id as a, doc_id as b from documents
    union
    select r.a, w.b from reach r join ways w on w.a = r.b
), least_id as (
    select a as doc_id, min(b) as component_id from reach group by 1
)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from least_id left join sizes using (doc_id)
"""

OP4 = f"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) as w from documents
), wins as (
    select doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) as h
    from (select doc_id, w, unnest(range(0, greatest(len(w) - 49, 0))) as i from words)
), again as (
    select doc_id, i from (select doc_id, i, min(doc_id) over (partition by h) as lowest from wins)
    where lowest < doc_id
), gone as (
    select distinct doc_id, p from (select doc_id, unnest(range(i, i + 50)) as p from again)
), every as (
    select doc_id, unnest(range(0, len(w))) as p, unnest(w) as word from words
), kept as (
    select e.doc_id, string_agg(word, ' ' order by p) as t, count(*) as n
    from every e anti join gone g on e.doc_id = g.doc_id and e.p = g.p group by 1
)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id)
"""

OP5 = f"""
with words as (
    select doc_id, regexp_extract_all({LOWER}, {ALPHANUMERIC}) as w from documents
), item_words as (
    select item_id, regexp_extract_all({LOWER}, {ALPHANUMERIC}) as w from benchmark
), item_windows as (
    select distinct item_id, k, array_to_string(w[i + 1 : i + k], ' ') as win
    from (
        select item_id, w, k, unnest(range(0, len(w) - k + 1)) as i
        from (select item_id, w, least(len(w), 10) as k from item_words where len(w) > 0)
    )
), doc_windows as (
    select doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') as win
    from (
        select doc_id, w, k, unnest(range(0, greatest(len(w) - k + 1, 0))) as i
        from words cross join (select distinct k from item_windows)
    )
), hits as (
    select doc_id, i, d.k, item_id from doc_windows d join item_windows using (k, win)
), covered as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + k)) as p from hits) group by 1
), listed as (
    select doc_id, list_sort(list(distinct item_id::varchar)) as items from hits group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(items), 0) as n_items,
    sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join listed using (doc_id)
"""

OP9 = """
with l as (
    select source, unnest(string_split(text, chr(10))) as line from documents
), shared as (
    select coalesce(list(line), []) as gone from (
        select trim(line, ' ') as line from l where trim(line, ' ') <> ''
        group by 1 having count(distinct source) >= 8
    )
), kept as (
    select doc_id, text, string_split(text, chr(10)) as every,
        list_filter(string_split(text, chr(10)), lambda x: not list_contains(gone, trim(x, ' '))) as kept
    from documents cross join shared
), cut as (
    select *, len(kept) < len(every) and len(list_filter(kept, lambda x: trim(x, ' ') <> '')) > 0 as goes from kept
)
select doc_id, coalesce(len(every), 0) as n_lines,
    case when goes then len(every) - len(kept) else 0 end as n_removed,
    sha256(coalesce(case when goes then array_to_string(kept, chr(10)) else text end, '')) as kept_sha256
from cut
"""

OP12 = f"""
with words as (
    select doc_id, regexp_extract_all({LOWER}, {ALPHANUMERIC}) as w from documents
), sizes as (
    select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from words
), item_terms as (
    select item_id, term, count(*) as repeats
    from (select item_id, unnest(regexp_extract_all({LOWER}, {ALPHANUMERIC})) as term from benchmark) group by 1, 2
), counts as (
    select doc_id, n, term, count(*) as tf
    from (select doc_id, len(w) as n, unnest(w) as term from words)
    where term in (select term from item_terms) group by 1, 2, 3
), weights as (
    select term, floor(1000 * ln((2.0::double * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as weight
    from counts cross join sizes group by 1
), parts as (
    select doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) as part
    from counts join weights using (term) cross join sizes
), scores as (
    select item_id, doc_id, sum(repeats * part)::bigint as score from item_terms join parts using (term) group by 1, 2
), ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""

ORACLE: dict[str, str] = {
    "op2_warc": OP2,
    "op3_jaccard_join": OP3,
    "op4_substring_dedup": OP4,
    "op9_line_dedup": OP9,
    "op5_decontamination": OP5,
    "op12_lexical_search": OP12,
}
