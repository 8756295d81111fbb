"""SQL for the queries that have it."""

from __future__ import annotations

from tidewell.llm.secrets import RULES

#: Patterns with the same matches, without look-behind and possessive counts, which the SQL engine doesn't have.
_PLAIN = {"pem": "-----BEGIN (?:[A-Z0-9 ]* )?PRIVATE KEY-----", "urlauth": r"[a-z][a-z0-9+.-]+://[^\s/:@]+:[^\s/:@]{3,}@"}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5_SQL = f"""
with i as (
    select item_id::varchar as item_id, {_WORDS} as words from benchmark
), w as (
    select distinct item_id, least(len(words), 13) as n, array_to_string(list_slice(words, k, k + least(len(words), 13) - 1), ' ') as own
    from (select *, unnest(range(1, greatest(2, len(words) - 11))) as k from i where len(words) > 0)
), d as (
    select doc_id, {_WORDS} as words from documents
), s as (
    select doc_id, n, k, array_to_string(list_slice(words, k, k + n - 1), ' ') as own
    from (select *, unnest(range(1, len(words) - n + 2)) as k from d, (select distinct n from w) where len(words) >= n)
), m as (
    select s.doc_id, s.k, s.n, w.item_id from s join w on s.own = w.own and s.n = w.n
), h as (
    select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(k, k + n)) as place from m) group by doc_id
), t as (
    select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from m group by doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.words) as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""

OP6_SQL = r"""
with p as (
    select page_id, coalesce(html, '') as html, regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare from pages
), d as (
    select *, strlen(html) as n, sha256(html) as digest,
        regexp_replace(lower(regexp_extract(bare, '^(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www[0-9]*\.', '') as host,
        regexp_extract(bare, '^[^/?#]*([^#]*)', 1) as path
    from p
), f as (
    select *, case when n >= 100 then min(page_id) over (partition by digest) end as first from d
)
select page_id, n as payload_bytes, digest as payload_digest,
    case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
    case when first <> page_id then first end as refers_to,
    array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || case when path = '' then '/' else path end as urlkey,
    1704067200 + page_id % 31536000 as captured
from f
"""


def _matches(place: int) -> str:
    rule = RULES[place]
    pattern = _PLAIN.get(rule.kind, rule.pattern).replace("'", "''")
    return f"""
    select doc_id, {place} as rule, '{rule.kind}' as kind, {rule.base} as base, {rule.least} as least, unnest(range(len(whole))) as k,
        unnest(whole) as whole, unnest(own) as own, unnest(list_slice(gaps, 1, len(whole))) as gap
    from (select doc_id, regexp_extract_all(text, '{pattern}', 0) as whole, regexp_extract_all(text, '{pattern}', {rule.group}) as own,
        string_split_regex(text, '{pattern}') as gaps from documents where regexp_matches(text, '{pattern}'))"""


_NAMED = "kind || ':' || start || ':' || stop"

OP7_SQL = f"""
with m as ({" union all ".join(map(_matches, range(len(RULES))))}
), p as (
    select *, sum(length(gap) + length(whole)) over (partition by doc_id, rule order by k) as stop from m
), s as (
    select *, stop - length(whole) as start from p where length(own) >= least
), g as (
    select doc_id, {", ".join(f"count(*) filter (rule = {k}) as n_{r.kind}" for k, r in enumerate(RULES) if r.base)},
        string_agg({_NAMED}, ',' order by start, rule) filter (base) as base, string_agg({_NAMED}, ',' order by start, rule) as spans
    from s group by doc_id
)
select d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in RULES if r.base)},
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join g using (doc_id)
"""
