"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {
    "op3_exact_dedup": """
        with d as (select doc_id, coalesce(text, '') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
            doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from d
    """,
    "op7_warc": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
        ), f as (select *, min(page_id) over (partition by payload_digest) as first from p)
        select page_id, payload_bytes, payload_digest,
            case when payload_bytes >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 100 and first <> page_id then first end as refers_to
        from f
    """,
    "op11_filter_audit": r"""
        with recursive d as (
            select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
            from documents
        ), flags as (
            select doc_id, coalesce(max(quality = 1), false) as good, coalesce(max(toxic = 1), false) as toxic from labels group by doc_id
        ), masked as (
            select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                (case when len(w) < 200 then 1 else 0 end)
                | (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
                | (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end)
                | (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
                | (case when d.doc_id > min(d.doc_id) over (partition by t) then 16 else 0 end) as mask
            from d left join flags on d.doc_id = flags.doc_id
        ), cells as (
            select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masked group by all
        ), letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as v(letter, bit)
        ), orders as (
            select '' as filter_order, 0 as applied
            union all
            select filter_order || letter, applied | bit from orders, letters where applied & bit = 0
        ), steps as (
            select filter_order, s.step, bit,
                (select coalesce(sum(l.bit), 0) from letters l where position(l.letter in filter_order) < s.step) as before
            from orders, range(1, 6) as s(step), letters
            where length(filter_order) = 5 and letter = substr(filter_order, s.step, 1)
        ), measured as (
            select part, filter_order, step::int as step, bit,
                coalesce(sum(n) filter (mask & (before | bit)::bigint = 0), 0)::bigint as kept,
                coalesce(sum(n) filter (mask & before::bigint = 0 and mask & bit <> 0), 0)::bigint as removed,
                coalesce(sum(n) filter (mask & before::bigint <> 0 and mask & bit <> 0), 0)::bigint as redundant,
                coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
                coalesce(sum(good) filter (mask & before::bigint = 0 and mask & bit <> 0), 0)::bigint as good_lost,
                coalesce(sum(toxic) filter (mask & before::bigint = 0 and mask & bit <> 0), 0)::bigint as toxic_lost
            from cells, steps group by all
        )
        select * exclude (bit), (sum(removed) over (partition by part, bit))::bigint as shapley from measured
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
