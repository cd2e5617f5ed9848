"""DuckDB SQL for the registered queries, in the plainest form: joins, windows, no shortcuts.

Floating-point results are rounded alike on both sides.
"""

from __future__ import annotations

from pageflow.functions.fixed_values import (
    BOX_FEATURES,
    ENTITY_KEYS,
    LANGUAGES,
    NAMESPACES,
    PROJECT_SUFFIXES,
    SPECIAL_DOMAINS,
)
from pageflow.plans.fixtures import LANGUAGES as CHOSEN
from pageflow.plans.fixtures import LATE_DAY, TEST, TRAIN, Windows


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


KEYS = ", ".join(ENTITY_KEYS)

PV = """pv as (
  select
    case when event_id % 101 = 0 then null else
      case user_id % 9 when 0 then 'en' when 1 then 'it' when 2 then 'fr' when 3 then 'de' when 4 then 'es'
                       when 5 then 'it' when 6 then 'commons' when 7 then 'xx' else 'en' end
      || case event_type when 'view' then '' when 'click' then '.m' when 'purchase' then '.b' when 'signup' then '.m.voy'
         else case user_id % 7 when 0 then '.q' when 1 then '.n' when 2 then '.s' when 3 then '.v' when 4 then '.d'
                               when 5 then '.w' else case when user_id % 2 = 0 then '.wd' else '.f' end end end
    end as domain_code,
    case when event_id % 97 = 0 then '-' when event_id % 103 = 0 then null else
      case user_id % 8 when 1 then 'Special:' when 2 then 'Talk:' when 3 then 'User talk:' when 4 then 'User_talk:'
                       when 5 then 'Star_Trek:_' when 6 then 'File:A:' else '' end
      || 'P' || cast(user_id as varchar) || '_'
      || cast(cast(json_extract(props, '$.k') as bigint) % (1 + user_id % 6) as varchar) end as page_title,
    case when event_id % 89 = 0 then cast(-1 as bigint) else cast(floor(value) as bigint) end as count_views,
    cast(floor(value * 100) as bigint) as total_response_size,
    cast(ts as date) as file_date, strftime(ts, '%H:00:00') as file_time, ts as ingestion_time
  from events)"""

CHECKED = """checked as (
  select * from pv
  where count_views >= 0 and count_views <= 1000000000 and domain_code is not null
    and page_title is not null and page_title <> '-')"""

LANG = "lang(code, language) as (values " + ", ".join(f"('{c}', '{n}')" for c, n in LANGUAGES.items()) + ")"

PROJECT_CASE = (
    "case "
    + " ".join(f"when list_contains(string_split(domain_code, '.'), '{s}') then '{p}'" for s, p in PROJECT_SUFFIXES.items())
    + " else 'wikipedia.org' end"
)
DOMAINED = f"""domained as (
  select checked.*, lang.language, {PROJECT_CASE} as database_name,
    list_contains(string_split(domain_code, '.'), 'm') as is_mobile
  from checked join lang on split_part(domain_code, '.', 1) = lang.code
  where split_part(domain_code, '.', 1) not in ({_quoted(SPECIAL_DOMAINS)}))"""

TITLED = f"""(
  select * from (
    select * exclude (page_title),
      case when strpos(page_title, ':') > 0 then substr(page_title, 1, strpos(page_title, ':') - 1)
           else 'Article' end as namespace,
      case when strpos(page_title, ':') > 0 then substr(page_title, strpos(page_title, ':') + 1)
           else page_title end as page_title
    from %s)
  where namespace in ({_quoted(NAMESPACES)}))"""

SILVER = f"{PV}, {CHECKED}, {LANG}, {DOMAINED}, silver as {TITLED % 'domained'}"

SILVER_LIST = "domain_code, page_title, count_views, file_date, file_time, language, database_name, is_mobile, namespace"


def _r(expression: str, digits: int = 9) -> str:
    return f"round({expression}, {digits}) + 0.0"


def _between(first, last) -> str:
    return f"file_date between date '{first}' and date '{last}'"


def _daily(windows: Windows | None = None, name: str = "daily", source: str = "silver") -> str:
    days = "" if windows is None else f"where {_between(windows.obs_start, windows.obs_end)}"
    return f"""{name} as (
  select file_date, cast(dayofweek(file_date) + 1 as integer) as dow, {KEYS}, cast(sum(count_views) as bigint) as views_day
  from {source} {days} group by all)"""


def _rolled(name: str = "rolled", daily: str = "daily") -> str:
    frames = ", ".join(
        f"cast(sum(views_day) over (partition by {KEYS} order by file_date rows between {n - 1} preceding and current row)"
        f" as bigint) as sum_{n}d"
        for n in (3, 7)
    )
    return f"{name} as (select *, {frames} from {daily})"


CORE = """count(distinct file_date) as days_active, cast(sum(views_day) as bigint) as views_total,
    avg(views_day) as views_mean, stddev_pop(views_day) as views_std,
    count(distinct dow) as unique_weekdays, stddev_pop(views_day) as views_std_dow"""

LEVEL = """case when days_active <= 2 then 'very_sparse' when days_active <= 5 then 'sparse'
         when days_active <= 8 then 'medium' else 'frequent' end"""


def _full(obs_start) -> str:
    return f"""{CORE}, max(views_day) as views_max, quantile_disc(views_day, 0.5) as views_median,
    case when count(*) > 1 then regr_slope(views_day, date_diff('day', date '{obs_start}', file_date)) end as trend_slope,
    arg_min(dow, file_date) as first_dow"""


def _labels(windows: Windows, name: str = "labels", source: str = "silver") -> str:
    return f"""{name} as (
  select {KEYS}, cast(case when alive.page_title is null then 1 else 0 end as integer) as churn
  from (select distinct {KEYS} from {source} where {_between(windows.obs_start, windows.obs_end)}) seen
  left join (select distinct {KEYS} from {source} where {_between(windows.lbl_start, windows.lbl_end)}) alive using ({KEYS}))"""


def _entropy(keys: str, name: str, where: str = "true") -> str:
    """n_domains, views_entropy, views_entropy_norm per key, from shares by a join."""
    return f"""{name}_parts as (
  select {keys}, domain_code, cast(sum(count_views) as double) as v from silver where {where} group by all),
{name}_totals as (select {keys}, sum(v) as t, count(*) as n_domains from {name}_parts group by all),
{name} as (
  select {keys}, n_domains, coalesce(h, 0.0) as views_entropy,
    case when n_domains > 1 then coalesce(h, 0.0) / ln(n_domains) else 0.0 end as views_entropy_norm
  from {name}_totals left join (
    select {keys}, -sum((v / t) * ln(v / t)) as h
    from {name}_parts join {name}_totals using ({keys}) where v > 0 group by all) using ({keys}))"""


def _core_set(windows: Windows, tag: str = "", source: str = "silver") -> str:
    """CTEs ending in core{tag}: the churn set in join form."""
    return f"""{_daily(windows, 'daily' + tag, source)}, {_rolled('rolled' + tag, 'daily' + tag)},
{_labels(windows, 'labels' + tag, source)},
agg{tag} as (select {KEYS}, {CORE} from daily{tag} group by {KEYS}),
core{tag} as (
  select {KEYS}, days_active, views_total, views_mean, views_std, unique_weekdays, views_std_dow,
    coalesce(views_day, 0) as views_last_day, coalesce(sum_3d, 0) as sum_3d, {LEVEL} as sparsity_level, churn
  from agg{tag}
  left join (select * from rolled{tag} where file_date = date '{windows.obs_end}') last using ({KEYS})
  join labels{tag} using ({KEYS}))"""


CORE_OUT = f"""{KEYS}, days_active, views_total, {_r('views_mean')} as views_mean, {_r('views_std')} as views_std,
  unique_weekdays, {_r('views_std_dow')} as views_std_dow, views_last_day, sum_3d, sparsity_level, churn"""

OBS = _between(TRAIN.obs_start, TRAIN.obs_end)
FULL_SET = f"""{_daily(TRAIN)}, {_rolled()}, {_labels(TRAIN)}, {_entropy(KEYS, 'entropy', OBS)},
agg as (select {KEYS}, {_full(TRAIN.obs_start)} from daily group by {KEYS}),
newest as (
  select {KEYS}, domain_code from (
    select *, row_number() over (
      partition by {KEYS} order by file_date desc, file_time desc, domain_code desc) as rn
    from silver where {OBS}) where rn = 1),
full_set as (
  select {KEYS}, days_active, views_total, views_mean, views_std, unique_weekdays, views_std_dow,
    coalesce(views_day, 0) as views_last_day, coalesce(sum_3d, 0) as sum_3d, coalesce(sum_7d, 0) as sum_7d,
    views_max, views_median, trend_slope, first_dow, n_domains, views_entropy, views_entropy_norm,
    views_total = 0 as is_zero_history, days_active <= 2 as is_sparse, {LEVEL} as sparsity_level, churn, domain_code
  from agg
  left join (select * from rolled where file_date = date '{TRAIN.obs_end}') last using ({KEYS})
  left join entropy using ({KEYS})
  join labels using ({KEYS})
  left join newest using ({KEYS}))"""

PAGES = """pages_day as (
  select file_date as dt, language, database_name, page_title, cast(sum(count_views) as bigint) as views_page
  from silver group by all)"""
RANKED = f"""{PAGES}, ranked as (
  select *, row_number() over (partition by dt, language, database_name order by views_page desc, page_title) as rank
  from pages_day)"""

FILE_NAME = "'pageviews-' || strftime(file_date, '%Y%m%d') || '-' || replace(file_time, ':', '')"
NAMED_FILES = f"""named as (
  select case when count_views < 10 then 'projectviews-' || substr({FILE_NAME}, 11) else {FILE_NAME} end as source_file,
    file_date, file_time, count_views
  from pv)"""
BRONZE = "select domain_code, replace(page_title, ' ', '_') as page_title, count_views, total_response_size, file_date, file_time from pv"

HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["'']"""
LINKS = f"""links as (
  select page_id, url, replace(link, '&amp;', '&') as link
  from (select page_id, url, unnest(regexp_extract_all(html, '{HREF}', 1)) as link from pages)
  where link like '/%' and link like '%e')"""

SHARES = """shares as (
  select file_date, language, "DAU", "DAU_total", 100.0 * "DAU" / "DAU_total" as "DAU_pct"
  from (select file_date, language, count(distinct page_title) as "DAU" from silver group by all)
  join (
    select file_date, cast(sum(n) as bigint) as "DAU_total"
    from (select file_date, language, count(distinct page_title) as n from silver group by all) group by all)
  using (file_date))"""

ENTITY_TEXT = "concat_ws('|', language, database_name, cast(is_mobile as varchar), namespace, page_title, '%s')"
EVENT_TEXT = "concat_ws('|', domain_code, page_title, cast(file_date as varchar), file_time, '42')"

SCORED = """scored as (
  select churn as label, -cast(days_active as double) as score, case when days_active <= 2 then 1 else 0 end as prediction
  from core)"""
STEPS = """sizes as (select sum(label) as p, sum(1 - label) as n from scored),
steps as (
  select score, sum(label) as pos, sum(1 - label) as neg,
    sum(sum(label)) over (order by score desc) as tp, sum(sum(1 - label)) over (order by score desc) as fp
  from scored group by score)"""

GROUPED = """scored as (
  select churn as label, -cast(views_total as double) as score, unnest(['language', 'sparsity_level']) as grouped_by,
    unnest([language, sparsity_level]) as level
  from core),
sizes as (select grouped_by, level, sum(label) as p, sum(1 - label) as n from scored group by all),
steps as (
  select grouped_by, level, score, sum(label) as pos, sum(1 - label) as neg,
    sum(sum(label)) over (partition by grouped_by, level order by score desc) as tp,
    sum(sum(1 - label)) over (partition by grouped_by, level order by score desc) as fp
  from scored group by grouped_by, level, score)"""

RATES = f"""f as (
  select *, cast('0x' || substr(md5({ENTITY_TEXT % 42}), 1, 8) as bigint) as h from core),
split as (select *, h < round(0.2 * 4294967296) as is_test, h % 5 as fold from f),
per_fold as (select page_title, fold, count(*) as n, sum(churn) as s from split where not is_test group by all),
per_title as (select page_title, sum(n) as n, sum(s) as s from per_fold group by all),
of_fold as (select fold, sum(n) as n, sum(s) as s from per_fold group by all),
of_all as (select sum(n) as n, sum(s) as s from per_fold)"""

LATE = f"""base as (select * from silver where not (file_date = date '{LATE_DAY}' and file_time >= '18:00:00')),
late as (
  select * replace (count_views + 1 as count_views, ingestion_time + interval 1 day as ingestion_time)
  from silver where file_date = date '{LATE_DAY}' and file_time >= '12:00:00'),
both_parts as (select * from base where file_date = date '{LATE_DAY}' union all by name select * from late),
newest as (
  select * exclude (rn) from (
    select *, row_number() over (
      partition by page_title, domain_code, namespace, file_time
      order by ingestion_time desc, count_views desc) as rn from both_parts) where rn = 1)"""
LATE_DAYS = """base as (select * from silver where not (day(file_date) % 3 = 0 and file_time >= '18:00:00')),
late as (
  select * replace (count_views + 1 as count_views, ingestion_time + interval 1 day as ingestion_time)
  from silver where day(file_date) % 3 = 0 and file_time >= '12:00:00'),
both_parts as (
  select * from base where day(file_date) % 3 = 0 and file_time >= '12:00:00' union all by name select * from late),
newest as (
  select * exclude (rn) from (
    select *, row_number() over (
      partition by file_date, page_title, domain_code, namespace, file_time
      order by ingestion_time desc, count_views desc) as rn from both_parts) where rn = 1)"""
STAMP = "strftime(ingestion_time, '%Y-%m-%d %H:%M:%S') as ingestion_time"

BOX = f"""long as (
  select churn, feature, value from (
    unpivot (select churn, {', '.join(f'cast({f} as double) as {f}' for f in BOX_FEATURES)} from full_set)
    on {', '.join(BOX_FEATURES)} into name feature value value)
  where value is not null),
quarts as (
  select feature, churn, count(*) as n_values, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
    quantile_cont(value, 0.75) as q3
  from long group by all)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "bronze_ingest": f"with {PV} {BRONZE}",
        "bronze_parse_lines": f"with {PV} {BRONZE}",
        "ledger_ingest": f"with {PV} {BRONZE}",
        "bronze_file_filter": f"""with {PV}, {NAMED_FILES}
            select source_file, count(*) as n_rows from named where source_file like 'pageviews-%' group by all""",
        "bronze_file_timestamp": f"""with {PV}, {NAMED_FILES}
            select file_date, file_time, count(*) as n_rows, cast(sum(count_views) as bigint) as views
            from named where source_file like 'pageviews-%' group by all""",
        "table_roundtrip": f"with {SILVER} select {SILVER_LIST} from silver",
        "max_records_per_file": f"""with {SILVER} select count(*) as n_rows, true as within_limit from silver""",
        "gold_partitioned_roundtrip": f"with {SILVER}, {_core_set(TRAIN)} select {CORE_OUT} from core",
        "language_split": f"""with {SILVER}
            select {SILVER_LIST} from silver where language in ({_quoted(CHOSEN)})""",
        "link_harvest": f"with {LINKS} select page_id, url, link from links",
        "link_addresses": f"""select page_id, link,
              case when link like '/%' then regexp_extract(url, '^[a-z]+://[^/]+') || link else link end as address
            from (select page_id, url, replace(unnest(regexp_extract_all(html, '{HREF}', 1)), '&amp;', '&') as link from pages)""",
        "pending_files": f"""with {LINKS}
            select distinct link from links where link not in (select link from links where url like '%/en/%')""",
        "landing_inventory": f"""with {PV}
            select count(distinct (file_date, file_time)) as n_files, true as has_bytes from pv""",
        "set_row_counts": f"""with {SILVER}, {_labels(TRAIN)}, {_labels(TEST, 'test_labels')}
            select 'train' as set_name, count(*) as n_rows from labels
            union all select 'test', count(*) from test_labels""",
        "quality_checks": f"""with {PV}, {CHECKED}
            select domain_code, page_title, count_views, total_response_size, file_date, file_time from checked""",
        "quality_report": f"""with {PV}
            select count(*) as n_rows,
              count(*) filter (where count_views is null or count_views < 0 or count_views > 1000000000) as failed_views_in_range,
              count(*) filter (where domain_code is null) as failed_domain_present,
              count(*) filter (where page_title is null) as failed_title_present,
              count(*) filter (where page_title = '-') as failed_title_not_placeholder,
              count(*) filter (where count_views between 0 and 1000000000 and domain_code is not null
                and page_title is not null and page_title <> '-') as n_kept
            from pv""",
        "domain_special_filter": f"""with {PV}
            select domain_code, page_title, count_views from pv
            where domain_code is not null and not regexp_matches(domain_code, '^({'|'.join(SPECIAL_DOMAINS)})([.]|$)')""",
        "domain_language": f"""with {PV}, {LANG}
            select domain_code, language, count(*) as n_rows
            from pv join lang on split_part(domain_code, '.', 1) = code group by all""",
        "domain_language_map": f"""with {PV}, {LANG}
            select domain_code, language, count(*) as n_rows
            from pv join lang on split_part(domain_code, '.', 1) = code group by all""",
        "domain_project": f"""with {PV}, {CHECKED}, {LANG}, {DOMAINED}
            select domain_code, database_name, count(*) as n_rows from domained group by all""",
        "domain_mobile": f"""with {PV}, {CHECKED}, {LANG}, {DOMAINED}
            select domain_code, is_mobile, count(*) as n_rows from domained group by all""",
        "title_namespace": f"""with {PV}, {CHECKED}, titled as {TITLED % 'checked'}
            select namespace, page_title, count(*) as n_rows, cast(sum(count_views) as bigint) as views from titled group by all""",
        "silver_pipeline": f"with {SILVER} select {SILVER_LIST} from silver",
        "obs_lbl_windows": f"""with {SILVER}
            select 'observation' as window_name, count(*) as n_rows, cast(sum(count_views) as bigint) as views
            from silver where {OBS}
            union all select 'label', count(*), cast(sum(count_views) as bigint)
            from silver where {_between(TRAIN.lbl_start, TRAIN.lbl_end)}""",
        "dau": f"""with {SILVER}
            select file_date, language, count(distinct page_title) as "DAU" from silver group by all""",
        **{
            name: f"""with {SILVER}
            select strftime(file_date, '%G-%V') as week, language, database_name, count(distinct page_title) as "WAU"
            from silver group by all"""
            for name in ("wau", "wau_bitmaps")
        },
        "uniques_from_sketches": f"""with {SILVER} """
        + " union all ".join(
            f"select '{period}' as period, strftime(file_date, '{form}') as label, language, count(distinct page_title) as n_pages,"
            " true as within_error from silver group by all"
            for period, form in (("day", "%Y-%m-%d"), ("week", "%G-%V"), ("month", "%Y-%m"))
        ),
        "mau": f"""with {SILVER}
            select strftime(file_date, '%Y-%m') as month, language, database_name, count(distinct page_title) as "MAU"
            from silver group by all""",
        **{
            name: f"""with {SILVER},
            d as (select file_date, strftime(file_date, '%Y-%m') as month, language, database_name,
                    count(distinct page_title) as "DAU" from silver group by all),
            m as (select strftime(file_date, '%Y-%m') as month, language, database_name,
                    count(distinct page_title) as "MAU" from silver group by all)
            select language, database_name, month, file_date, "DAU", "MAU", {_r('"DAU" / nullif("MAU", 0)')} as stickiness
            from d join m using (language, database_name, month)"""
            for name in ("stickiness", "stickiness_one_pass", "stickiness_bitmaps")
        },
        "stickiness_pct": f"""with {SILVER},
            d as (select file_date, strftime(file_date, '%Y-%m') as month, language,
                    count(distinct page_title) as "DAU" from silver group by all),
            m as (select strftime(file_date, '%Y-%m') as month, language,
                    count(distinct page_title) as "MAU" from silver group by all)
            select language, month, file_date, "DAU", "MAU", {_r('100.0 * "DAU" / nullif("MAU", 0)')} as stickiness
            from d left join m using (language, month)""",
        "diversity": f"""with {SILVER}
            select file_date as dt, language, database_name, count(distinct page_title) as distinct_pages,
              cast(sum(count_views) as bigint) as total_views,
              {_r('count(distinct page_title) / nullif(sum(count_views), 0)')} as diversity_index
            from silver group by file_date, language, database_name""",
        "shannon_entropy": f"""with {SILVER}, {PAGES},
            totals as (select dt, language, database_name, sum(views_page) as t from pages_day group by all)
            select dt, language, database_name, {_r('coalesce(h, 0.0)')} as shannon_entropy
            from totals left join (
              select dt, language, database_name, -sum((views_page / t) * ln(views_page / t)) as h
              from pages_day join totals using (dt, language, database_name) where views_page > 0 group by all)
            using (dt, language, database_name)""",
        "top_n_share": f"""with {SILVER}, {RANKED}
            select dt, language, database_name, cast(sum(views_page) as bigint) as total_views,
              {', '.join(f'cast(coalesce(sum(views_page) filter (where rank <= {n}), 0) as bigint) as top{n}_views' for n in (2, 5, 10, 100))},
              {', '.join(_r(f'sum(views_page) filter (where rank <= {n}) / nullif(sum(views_page), 0)') + f' as top{n}_share' for n in (2, 5, 10, 100))}
            from ranked group by dt, language, database_name""",
        "page_rank_daily": f"with {SILVER}, {RANKED} select dt, language, database_name, page_title, views_page, rank from ranked",
        "top_pages_daily": f"""with {SILVER}, {RANKED}
            select dt, language, database_name, page_title, views_page, rank from ranked where rank <= 3""",
        "top_pages_bounded": f"""with {SILVER}, {RANKED}
            select dt, language, database_name, page_title, views_page, rank from ranked where rank <= 3""",
        "top_pages_of_day": f"""with {SILVER}, pages as (
              select file_date as dt, page_title, cast(sum(count_views) as bigint) as views_page from silver group by all)
            select * from (
              select *, row_number() over (partition by dt order by views_page desc, page_title) as rank from pages)
            where rank <= 25""",
        "dau_share": f"""with {SILVER}, {SHARES}
            select file_date, language, "DAU", "DAU_total", {_r('"DAU_pct"')} as "DAU_pct" from shares""",
        "dau_share_one_vs_rest": f"""with {SILVER}, {SHARES}
            select file_date, case when language = 'English' then 'English' else 'Others' end as language,
              {_r('sum("DAU_pct")')} as "DAU_pct"
            from shares group by 1, 2""",
        "hourly_profile": f"""with {SILVER}
            select file_date, cast(substr(file_time, 1, 2) as integer) as hour, cast(sum(count_views) as bigint) as views_hour
            from silver group by all""",
        "hourly_profile_until": f"""with {SILVER}
            select file_date, cast(substr(file_time, 1, 2) as integer) as hour, cast(sum(count_views) as bigint) as views_hour
            from silver where file_date <= date '2024-01-10' group by all""",
        "hourly_first_n": f"""with {SILVER}
            select file_date, cast(substr(file_time, 1, 2) as integer) as hour, cast(sum(count_views) as bigint) as views_hour
            from silver group by all order by 1, 2 limit 218""",
        "daily_profile": f"""with {SILVER}
            select file_date, cast(sum(count_views) as bigint) as views_day, {_r('sum(count_views) / 24.0')} as views_day_per_hour
            from silver group by file_date""",
        "daily_vs_hourly": f"""with {SILVER},
            h as (select file_date, file_time, sum(count_views) as v from silver group by all),
            d as (select file_date, sum(count_views) / 24.0 as v from silver group by all)
            select (select count(*) from h) as n_hours, (select count(*) from d) as n_days,
              {_r('(select var_pop(v) from h)', 6)} as var_hourly, {_r('(select var_pop(v) from d)', 6)} as var_daily""",
        "weekend_spine": f"""with {SILVER}
            select cast(day as date) as day, dayofweek(day) in (0, 6) as is_weekend
            from (select unnest(generate_series(min(file_date), max(file_date), interval 1 day)) as day from silver)""",
        "daily_entity_views": f"with {SILVER}, {_daily()} select file_date, dow, {KEYS}, views_day from daily",
        "rolling_sum_3": f"with {SILVER}, {_daily()}, {_rolled()} select file_date, {KEYS}, views_day, sum_3d from rolled",
        "rolling_sum_7": f"with {SILVER}, {_daily()}, {_rolled()} select file_date, {KEYS}, views_day, sum_7d from rolled",
        "rolling_sum_7_calendar_days": f"""with {SILVER}, {_daily()}
            select file_date, {KEYS}, views_day, cast(sum(views_day) over (partition by {KEYS} order by file_date
              range between interval 6 days preceding and current row) as bigint) as sum_7d from daily""",
        "last_day_snapshot": f"""with {SILVER}, {_daily(TRAIN)}, {_rolled()}
            select {KEYS}, views_day as views_last_day, sum_3d from rolled where file_date = date '{TRAIN.obs_end}'""",
        "entity_features_core": f"""with {SILVER}, {_daily(TRAIN)}, agg as (select {KEYS}, {CORE} from daily group by {KEYS})
            select {KEYS}, days_active, views_total, {_r('views_mean')} as views_mean, {_r('views_std')} as views_std,
              unique_weekdays, {_r('views_std_dow')} as views_std_dow from agg""",
        "entity_features_full": f"""with {SILVER}, {_daily(TRAIN)},
            agg as (select {KEYS}, {_full(TRAIN.obs_start)} from daily group by {KEYS})
            select {KEYS}, days_active, views_total, {_r('views_mean')} as views_mean, {_r('views_std')} as views_std,
              unique_weekdays, {_r('views_std_dow')} as views_std_dow, views_max, views_median,
              {_r('trend_slope')} as trend_slope, first_dow from agg""",
        "domain_entropy": f"""with {SILVER}, {_entropy('namespace, page_title', 'entropy')}
            select namespace, page_title, n_domains, {_r('views_entropy')} as views_entropy,
              {_r('views_entropy_norm')} as views_entropy_norm from entropy""",
        "last_domain": f"""with {SILVER}
            select namespace, page_title, domain_code from (
              select *, row_number() over (partition by namespace, page_title
                order by file_date desc, file_time desc, domain_code desc) as rn from silver) where rn = 1""",
        "churn_labels": f"with {SILVER}, {_labels(TRAIN)} select {KEYS}, churn from labels",
        "sparsity_levels": f"""with {SILVER}, {_core_set(TRAIN)}
            select sparsity_level, count(*) as n_entities from core group by all""",
        "churn_dataset_core": f"with {SILVER}, {_core_set(TRAIN)} select {CORE_OUT} from core",
        "churn_dataset_full": f"""with {SILVER}, {FULL_SET}
            select {KEYS}, days_active, views_total, {_r('views_mean')} as views_mean, {_r('views_std')} as views_std,
              unique_weekdays, {_r('views_std_dow')} as views_std_dow, views_last_day, sum_3d, sum_7d, views_max,
              views_median, {_r('trend_slope')} as trend_slope, first_dow, n_domains, {_r('views_entropy')} as views_entropy,
              {_r('views_entropy_norm')} as views_entropy_norm, is_zero_history, is_sparse, sparsity_level, churn, domain_code
            from full_set""",
        "train_test_sets": f"""with {SILVER}, {_core_set(TRAIN, '_train')}, {_core_set(TEST, '_test')}
            select 'train' as set_name, {CORE_OUT} from core_train
            union all select 'test' as set_name, {CORE_OUT} from core_test""",
        "churn_rate_by_sparsity": f"""with {SILVER}, {_core_set(TRAIN)}
            select sparsity_level, {_r('avg(churn)')} as churn_rate, count(*) as n_entities from core group by sparsity_level""",
        "feature_box_stats": f"""with {SILVER}, {FULL_SET}, {BOX}
            select feature, churn, n_values, {_r('q1')} as q1, {_r('median')} as median, {_r('q3')} as q3,
              {_r('min(value) filter (where value >= q1 - 1.5 * (q3 - q1))')} as whisker_low,
              {_r('max(value) filter (where value <= q3 + 1.5 * (q3 - q1))')} as whisker_high
            from long join quarts using (feature, churn) group by feature, churn, n_values, q1, median, q3""",
        "dedup_latest": f"""with {SILVER}
            select page_title, domain_code, namespace, count_views, {STAMP} from (
              select *, row_number() over (partition by page_title, domain_code, namespace
                order by ingestion_time desc, count_views desc) as rn from silver) where rn = 1""",
        "late_upsert": f"""with {SILVER}, {LATE}
            select {SILVER_LIST}, {STAMP} from base where file_date <> date '{LATE_DAY}'
            union all select {SILVER_LIST}, {STAMP} from newest""",
        "late_upsert_days": f"""with {SILVER}, {LATE_DAYS}
            select {SILVER_LIST}, {STAMP} from base where not (day(file_date) % 3 = 0 and file_time >= '12:00:00')
            union all select {SILVER_LIST}, {STAMP} from newest""",
        "cluster_rewrite": f"with {SILVER} select {SILVER_LIST} from silver",
        "cluster_rewrite_range": f"with {SILVER} select {SILVER_LIST} from silver",
        "sample_fraction": f"""with {SILVER}
            select {SILVER_LIST} from silver where cast('0x' || substr(md5({EVENT_TEXT}), 1, 8) as bigint) < 0.05 * 4294967296""",
        "sample_n": f"""with {SILVER}, {_core_set(TRAIN)}
            select {CORE_OUT} from core order by md5({ENTITY_TEXT % 42}) limit 500""",
        "stratified_split": f"""with {SILVER}, {_core_set(TRAIN)}
            select {KEYS}, churn, cast('0x' || substr(md5({ENTITY_TEXT % 42}), 1, 8) as bigint) < round(0.2 * 4294967296) as is_test
            from core""",
        "stratified_split_exact": f"""with {SILVER}, {_core_set(TRAIN)}
            select {KEYS}, churn,
              row_number() over (partition by churn order by md5({ENTITY_TEXT % 42}))
                <= ceil(count(*) over (partition by churn) * 0.2) as is_test
            from core""",
        "standardize": f"""with {SILVER}, {_core_set(TRAIN)}
            select {KEYS}, {', '.join(_r(f'({c} - avg({c}) over ()) / stddev_pop({c}) over ()') + f' as {c}' for c in ('views_total', 'views_mean', 'sum_3d'))}
            from core""",
        "one_hot_features": f"""with {SILVER}, {_core_set(TRAIN)} """
        + " union all ".join(
            f"select '{c}' as column_name, cast({c} as varchar) as level, count(*) as n_rows from core group by {c}"
            for c in ("language", "database_name", "is_mobile", "namespace", "sparsity_level")
        ),
        "roc_auc": f"""with {SILVER}, {_core_set(TRAIN)}, {SCORED}, {STEPS}
            select {_r('sum(pos * ((n - fp) + neg / 2.0)) / (any_value(p) * any_value(n))')} as roc_auc from steps, sizes""",
        "average_precision": f"""with {SILVER}, {_core_set(TRAIN)}, {SCORED}, {STEPS}
            select {_r('sum((pos / p) * (tp / (tp + fp)))')} as average_precision from steps, sizes""",
        "roc_auc_grouped": f"""with {SILVER}, {_core_set(TRAIN)}, {GROUPED}
            select grouped_by, level, {_r('sum(pos * ((n - fp) + neg / 2.0)) / nullif(any_value(p) * any_value(n), 0)')} as roc_auc
            from steps join sizes using (grouped_by, level) group by grouped_by, level""",
        "average_precision_grouped": f"""with {SILVER}, {_core_set(TRAIN)}, {GROUPED}
            select grouped_by, level, {_r('sum((pos / nullif(p, 0)) * (tp / (tp + fp)))')} as average_precision
            from steps join sizes using (grouped_by, level) group by grouped_by, level""",
        "title_rates": f"""with {SILVER}, {_core_set(TRAIN)}, {RATES},
            fitted as (
              select {KEYS}, churn, false as is_test,
                (t.s - o.s + 20.0 * (a.s - d.s) / (a.n - d.n)) / (t.n - o.n + 20.0) as rate
              from split join per_fold o using (page_title, fold) join per_title t using (page_title) join of_fold d using (fold), of_all a
              where not is_test),
            later as (
              select {KEYS}, churn, true as is_test,
                (coalesce(t.s, 0) + 20.0 * a.s / a.n) / (coalesce(t.n, 0) + 20.0) as rate
              from split left join per_title t using (page_title), of_all a where is_test)
            select language, database_name, cast(is_mobile as varchar) as is_mobile, namespace, page_title, churn, is_test,
              {_r('rate')} as page_title_rate
            from (select * from fitted union all select * from later)""",
        "classification_report": f"""with {SILVER}, {_core_set(TRAIN)}, {SCORED},
            per_class as (
              select c, count(*) filter (where label = c and prediction = c) as hits,
                count(*) filter (where label = c) as support, count(*) filter (where prediction = c) as predicted
              from scored, (values (0), (1)) classes(c) group by c),
            measured as (
              select c, support, hits, coalesce(hits / nullif(predicted, 0), 0.0) as precision,
                coalesce(hits / nullif(support, 0), 0.0) as recall,
                coalesce(2 * hits / nullif(predicted + support, 0), 0.0) as f1 from per_class)
            select cast(c as varchar) as class, {_r('precision')} as precision, {_r('recall')} as recall, {_r('f1')} as f1, support
            from measured
            union all select 'accuracy', {_r('sum(hits) / sum(support)')}, {_r('sum(hits) / sum(support)')},
              {_r('sum(hits) / sum(support)')}, cast(sum(support) as bigint) from measured
            union all select 'macro avg', {_r('avg(precision)')}, {_r('avg(recall)')}, {_r('avg(f1)')},
              cast(sum(support) as bigint) from measured
            union all select 'weighted avg', {_r('sum(precision * support) / sum(support)')},
              {_r('sum(recall * support) / sum(support)')}, {_r('sum(f1 * support) / sum(support)')},
              cast(sum(support) as bigint) from measured""",
    }
    # The same sets by way of a stored table of entity days.
    return sql | {"train_test_sets_of_states": sql["train_test_sets"], "churn_dataset_full_of_states": sql["churn_dataset_full"]}
