"""The same results in plain SQL over the given tables, one statement per query of the registry."""

# Fixed values, written out here again so that a slip in the code's own lists shows.
CHANGE_TYPES = ["edit", "new", "log", "categorize", "external"]
NAMESPACE_LABELS = {
    0: "Bài viết",
    1: "Thảo luận",
    2: "Thành viên",
    3: "Thảo luận thành viên",
    4: "Wikipedia",
    5: "Thảo luận Wikipedia",
    6: "Tập tin",
    7: "Thảo luận tập tin",
    10: "Bản mẫu",
    11: "Thảo luận bản mẫu",
    12: "Trợ giúp",
    13: "Thảo luận trợ giúp",
    14: "Thể loại",
    15: "Thảo luận thể loại",
}

_FEED = """
base as (
    select e.event_id as e, e.user_id as u, e.value as v, e.ts, e.event_type, r.replay,
        cast(json_extract_string(e.props, '$.k') as integer) as k,
        date_trunc('day', e.ts) + case when e.event_id % 50 = 7 then interval 1 day else interval 0 day end as ws
    from events e join (values (0), (1)) r(replay) on r.replay = 0 or e.event_id % 10 = 0
),
feed as (
    select
        case when replay = 1 then e + 10000001 else e + 1 end as _raw_id,
        '{' || concat_ws(',',
            case when e % 3 = 0 then '"anon":true' end,
            case when e % 7 = 0 then '"bot":true' when e % 7 = 1 then '"bot":false' end,
            '"comment":' || case when replay = 1 then '"replay"' when e % 6 = 0 then '""' else '"c' || k || '"' end,
            case when e % 5 = 0 then '"minor":null' end,
            '"newlen":' || cast(1000 + cast(floor(v) as bigint) as varchar),
            '"ns":' || case when e % 41 = 0 then '"x"' else cast(k % 17 - 1 as varchar) end,
            case when e % 8 <> 3 then '"old_revid":' || (200000 + e) end,
            case when e % 11 <> 0 then '"oldlen":' || (1000 + u) end,
            case when e % 43 = 0 then '"pageid":"p"' when e % 9 <> 0 then '"pageid":' || (500 + k) end,
            case when e % 97 = 13 then '"rcid":"abc"' when e % 101 <> 17 then '"rcid":' || e end,
            case when e % 17 = 0 then '"redirect":""' end,
            case when e % 8 <> 3 then '"revid":' || (300000 + e) end,
            case when e % 4 = 0 then '"tags":' || case e % 3 when 0 then '[]' when 1 then '["t1"]' else '["t1","t2"]' end
                 when e % 4 = 1 then '"tags":"t"' end,
            case when e % 83 <> 3 then '"timestamp":"' || case
                 when e % 89 = 5 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
                 when e % 13 = 6 then strftime(ts + interval 2 hours, '%Y-%m-%dT%H:%M:%S') || '+02:00'
                 else strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' end || '"' end,
            '"title":"Page ' || k || '"',
            '"type":"' || case event_type when 'click' then 'edit' when 'view' then 'new' when 'signup' then 'log'
                 when 'purchase' then 'categorize' when 'error' then 'external' end || '"',
            case when e % 20 = 10 then '"user":""' when e % 20 <> 0 then '"user":"u' || u || '"' end,
            case when e % 19 = 0 then '"userhidden":""' end,
            '"userid":' || u
        ) || '}' as _raw,
        cast(ws as timestamp) as _window_start,
        cast(ws + interval 1 day as timestamp) as _window_end,
        cast(ws + interval 1 day * (1 + replay) as timestamp) as _ingested_at,
        replay,
        dense_rank() over (partition by ws order by replay, (e - low) // 500) as page_no
    from (select *, min(e) over (partition by ws) as low from base)
)"""

_JUDGED = """,
texts as (
    select *, json_extract_string(_raw, '$.rcid') as rcid, json_extract_string(_raw, '$.timestamp') as stamp from feed
),
keyed as (
    select *,
        case when regexp_full_match(rcid, '[+-]?[0-9]+') then try_cast(rcid as bigint) end as _key,
        case when regexp_full_match(stamp, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+]02:00)')
             then try_cast(left(stamp, 19) as timestamp)
                 - case when stamp like '%+02:00' then interval 2 hours else interval 0 hours end end as event_time
    from texts
),
judged as (
    select *,
        case when _key is null or event_time is null then 'error'
             when event_time >= _window_start and event_time < _window_end then 'ok' else 'outside_window' end as status,
        case when _key is null then 'invalid_natural_key' when event_time is null then 'invalid_timestamp' end as error_type,
        case when _key is null then
                 case when rcid is null then '''rcid'''
                      else 'invalid literal for int() with base 10: ''' || rcid || '''' end
             when event_time is null then
                 case when stamp is null then '''timestamp''' else 'Timestamp has no timezone: ' || stamp end
        end as error_message
    from keyed
),
valid as (select * from judged where status = 'ok'),
raw as (select * from valid qualify row_number() over (partition by _key order by _raw_id) = 1),
errors as (
    select *, sha256(concat_ws('|', _raw, strftime(_window_start, '%Y-%m-%dT%H:%M:%S') || '+00:00',
                     strftime(_window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00')) as _error_fingerprint
    from judged where status = 'error'
),
quarantine as (select * from errors qualify row_number() over (partition by _error_fingerprint order by _raw_id) = 1)"""


def _typed(source: str, name: str) -> str:
    def number(key: str, kind: str = "bigint", signed: bool = False) -> str:
        text = f"json_extract_string(_raw, '$.{key}')"
        return f"case when regexp_full_match({text}, '{'-?' if signed else ''}[0-9]+') then try_cast({text} as {kind}) end"

    def text(key: str) -> str:
        return f"nullif(json_extract_string(_raw, '$.{key}'), '')"

    def flag(key: str) -> str:
        return f"list_contains(json_keys(_raw), '{key}')"

    return f""",
{name} as (
    select _raw_id,
        {number("rcid")} as change_id, {text("type")} as change_type, {number("ns", "integer", True)} as namespace_id,
        {text("title")} as page_title, {number("pageid")} as page_id, {number("revid")} as revision_id,
        {number("old_revid")} as old_revision_id, coalesce({text("user")}, 'unknown') as user_name,
        {number("userid")} as user_id, {text("comment")} as change_comment,
        cast(left(json_extract_string(_raw, '$.timestamp'), 19) as timestamp)
            - case when json_extract_string(_raw, '$.timestamp') like '%+02:00' then interval 2 hours else interval 0 hours end
            as changed_at_utc,
        {number("oldlen", signed=True)} as old_length, {number("newlen", signed=True)} as new_length,
        {flag("bot")} as is_bot, {flag("minor")} as is_minor, {flag("anon")} as is_anonymous,
        {flag("redirect")} as is_redirect, {flag("userhidden")} as is_user_hidden,
        {text("user")} is null as is_user_missing,
        cast(case when json_type(_raw, '$.tags') = 'ARRAY' then json_array_length(_raw, '$.tags') else 0 end as integer)
            as tag_count,
        _window_start, _window_end, _ingested_at
    from {source}
)"""


def _latest(source: str, name: str) -> str:
    return f""",
{name} as (
    select * exclude (_raw_id) from {source}
    qualify row_number() over (partition by change_id order by _ingested_at desc, _raw_id desc) = 1
)"""


_STAGED = _JUDGED + _typed("raw", "typed") + _latest("typed", "staged")


def _rate(part: str, total: str) -> str:
    # exact half-up division at four digits, on integers
    return f"cast((cast({part} as bigint) * 20000 + {total}) // (2 * {total}) as double) / 10000"


_LABELS = " ".join(f"when {n} then '{label}'" for n, label in NAMESPACE_LABELS.items())

_MART = (
    _STAGED
    + f""",
counted as (
    select cast(changed_at_utc as date) as activity_date, namespace_id,
        case namespace_id {_LABELS} else 'Namespace ' || namespace_id end as namespace_name,
        count(*) as total_changes,
        cast(count_if(change_type = 'edit') as bigint) as edit_count,
        cast(count_if(change_type = 'new') as bigint) as new_page_count,
        cast(count_if(change_type = 'log') as bigint) as log_count,
        cast(count_if(is_bot) as bigint) as bot_changes,
        cast(count_if(is_anonymous) as bigint) as anonymous_changes,
        cast(count_if(is_minor) as bigint) as minor_changes,
        cast(count_if(is_user_missing) as bigint) as missing_user_changes,
        count(distinct case when not is_user_missing then user_name end) as unique_users,
        cast(sum(coalesce(new_length - old_length, 0)) as bigint) as net_bytes_change
    from staged group by all
),
mart as (
    select *, {_rate("bot_changes", "total_changes")} as bot_rate,
        {_rate("anonymous_changes", "total_changes")} as anonymous_rate
    from counted
)"""
)

_PAGES = """,
sized as (
    select *, row_number() over (partition by _window_start, page_no order by _raw_id) - 1 as pos,
        max(page_no) over (partition by _window_start) as last_page
    from feed
),
pages as (
    select distinct _window_start, _window_end, page_no, true as readable,
        (day(_window_start) + page_no) % 11 = 0 as has_error,
        page_no < last_page or day(_window_start) % 7 = 0 as has_more
    from sized
)"""

_DISTURBED = _PAGES + """,
copies as (
    select _window_start, _window_end, page_no, has_error, has_more, _window_end as fetched_at from pages
    union all
    select p._window_start, p._window_end, p.page_no, false, p.page_no < l.last_page, p._window_end + interval 1 hour
    from pages p join (select distinct _window_start, last_page from sized) l using (_window_start)
    where p.has_error and day(p._window_start) % 2 = 0
    union all
    select _window_start, _window_end, page_no, true, false, _window_start from pages where day(_window_start) % 8 = 3
),
newest as (
    select * from copies where (day(_window_start) * 3 + page_no) % 13 <> 0 and day(_window_start) % 10 <> 5
    qualify row_number() over (partition by _window_start, page_no order by fetched_at desc) = 1
),
gaps as (
    select _window_start, page_no, lag(page_no, 1, 0) over (partition by _window_start order by page_no) as before from newest
),
asked_days as (
    select unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as _window_start from events
),
broken as (select distinct day(_window_start) as d from feed where day(_window_start) % 9 = 0)"""

_STATS = (
    _JUDGED
    + """,
stats as (
    select j._window_start, j.page_no, count(*) as fetched, count(r._raw_id) as inserted,
        count(*) filter (where j.status = 'ok') - count(r._raw_id) as duplicates, count(q._raw_id) as quarantined,
        count(*) filter (where j.status = 'outside_window') as outside_window, 1 as pages
    from judged j left join raw r using (_raw_id) left join quarantine q using (_raw_id)
    group by j._window_start, j.page_no
)"""
)

_TOTALS = ", ".join(
    f"cast(sum({c}) as bigint) as {c}"
    for c in ("fetched", "inserted", "duplicates", "quarantined", "outside_window", "pages")
)
_TYPES = ", ".join(f"'{t}'" for t in CHANGE_TYPES)
_RAW = "_raw_id, _raw, _window_start, _window_end, _ingested_at"
_DAMAGED_RAW = """,
damaged as (
    select _raw_id, case when _raw_id % 97 <> 0 then _raw end as _raw, _window_start,
        case when _raw_id % 89 = 0 then _window_start else _window_end end as _window_end,
        case when _raw_id % 83 <> 0 then _ingested_at end as _ingested_at
    from feed
)"""
_ASKED = """,
asked as (
    select distinct _window_start,
        case when day(_window_start) % 5 = 0 then _window_start + interval 1 day
             when day(_window_start) % 6 = 0 then _window_start - interval 1 day else _window_end end as _window_end
    from feed
)"""
_MUTATED = """,
mutated as (
    select _raw_id, case when _raw_id % 50 = 0 then replace(_raw, '"comment":"', '"comment":"edited ') else _raw end as _raw
    from raw where _raw_id % 77 <> 0
)"""
_DAYS = """,
days as (
    select unnest(generate_series(min(date_trunc('day', ts))::timestamp, max(date_trunc('day', ts))::timestamp + interval {extra} day,
                                  interval 1 day)) as _window_start
    from events
)"""


def _q(ctes: str, select: str) -> str:
    return f"with {_FEED}{ctes}\n{select}"


def _null_rows(source: str, columns: list[str], keep: str) -> str:
    return "\nunion all\n".join(
        f"select {keep}, '{c}' as null_column from {source} where {c} is null" for c in columns
    )


def _null_counts(source: str, columns: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) as checked, count(*) - count({c}) as violations from {source}"
        for c in columns
    )


_RECONCILED = """
select activity_date, namespace_id, expected_count, total_changes as actual_count
from (select cast(changed_at_utc as date) as activity_date, namespace_id, count(*) as expected_count from staged group by all)
full join mart using (activity_date, namespace_id)
where expected_count is distinct from total_changes"""

_NEGATIVE = " or ".join(
    f"{c} < 0"
    for c in (
        "total_changes edit_count new_page_count log_count bot_changes anonymous_changes minor_changes "
        "missing_user_changes unique_users bot_rate anonymous_rate"
    ).split()
)


def _report() -> str:
    def count(relation: str, check: str, body: str) -> str:
        return f"select '{relation}' as relation, '{check}' as \"check\", ({body}) as violations"

    rows = [
        count(relation, f"not_null {c}", f"select count(*) from {source} where {c} is null")
        for relation, source, columns in (
            ("raw", "raw", ["_raw", "_window_start", "_window_end"]),
            ("staging", "staged", ["change_id", "changed_at_utc", "namespace_id", "change_type"]),
            ("mart", "mart", ["activity_date", "namespace_id", "namespace_name", "total_changes"]),
        )
        for c in columns
    ]
    rows += [
        count(
            "staging",
            "accepted_values change_type",
            f"select count(distinct change_type) from staged where change_type not in ({_TYPES})",
        ),
        count(
            "staging",
            "event inside window",
            "select count(*) from staged where changed_at_utc < _window_start or changed_at_utc >= _window_end",
        ),
        count(
            "staging",
            "unique change_id",
            "select count(*) from (select change_id from staged where change_id is not null "
            "group by change_id having count(*) > 1)",
        ),
        count(
            "mart",
            "non-negative metrics",
            f"select count(*) from mart where {_NEGATIVE} or bot_rate > 1 or anonymous_rate > 1",
        ),
        count(
            "mart",
            "daily grain",
            "select count(*) from (select 1 from mart group by activity_date, namespace_id having count(*) > 1)",
        ),
        count("mart", "staging mart reconciliation", f"select count(*) from ({_RECONCILED})"),
    ]
    return "select *, violations = 0 as passed from (" + "\nunion all\n".join(rows) + ")"


_REPORT = _q(_MART, _report())
_TEN_DAYS = """between (select cast(min(ts) as date) + 4 from events) and (select cast(min(ts) as date) + 13 from events)"""
_REPORT_DAYS = _q(
    _MART
    + f""",
ten_days_staged as (select * from staged where cast(changed_at_utc as date) {_TEN_DAYS}),
ten_days_mart as (select * from mart where activity_date {_TEN_DAYS})""",
    f"""select * from (
    with staged as (select * from ten_days_staged), mart as (select * from ten_days_mart)
    {_report()}) where "check" <> 'not_null _raw'""",
)
_MART_ROWS = _q(_MART, "select * from mart")
_DATES = "_window_start, cast(_window_start + interval 1 day as timestamp) as _window_end"

ORACLES: dict[str, str] = {
    "deliveries_raw": _q("", f"select {_RAW} from feed"),
    "envelope_records": _q(_PAGES, "select _window_start, _window_end, page_no, pos, _raw from sized"),
    "envelope_pages": _q(_PAGES, "select _window_start, page_no, readable, has_error, has_more from pages"),
    "envelope_errors": _q(
        _PAGES,
        """select _window_start, page_no, 'source_error' as reason,
            '{"code":"busy","page":' || page_no || '}' as detail from pages where has_error""",
    ),
    "incomplete_windows": _q(
        _PAGES,
        """select _window_start, _window_end, max(page_no) as last_page from pages
        group by all having arg_max(has_more, page_no)""",
    ),
    "refetched_pages": _q(_DISTURBED, "select _window_start, page_no, cast(fetched_at as timestamp) as fetched_at, has_error from newest"),
    "page_gaps": _q(
        _DISTURBED,
        """select _window_start, before + 1 as first_missing, page_no - 1 as last_missing from gaps where page_no - before > 1""",
    ),
    "missing_windows": _q(
        _DISTURBED,
        "select cast(_window_start as timestamp) as _window_start from asked_days where _window_start not in (select _window_start from newest)",
    ),
    "landing_violations": _q(
        _DISTURBED,
        """select * from (
            select 'source_error' as reason, count(*) as violations from newest where has_error
            union all select 'unreadable_page', count(*) from broken
            union all select 'page_gap', count(*) from gaps where page_no - before > 1
            union all select 'page_limit', count(distinct _window_start) from newest where page_no > 1
            union all select 'incomplete_window', count(*) from
                (select _window_start from newest group by all having arg_max(has_more, page_no))
            union all select 'missing_window', count(*) from asked_days
                where _window_start not in (select _window_start from newest)
        ) where violations > 0""",
    ),
    "stream_bad_pages": _q(
        _DISTURBED,
        """select _window_start, page_no, 'source_error' as reason, '{"code":"busy","page":' || page_no || '}' as detail
        from newest where has_error
        union all select null, null, 'unreadable_page', '{broken ' || d from broken""",
    ),
    "admitted_records": _q(
        _PAGES,
        """select s._window_start, s.page_no, s.pos, s._raw from sized s
        where not exists (select 1 from pages p
            where p._window_start = s._window_start and p.has_error and p.page_no <= s.page_no)""",
    ),
    "window_guard": _q(
        _ASKED,
        """select _window_start, cast(_window_end as timestamp) as _window_end,
            case when _window_start >= _window_end then 'invalid_order'
                 when timestamp '2024-02-10 12:00:00' - _window_start > interval 30 day then 'beyond_retention'
                 else 'ok' end as status from asked""",
    ),
    "source_request": _q(
        _ASKED,
        f"""select _window_start, cast(_window_end as timestamp) as _window_end,
            strftime(_window_start, '%Y-%m-%dT%H:%M:%SZ') as rcstart, strftime(_window_end, '%Y-%m-%dT%H:%M:%SZ') as rcend,
            'newer' as rcdir, '{"|".join(CHANGE_TYPES)}' as rctype,
            'title|ids|sizes|flags|user|userid|timestamp|comment|loginfo|tags' as rcprop from asked""",
    ),
    "source_predicate": _q(
        _typed("feed", "typed"),
        """select _raw_id, change_id, change_type, changed_at_utc from typed
        where changed_at_utc between timestamp '2024-01-10' and timestamp '2024-01-20'
          and change_type in ('edit', 'new', 'log')""",
    ),
    "record_status": _q(_JUDGED, "select _raw_id, _key, event_time, status, error_type, error_message from judged"),
    "quarantine": _q(
        _JUDGED,
        """select _error_fingerprint, _raw, error_type as _error_type, error_message as _error_message,
            _window_start, _window_end, _ingested_at from quarantine""",
    ),
    "quarantine_increment": _q(
        _JUDGED,
        """select _error_fingerprint, _raw_id from quarantine
        where _error_fingerprint not in (select _error_fingerprint from errors where replay = 0)""",
    ),
    "raw_insert": _q(_JUDGED, f"select {_RAW} from raw"),
    "raw_insert_increment": _q(
        _JUDGED,
        f"""select _key, {_RAW} from raw
        where _key not in (select _key from valid where _window_start < timestamp '2024-01-16')""",
    ),
    "raw_insert_filtered": _q(
        _JUDGED,
        """select _key * 48271 % 2147483647 as _key, _raw_id, _window_start, cast(event_time as date) as event_date from raw
        where _key not in (select _key from valid where _window_start < timestamp '2024-01-16')""",
    ),
    "key_filter_audit": _q(
        _JUDGED,
        """select cast(event_time as date) as event_date, count(*) as stored_keys, 0 as denied, true as few_false from (
            select _key, arg_min(event_time, _raw_id) as event_time from valid where _window_start < timestamp '2024-01-16' group by 1
        ) group by 1""",
    ),
    "constraint_violations": _q(
        _DAMAGED_RAW,
        """select _raw_id, '_raw not null' as "constraint" from damaged where _raw is null
        union all select _raw_id, '_ingested_at not null' from damaged where _ingested_at is null
        union all select _raw_id, 'window order' from damaged where _window_start >= _window_end""",
    ),
    "load_stats_page": _q(_STATS, "select * from stats"),
    "load_stats_window": _q(_STATS, f"select _window_start, {_TOTALS} from stats group by _window_start"),
    "load_stats_total": _q(_STATS, f"select {_TOTALS} from stats"),
    "stg_events": _q(_STAGED, "select * from staged"),
    "stg_latest_wins": _q(_typed("feed", "typed") + _latest("typed", "staged"), "select * from staged"),
    "json_flags": _q(
        "",
        "select _raw_id, "
        + ", ".join(
            f"list_contains(json_keys(_raw), '{k}') as has_{k}" for k in ("bot", "minor", "anon", "redirect", "userhidden")
        )
        + " from feed",
    ),
    "tag_counts": _q(
        _typed("feed", "typed"), "select tag_count, count(*) as records from typed group by tag_count"
    ),
    "mart_daily": _MART_ROWS,
    "daily_total_changes": _q(
        _MART, "select activity_date, cast(sum(total_changes) as bigint) as total_changes from mart group by 1 order by 1"
    ),
    "daily_rates": _q(
        _MART,
        f"""select activity_date, {_rate("sum(bot_changes)", "sum(total_changes)")} as bot_rate,
            {_rate("sum(anonymous_changes)", "sum(total_changes)")} as anonymous_rate from mart group by 1 order by 1""",
    ),
    "namespace_totals": _q(
        _MART, "select namespace_name, cast(sum(total_changes) as bigint) as total_changes from mart group by 1"
    ),
    "top_namespaces": _q(
        _MART,
        """select namespace_name, cast(sum(total_changes) as bigint) as total_changes from mart group by 1
        order by 2 desc, 1 nulls last limit 10""",
    ),
    "distinct_users_daily": _q(
        _STAGED,
        """select cast(changed_at_utc as date) as activity_date, count(distinct user_name) as unique_users, true as close
        from staged where not is_user_missing group by 1
        union all select null, count(distinct user_name), true from staged where not is_user_missing""",
    ),
    "latest_day_kpis": _q(
        _MART,
        f"""select activity_date, cast(sum(total_changes) as bigint) as total_changes,
            cast(sum(unique_users) as bigint) as namespace_user_occurrences,
            {_rate("sum(bot_changes)", "sum(total_changes)")} as bot_rate,
            {_rate("sum(anonymous_changes)", "sum(total_changes)")} as anonymous_rate
        from mart where activity_date = (select max(activity_date) from mart) group by 1""",
    ),
    "latest_day": _q(_MART, "select max(activity_date) as activity_date from mart"),
    "staging_counts": _q(
        _STAGED,
        """select cast(changed_at_utc as date) as activity_date, namespace_id, count(*) as expected_count
        from staged group by 1, 2""",
    ),
    "published_views": _q(
        _STAGED,
        """select cast(changed_at_utc as date) as activity_date, namespace_id, count(*) as total_changes,
            count(change_id) as staged, count(distinct page_title) as pages
        from staged where namespace_id is not null group by 1, 2""",
    ),
    "change_types_daily": _q(
        _MART,
        """select activity_date, cast(sum(edit_count) as bigint) as edit_count,
            cast(sum(new_page_count) as bigint) as new_page_count, cast(sum(log_count) as bigint) as log_count
        from mart group by 1 order by 1""",
    ),
    "change_types_long": _q(
        _MART,
        """select activity_date, change_type, changes from (
            select activity_date, cast(sum(edit_count) as bigint) as edit_count,
                cast(sum(new_page_count) as bigint) as new_page_count, cast(sum(log_count) as bigint) as log_count
            from mart group by 1) unpivot (changes for change_type in (edit_count, new_page_count, log_count))""",
    ),
    "mart_peek": _q(
        _MART, "select * from mart order by activity_date nulls last, namespace_id nulls last limit 20"
    ),
    "staging_peek": _q(_STAGED, "select * from staged order by change_id nulls last limit 5"),
    "dq_not_null_raw": _q(_DAMAGED_RAW, _null_counts("damaged", ["_raw", "_window_start", "_window_end"])),
    "dq_not_null_staging": _q(
        _typed("feed", "typed"),
        _null_rows("typed", ["change_id", "changed_at_utc", "namespace_id", "change_type"], "_raw_id"),
    ),
    "dq_not_null_mart": _q(
        _MART,
        _null_rows(
            "mart", ["activity_date", "namespace_id", "namespace_name", "total_changes"], "activity_date, namespace_id"
        ),
    ),
    "dq_unique_change_id": _q(
        _typed("feed", "typed"),
        """select change_id as unique_field, count(*) as n_records from typed where change_id is not null
        group by 1 having count(*) > 1""",
    ),
    "dq_accepted_types": """select event_type as value_field, count(*) as n_records from events
        where event_type not in ('click', 'view', 'signup') group by 1""",
    "dq_daily_grain": _q(
        _MART,
        """select activity_date, namespace_id, count(*) as row_count
        from (select * from mart union all
              (select * from mart order by activity_date nulls last, namespace_id nulls last limit 1))
        group by 1, 2 having count(*) > 1""",
    ),
    "dq_inside_window": _q(
        _typed("feed", "typed"),
        """select _raw_id, change_id, changed_at_utc, _window_start, _window_end from typed
        where changed_at_utc < _window_start or changed_at_utc >= _window_end""",
    ),
    "dq_metric_ranges": _q(
        _MART,
        f"""select * from (select * replace (
                case when day(activity_date) % 5 = 0 then -1 - log_count else log_count end as log_count,
                case when namespace_id = 4 then bot_rate + 1 else bot_rate end as bot_rate) from mart)
        where {_NEGATIVE} or bot_rate > 1 or anonymous_rate > 1""",
    ),
    "dq_reconciliation": _q(_MART, _RECONCILED),
    "dq_report": _REPORT,
    "dq_orders_unique_customer": """select o_custkey as unique_field, count(*) as n_records from orders
        where o_custkey is not null group by 1 having count(*) > 1""",
    "dq_orders_accepted_priority": """select o_orderpriority as value_field, count(*) as n_records from orders
        where o_orderpriority not in ('1-URGENT', '2-HIGH') group by 1""",
    "dq_lineitem_grain": """select l_orderkey, l_linenumber, count(*) as row_count from lineitem
        group by 1, 2 having count(*) > 1""",
    "dq_lineitem_ranges": """select l_orderkey, l_linenumber, l_quantity - 10 as net_units from lineitem
        where l_quantity - 10 < 0 or l_extendedprice < 0 or l_discount < 0 or l_discount > 1 or l_tax < 0 or l_tax > 1""",
    "dq_orders_reconciliation": """select coalesce(l.order_key, o.order_key) as order_key, line_count, order_count
        from (select l_orderkey as order_key, count(*) as line_count from lineitem group by 1) l
        full join (select o_orderkey as order_key, count(*) as order_count from orders group by 1) o
            on l.order_key = o.order_key
        where line_count is distinct from order_count""",
    "dq_document_nulls": _null_counts("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "backfill_windows": f"with {_DAYS.format(extra=0).lstrip(',')} select {_DATES} from days",
    "assigned_windows": """select event_id, date_trunc('day', ts)::timestamp as _window_start,
        cast(date_trunc('day', ts) + interval 1 day as timestamp) as _window_end from events""",
    "assigned_general_windows": f"""with {_DAYS.format(extra=0).lstrip(",")}
        select _window_start, cast(_window_start + interval 36 hour as timestamp) as _window_end, count(*) as events,
            min(event_id) as first_event, max(event_id) as last_event
        from days join events on ts >= _window_start and ts < _window_start + interval 36 hour group by 1, 2""",
    "assigned_mixed_windows": f"""with {_DAYS.format(extra=0).lstrip(",")}
        select _window_start, cast(_window_start + to_minutes(n) as timestamp) as _window_end, count(*) as events,
            min(event_id) as first_event, max(event_id) as last_event
        from days cross join (values (1), (2160), (525600)) v(n)
        join events on ts >= _window_start and ts < _window_start + to_minutes(n) group by 1, 2""",
    "backfill_coverage": _q(
        _MART,
        """select min(activity_date) as min_date, max(activity_date) as max_date,
            count(distinct activity_date) as number_of_days, cast(sum(total_changes) as bigint) as total_changes,
            cast(sum(bot_changes) as bigint) as bot_changes, cast(sum(anonymous_changes) as bigint) as anonymous_changes
        from mart""",
    ),
    "missing_days": _q(
        _MART + _DAYS.format(extra=7),
        f"""select cast(_window_start as date) as activity_date, {_DATES} from days
        where cast(_window_start as date) not in (select activity_date from mart)""",
    ),
    "idempotency_windows": _q(
        _JUDGED,
        """select _window_start, _window_end, count(*) as raw_rows, min(_ingested_at) as first_ingested_at,
            max(_ingested_at) as last_ingested_at from raw group by 1, 2 order by 1""",
    ),
    "idempotency_days": _q(
        _MART,
        "select activity_date, cast(sum(total_changes) as bigint) as mart_total_changes from mart group by 1 order by 1",
    ),
    "replay_diff": _q(
        _MART,
        """select coalesce(r.day, m.day) as day, n as raw_rows_before, n as raw_rows_after, true as raw_unchanged,
            t as mart_total_changes_before, t as mart_total_changes_after, true as mart_unchanged
        from (select cast(_window_start as date) as day, count(*) as n from raw group by 1) r
        full join (select activity_date as day, cast(sum(total_changes) as bigint) as t from mart group by 1) m
            on r.day = m.day""",
    ),
    "append_only_audit": _q(
        _JUDGED + _MUTATED,
        """select r._raw_id, case when m._raw_id is null then 'vanished' else 'changed' end as violation
        from raw r left join mutated m using (_raw_id) where m._raw is distinct from r._raw""",
    ),
    "vanished_rows": _q(
        _JUDGED + _MUTATED, "select _raw_id, _raw from raw except all select _raw_id, _raw from mutated"
    ),
    "daily_run": _MART_ROWS,
    "daily_run_report": _REPORT,
    "snapshot_drilldown": _q(
        _JUDGED,
        """select cast(event_time as date) as _event_date, _raw_id,
            case when _raw_id % 77 = 0 then 'vanished' else 'changed' end as violation
        from raw where day(event_time) % 10 = 3 and (_raw_id % 77 = 0 or _raw_id % 50 = 0)""",
    ),
    "day_digests": _q(
        _JUDGED,
        "select cast(event_time as date) as _event_date, count(*) as digest_rows_before, true as unchanged from raw group by all",
    ),
    "stream_page_ledger": _q(
        _DISTURBED,
        """, good as (
            select _window_start, page_no, has_more, lag(page_no, 1, 0) over (partition by _window_start order by page_no) as before
            from newest where not has_error
        ),
        ends as (select _window_start, max(page_no) as last_page, arg_max(has_more, page_no) as has_more from good group by all)
        select _window_start, 'page_gap' as reason, before + 1 as page_no from good where page_no - before > 1
        union all select _window_start, 'incomplete_window', last_page from ends where has_more
        union all select _window_start, 'page_limit', last_page from ends where last_page > 1
        union all select _window_start, 'missing_window', null from asked_days where _window_start not in (select _window_start from ends)""",
    ),
    "dq_report_days": _REPORT_DAYS,
    "stg_untyped_keys": _q(
        _JUDGED,
        """select false as untyped, count(*) as records, max(event_time) as newest from raw where _key % 70 <> 0
        union all
        select true, 1, event_time from (
            select event_time from raw where _key % 70 = 0 order by _window_start desc, page_no desc, _raw_id desc limit 1)""",
    ),
    "backfill_run": _q(
        _MART,
        """select min(activity_date) as min_date, max(activity_date) as max_date,
            count(distinct activity_date) as number_of_days, cast(sum(total_changes) as bigint) as total_changes,
            cast(sum(bot_changes) as bigint) as bot_changes, cast(sum(anonymous_changes) as bigint) as anonymous_changes
        from mart""",
    ),
    "backfill_resumed": _q(
        _MART,
        """select activity_date, cast(sum(total_changes) as bigint) as total_changes, cast(3 as bigint) as steps,
            cast(1 as bigint) as loads from mart group by 1""",
    ),
    "daily_run_stats": _q(
        _JUDGED,
        """select 1 as load, (select count(*) from judged where replay = 0) as fetched,
            (select count(*) from raw) as inserted, 0 as duplicates,
            (select count(distinct _error_fingerprint) from errors where replay = 0) as quarantined,
            (select count(*) from judged where replay = 0 and status = 'outside_window') as outside_window,
            (select count(*) from (select distinct _window_start, page_no from feed where replay = 0)) as pages
        union all
        select 2, (select count(*) from judged), 0, (select count(*) from valid),
            (select count(*) from quarantine) - (select count(distinct _error_fingerprint) from errors where replay = 0),
            (select count(*) from judged where status = 'outside_window'),
            (select count(*) from (select distinct _window_start, page_no from feed))""",
    ),
    "stream_ingest": _q(_JUDGED, "select _key, _raw, _window_start, _window_end from raw"),
    "stream_mart": _MART_ROWS,
    "stream_dedup": _q(_JUDGED, "select _key, event_time, _window_start from raw"),
    "stream_daily_counts": _q(
        _MART, "select activity_date, namespace_id, total_changes, bot_changes, anonymous_changes from mart"
    ),
}
