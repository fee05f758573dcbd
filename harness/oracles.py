"""DuckDB SQL for every check query, written independently of the library.

Only the input rows (logs, places, images) come from the shared expressions of ``inputs``.
"""

from harness import inputs
from harness.inputs import FIRST_RUN, LAST_DAY, SECOND_RUN


def _list(expressions: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for name, sql in expressions.items())


# Views that the queries below are built from, in dependency order.
_VIEWS = {
    "numbered": f"select *, {inputs.EVENT_NUMBER} as k from events",
    "logs": (
        f"select {_list(inputs.LOG_COLUMNS)}, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as \"requestTime\", "
        'epoch_us(ts) // 1000 as "time" from numbered'
    ),
    "split": (
        "select *, regexp_full_match(seg, '[0-9]+') as num from "
        "(select *, regexp_extract(tr, '([^/]*)$', 1) as seg from "
        "(select *, rtrim(u, '/') as tr from "
        "(select *, regexp_replace(url, '^http://[^/]+', '') as u from logs)))"
    ),
    "cleansed": (
        'select "traceId", "memberId", "clientIp", u as url, method, "requestParam", request, '
        'response, "statusCode", "requestTime", "time", '
        "case when num then replace(case when strpos(tr, '/') = 0 then '/' "
        "else left(tr, length(tr) - length(seg)) end, '/', '_') "
        "when u = '' then '_' else replace(u, '/', '_') end as url_part, "
        'case when num then seg end as "pathParam", '
        'cast(try_cast("requestTime" as date) as varchar) as cre_dtm, '
        f"'{FIRST_RUN}.000000' as etl_dtm from split"
    ),
    "again": (
        "select * replace ('201' as \"statusCode\", "
        f"'{SECOND_RUN}.000000' as etl_dtm) "
        "from cleansed where \"statusCode\" in ('400', '500')"
    ),
    "deduplicated": (
        "select * exclude (rn) from (select *, row_number() over "
        '(partition by "traceId" order by etl_dtm desc) as rn from '
        "(select * from cleansed union all select * from again)) where rn = 1"
    ),
    "created": (
        'select cre_dtm, count(*) as "count" from cleansed where url_part = \'_api_v1_group\' '
        "and method = 'POST' and try_cast(\"statusCode\" as int) = 201 group by cre_dtm"
    ),
    "created_again": (
        'select cre_dtm, count(*) as "count" from deduplicated '
        "where url_part = '_api_v1_group' and method = 'POST' "
        'and try_cast("statusCode" as int) = 201 group by cre_dtm'
    ),
    "applications": (
        "select cre_dtm, cast(json_extract_string(request, '$.groupId') as int) as group_id, "
        "count(*) as \"count\" from cleansed where url_part = '_api_v1_application' "
        "and method = 'POST' group by 1, 2"
    ),
    "picks": (
        "select cre_dtm, unnest(cast(json_extract(response, '$.categories') as json[])) as c "
        "from cleansed where url_part = '_api_v1_group' and method = 'POST'"
    ),
    "categories": (
        "select cre_dtm, cast(c->>'$.id' as int) as category_id, c->>'$.name' as category_name, "
        'count(*) as "count" from picks group by 1, 2, 3'
    ),
    "places": f"select {_list(inputs.PLACE_COLUMNS)} from part",
    "images": (
        "select cast(p_partkey as varchar) as id, concat('/img/', cast(p_partkey as varchar), "
        "'_', cast(n as varchar), '.png') as image_path from "
        "(select p_partkey, unnest(range(1, p_size % 3 + 1)) as n from part)"
    ),
    "members": 'select cast(c_custkey as varchar) as "memberId" from customer',
    "views": (
        'select cre_dtm, "memberId", "traceId", '
        "cast(json_extract_string(response, '$.id') as bigint) as id "
        "from cleansed where url_part = '_api_v1_place_' and method = 'GET'"
    ),
    "known_views": (
        "select v.*, p.ml_mapping_id from views v join places p "
        "on try_cast(p.id as bigint) = v.id"
    ),
    "member_counts": (
        'select cre_dtm, "memberId", ml_mapping_id, id, count(*) as counts, '
        'min("traceId") as first_trace from known_views group by all'
    ),
    "top1": (
        "select * from (select *, row_number() over "
        '(partition by cre_dtm, "memberId" order by counts desc, id, ml_mapping_id) as rn '
        "from member_counts) where rn = 1"
    ),
    "top_places": (
        'select "memberId", ml_mapping_id, counts, "traceId", etl_dtm, cre_dtm, id from '
        '(select t."memberId", t.ml_mapping_id, t.counts, v."traceId", '
        f"'{FIRST_RUN}.000000' as etl_dtm, t.cre_dtm, v.id, row_number() over "
        '(partition by t.cre_dtm, t."memberId" order by v."traceId") as vn '
        'from top1 t left join known_views v on v.cre_dtm = t.cre_dtm '
        'and v."memberId" = t."memberId" and v.ml_mapping_id = t.ml_mapping_id) where vn = 1'
    ),
    "pairs": 'select distinct "memberId", ml_mapping_id from top_places',
    "vectors": (
        "select cast(100000 + vec_id as varchar) as ml_mapping_id, "
        "cast(embedding as double[]) as v from embeddings"
    ),
    "seeds": "select distinct ml_mapping_id from top_places",
    "place_pairs": (
        "select a.ml_mapping_id, b.ml_mapping_id as cid, "
        "round(list_cosine_similarity(a.v, b.v), 9) as s from vectors a "
        "join vectors b on a.ml_mapping_id <> b.ml_mapping_id"
    ),
    "nearest": (
        "select ml_mapping_id, cid, s as score from (select *, row_number() over "
        "(partition by ml_mapping_id order by s desc, cid) as rn from place_pairs) where rn <= 5"
    ),
    "scored": (
        'select p."memberId", p.ml_mapping_id, s.cid, s.score from pairs p '
        "join nearest s on s.ml_mapping_id = p.ml_mapping_id"
    ),
    "recommendations": (
        'select r.cid, r."memberId", round(r.score, 6) as score, '
        'concat_ws(\'_\', r."traceId", cast(row_number() over '
        '(partition by r."traceId" order by r.score desc, r.cid) as varchar)) as "traceId", '
        'r.etl_dtm, r.cre_dtm, p.name from (select s.*, t."traceId", t.etl_dtm, t.cre_dtm '
        'from scored s left join top_places t on t."memberId" = s."memberId" '
        "and t.ml_mapping_id = s.ml_mapping_id) r left join places p on p.ml_mapping_id = r.cid"
    ),
    "popular": (
        'select cid, count(*) as "count" from recommendations group by cid '
        "order by 2 desc, 1 limit 5"
    ),
    "raw_lines": (
        'select "traceId", "memberId", "clientIp", url, method, "requestParam", request, '
        'response, "statusCode", "requestTime", "time" from logs union all '
        "select concat('d', cast(doc_id as varchar)), source, null, concat('/docs/', lang), "
        "null, null, null, text, null, null, n_chars from documents"
    ),
}
# Names a view may use, found once from its text.
_USES = {
    name: [other for other in _VIEWS if other != name and f" {other}" in f" {sql}"]
    for name, sql in _VIEWS.items()
}


def _with(sql: str) -> str:
    """``sql`` with the views it needs in front."""
    needed: set[str] = set()
    waiting = [name for name in _VIEWS if f" {name}" in sql]
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting += _USES[name]
    views = ", ".join(f"{name} as ({sql})" for name, sql in _VIEWS.items() if name in needed)
    return f"with {views} {sql}" if views else sql


_LAST_WEEK = "cre_dtm between '2024-01-24' and '2024-01-30'"
_THREE_DAYS = "cre_dtm in ('2024-01-03', '2024-01-15', '2024-01-29')"
_SHIFTED = (
    "strftime(ts + interval 9 hour, '%Y-%m-%dT%H:%M:%S') || "
    "case when microsecond(ts) % 1000000 = 0 then '' "
    "else strftime(ts, '.%f') end"
)
_UPSERTED = (
    f"select cre_dtm, \"count\", '{SECOND_RUN}.000000' as etl_dtm from created_again "
    f"where {_LAST_WEEK} union all "
    f"select cre_dtm, \"count\", '{FIRST_RUN}.000000' as etl_dtm from created "
    f"where not {_LAST_WEEK}"
)
_CATEGORY_LAST = (
    'select cre_dtm, category_id, category_name, "count", '
    "strftime(cast(cre_dtm as date) + 1, '%Y-%m-%d') || ' 00:00:00.000000' as etl_dtm from "
    "(select *, row_number() over (partition by category_id order by cre_dtm desc) as rn "
    "from categories) where rn = 1"
)
_PAGE_PATHS = (
    "select page_id, path, regexp_replace(path, '[?#].*', '') as bare from "
    "(select page_id, regexp_replace(url, '^https?://[^/]+', '') as path from pages)"
)


def _route_sql(path: str) -> tuple[str, str]:
    """SQL of the route and the id of a path, by its last segment."""
    trimmed = f"rtrim({path}, '/')"
    last = f"regexp_extract({trimmed}, '([^/]*)$', 1)"
    numeric = f"regexp_full_match({last}, '[0-9]+')"
    cut = (
        f"case when strpos({trimmed}, '/') = 0 then '/' "
        f"else left({trimmed}, length({trimmed}) - length({last})) end"
    )
    route = (
        f"case when {path} = '' then '_' when {numeric} then replace({cut}, '/', '_') "
        f"else replace({path}, '/', '_') end"
    )
    return route, f"case when {numeric} then {last} end"


_PATH_ROUTE, _PATH_ID = _route_sql("path")
_BARE_ROUTE, _BARE_ID = _route_sql("bare")
_LOG_FIELDS = (
    '"traceId", "memberId", "clientIp", url, method, "requestParam", request, response, '
    '"statusCode", "requestTime", "time"'
)
_FORMAT_FIELDS = (
    '"memberId", "clientIp", method, "requestParam", response, "statusCode", "requestTime", '
    "\"time\", case when f = 'json' then request else nullif(request, '') end as request"
)

_QUERIES = {
    "cleanse_logs": "select * from cleansed",
    "cleanse_logs_local_day": (
        f"select cast(event_id as varchar) as \"traceId\", {_SHIFTED} as \"requestTime\", "
        "cast(cast(ts + interval 9 hour as date) as varchar) as cre_dtm from events"
    ),
    "url_classify_pages": (
        f"select page_id, path, {_PATH_ROUTE} as url_part, {_PATH_ID} as path_id, "
        f"{_BARE_ROUTE} as bare_url_part, {_BARE_ID} as bare_path_id from ({_PAGE_PATHS})"
    ),
    "dedup_logs_latest": (
        'select "traceId", "memberId", url_part, "statusCode", cre_dtm, etl_dtm '
        "from deduplicated"
    ),
    "log_mart_rerun": "select * from deduplicated",
    "log_mart_moved_route": (
        "select * from cleansed where \"statusCode\" not in ('400', '500') union all "
        "select distinct * replace (null as \"traceId\", "
        f"'{SECOND_RUN}.000000' as etl_dtm) from cleansed where \"statusCode\" = '400' union all "
        "select * replace ('/moved/' || \"traceId\" as url, 'PUT' as method, "
        "'_moved_' as url_part, \"traceId\" as \"pathParam\", "
        f"'{SECOND_RUN}.000000' as etl_dtm) from cleansed where \"statusCode\" = '500'"
    ),
    "created_group_counting": (
        f"select cre_dtm, \"count\", '{FIRST_RUN}.000000' as etl_dtm from created"
    ),
    "upsert_group_counts": _UPSERTED,
    "top_application_groups": (
        f"select *, '{FIRST_RUN}.000000' as etl_dtm from applications"
    ),
    "application_mart_rerun": (
        "select *, case when cre_dtm between '2024-01-16' and '2024-01-30' "
        f"then '{SECOND_RUN}.000000' else '{FIRST_RUN}.000000' end as etl_dtm from applications "
        "where cre_dtm between '2024-01-01' and '2024-01-30'"
    ),
    "top_group_categories": f"select *, '{FIRST_RUN}.000000' as etl_dtm from categories",
    "category_latest_any_day": _CATEGORY_LAST,
    "category_mart_any_day": _CATEGORY_LAST,
    "cleanse_applications": (
        "select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as requesttime, "
        "cast(user_id as int) as memberid, cast(100 + user_id % 900 as int) as groupadminid, "
        "cast(100 + k as int) as applicationid, variant from numbered, "
        "(values ('key'), ('offset')) v(variant) where event_type = 'click'"
    ),
    "member_place_counts": "select * from member_counts",
    "place_views_known": (
        'select cre_dtm, "memberId", "traceId", id, ml_mapping_id, cast(1 as bigint) as copies '
        "from known_views"
    ),
    "member_top_place": "select * from top_places",
    "member_top_place_of_counts": "select * from top_places",
    "distinct_member_places": "select * from pairs",
    "similar_places_topk": (
        "select ml_mapping_id, cid, round(score, 6) as score from nearest"
    ),
    "scored_by_fixed_answer": (
        "select p.*, cast(100000 + k as varchar) as cid, round(1.0 / k, 6) as score "
        "from pairs p, range(1, 6) a(k)"
    ),
    "answers_from_store": (
        "select p.*, case when cast(\"memberId\" as bigint) % 2 = 0 then 'early' else 'late' end "
        "|| cast(k as varchar) as cid, 1.0 / k as score from pairs p, range(1, 3) a(k)"
    ),
    "explode_recommendations": (
        'select "memberId", ml_mapping_id, cid, round(score, 6) as score from scored'
    ),
    "member_place_recommend": "select * from recommendations",
    "latest_recommendation_per_member": (
        'select "memberId", cid, cre_dtm, '
        "strftime(cast(cre_dtm as date) + 1, '%Y-%m-%d') || ' 00:00:00.000000' as etl_dtm from "
        '(select t."memberId", t.cre_dtm, s.cid, row_number() over '
        '(partition by t."memberId" order by t.cre_dtm desc, s.cid) as rn '
        'from top_places t join scored s on s."memberId" = t."memberId" '
        "and s.ml_mapping_id = t.ml_mapping_id) where rn = 1"
    ),
    "recommendations_for_members": (
        'select r."memberId", p.id, r.cid, r.score, i.image_path from recommendations r '
        'left join places p on p.ml_mapping_id = r.cid join images i on i.id = p.id '
        'where r."memberId" in (select "memberId" from members)'
    ),
    "recommendations_of_one_member": (
        'select r."memberId", r.cid, r.score, p.id, p.name from recommendations r '
        "left join places p on p.ml_mapping_id = r.cid where r.\"memberId\" = '7'"
    ),
    "recommendations_in_order": (
        "select *, row_number() over (partition by cre_dtm order by \"memberId\" nulls first, "
        'cid nulls first, etl_dtm, name nulls first, score, "traceId") as position '
        "from recommendations"
    ),
    "recounted_days": (
        f"select cre_dtm, \"count\", '{SECOND_RUN}.000000' as etl_dtm from created_again "
        f"where {_THREE_DAYS} union all "
        f"select cre_dtm, \"count\", '{FIRST_RUN}.000000' as etl_dtm from created "
        f"where not {_THREE_DAYS}"
    ),
    "most_recommended": "select * from popular",
    "popular_fallback": (
        'select m."memberId", p.cid, p."count" from members m, popular p where m."memberId" '
        'not in (select "memberId" from recommendations)'
    ),
    "recommendations_or_popular": (
        'select "memberId", cid, score, null::bigint as "count" from recommendations '
        'where "memberId" in (select "memberId" from members) union all '
        'select m."memberId", p.cid, null, p."count" from members m, popular p '
        'where m."memberId" not in (select "memberId" from recommendations)'
    ),
    "places_or_popular": (
        'select r."memberId", p.id, r.cid, r.score, r."count", i.image_path from '
        '(select "memberId", cid, score, null::bigint as "count" from recommendations '
        'where "memberId" in (select "memberId" from members) union all '
        'select m."memberId", p.cid, null, p."count" from members m, popular p '
        'where m."memberId" not in (select "memberId" from recommendations)) r '
        "join places p on p.ml_mapping_id = r.cid join images i on i.id = p.id"
    ),
    "recommendation_coverage": (
        'select "memberId", count(*) as "count" from recommendations where name is not null '
        'and "traceId" is not null group by "memberId"'
    ),
    "period_window": (
        f"select *, '{FIRST_RUN}.000000' as etl_dtm from categories where {_LAST_WEEK}"
    ),
    "query_partition": (
        'select url_part, method, count(*) as requests, count(distinct "memberId") as members '
        "from cleansed where cre_dtm = '2024-01-15' group by url_part, method"
    ),
    "route_of_day": (
        'select "traceId", "memberId", "statusCode", cre_dtm, url_part, method from cleansed '
        "where cre_dtm = '2024-01-15' and url_part = '_api_v1_group' and method = 'POST'"
    ),
    "day_folder_logs": (
        f"select {_LOG_FIELDS} from logs where \"requestTime\" like '2024-01-15%'"
    ),
    "day_folder_wrapped": (
        f"select {_LOG_FIELDS}, null::varchar as \"brokenLine\" from logs "
        "where \"requestTime\" like '2024-01-15%' and \"statusCode\" <> '500' union all "
        "select null, null, null, null, null, null, null, null, null, null, null, "
        "'{broken ' || \"traceId\" from logs "
        "where \"requestTime\" like '2024-01-15%' and \"statusCode\" = '500'"
    ),
    "json_glob_logs": f"select {_LOG_FIELDS} from logs",
    "salvage_raw_logs": (
        "select * from raw_lines where not contains(url, '/admin') "
        "and not contains(coalesce(response, ''), '/admin')"
    ),
    "salvage_payloads": (
        'select "traceId", response from logs where not contains(url, \'/admin\') '
        "and not contains(response, '/admin') and \"statusCode\" not in ('201', '400')"
    ),
    "salvage_single_line": (
        'select "traceId", url from raw_lines where not contains(url, \'/admin\') '
        "and not contains(coalesce(response, ''), '/admin') "
        "and not contains(coalesce(response, ''), chr(10))"
    ),
    "salvage_through_csv": (
        "select * replace (nullif(request, '') as request) from logs "
        "where not contains(url, '/admin')"
    ),
    "csv_quarantine": (
        'select "traceId", "memberId", "time", null::varchar as "brokenLine" from logs '
        "where \"statusCode\" <> '500' union all "
        "select null, null, null, \"traceId\" || ',' || \"memberId\" || ',n/a' from logs "
        "where \"statusCode\" = '500'"
    ),
    "shift_request_time": (
        f"select cast(event_id as varchar) as \"traceId\", {_SHIFTED} as \"requestTime\" "
        "from events"
    ),
    "rejected_request_times": (
        "select case when l.\"statusCode\" = '500' then 'rejected' else 'kept' end as part, "
        'l."traceId", case when l."statusCode" = \'500\' then left(l."requestTime", 19) '
        f"when l.\"statusCode\" <> '201' then {_SHIFTED} end as \"requestTime\" "
        'from logs l join events e on cast(e.event_id as varchar) = l."traceId"'
    ),
    "place_visits_total": 'select cast(count(*) as bigint) as "total" from known_views',
    "wrapped_json_lines": f"select {_LOG_FIELDS} from logs",
    "format_roundtrip": (
        f"select f as \"format\", \"traceId\", {_FORMAT_FIELDS} from logs, "
        "(values ('json'), ('csv'), ('csv_inferred')) v(f)"
    ),
    "place_csv_numeric_ids": "select * from places where try_cast(id as bigint) is not null",
    "partition_replace": _UPSERTED,
    "recommendation_mart_replace": "select * from recommendations",
    "recommendation_day_replace": (
        f"select * from recommendations where cre_dtm <> '{LAST_DAY}'"
    ),
    "schema_json": (
        "select key as name, "
        "case (s ->> key) when 'VARCHAR' then 'string' else 'long' end as type "
        "from (select s, unnest(json_keys(s)) as key from (select json_group_structure("
        "to_json(l)) as s from logs l)) where (s ->> key) <> 'NULL'"
    ),
    "column_json_schema": (
        "select 'OBJECT<' || key || ': BIGINT>' as json_schema from (select s, "
        "unnest(json_keys(s)) as key from (select json_group_structure(cast(props as json)) as s "
        "from events)) "
        "where (s ->> key) in ('UBIGINT', 'BIGINT')"
    ),
    "html_payloads": (
        "select doc_id as page_id, text as body from documents where text is not null "
        "and not starts_with(text, '<!DOCTYPE html>') union all "
        "select page_id, html from pages where html is not null "
        "and not starts_with(html, '<!DOCTYPE html>')"
    ),
}

ORACLES = {name: _with(sql) for name, sql in _QUERIES.items()}
assert LAST_DAY == "2024-01-30", "the week in _LAST_WEEK has to end on LAST_DAY"
