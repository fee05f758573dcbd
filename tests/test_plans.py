import json
from collections import Counter, defaultdict
from datetime import date

from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.operators import scores
from trailmart.plans import aggregates, cleansing, convert, recommend, serving
from trailmart.sources import marts

RUN = "2024-02-01 00:00:00"


def raw(spark, *logs):
    rows = [tuple(log.get(f) for f in schemas.RAW_LOG_FIELDS) for log in logs]
    return spark.createDataFrame(rows, schemas.RAW_LOG)


def request(n, url, method="GET", status="200", day="2024-01-01", member="1", **rest):
    return {
        "traceId": f"t{n:03}", "memberId": member, "url": f"http://h:1{url}", "method": method,
        "statusCode": status, "requestTime": f"{day}T10:00:00.5", **rest,
    }


def cleansed(spark, *logs):
    return cleansing.cleanse_logs(raw(spark, *logs), RUN)


def test_cleanse_logs(spark):
    df = cleansed(spark, request(1, "/a/12"), request(2, ""), {"traceId": "t003"})
    assert df.columns == schemas.RAW_LOG_FIELDS + ["url_part", "pathParam", "cre_dtm", "etl_dtm"]
    rows = [(r.url, r.url_part, r.pathParam, r.cre_dtm) for r in df.orderBy("traceId").collect()]
    assert rows == [
        ("/a/12", "_a_", "12", date(2024, 1, 1)), ("", "_", None, date(2024, 1, 1)), (None,) * 4,
    ]
    assert "Exchange" not in df._jdf.queryExecution().toString()
    assert "Python" not in df._jdf.queryExecution().toString()


def test_cleanse_logs_options(spark):
    log = {**request(1, "/a/12?x=1"), "url": "https://h/a/12?x=1", "requestTime": "2024-01-01T20:00:00.5"}
    row = cleansing.cleanse_logs(
        raw(spark, log), RUN, utc_offset_hours=9, strip_https=True, drop_query=True
    ).first()
    assert (row.url, row.url_part, row.pathParam) == ("/a/12?x=1", "_a_", "12")
    assert (row.cre_dtm, row.requestTime) == (date(2024, 1, 2), "2024-01-02T05:00:00.500000")


def test_log_mart_can_be_loaded_again(spark, folder):
    path = f"{folder}/mart"
    logs = [request(n, "/a/1", day=f"2024-01-0{1 + n % 3}") for n in range(9)]
    for run in (RUN, "2024-02-02 00:00:00"):
        cleansing.load_log_mart(spark, cleansing.cleanse_logs(raw(spark, *logs), run), path)
    read = marts.read_mart(spark, path, schemas.CLEANSED_LOG)
    assert Counter(r.traceId for r in read.collect()) == Counter(log["traceId"] for log in logs)
    assert {str(r.etl_dtm) for r in read.collect()} == {"2024-02-02 00:00:00"}


def test_created_groups(spark):
    logs = [
        request(1, "/api/v1/group", "POST", "201"), request(2, "/api/v1/group", "POST", "400"),
        request(3, "/api/v1/group", "POST", "n/a"), request(4, "/api/v1/group", "GET", "201"),
        request(5, "/api/v1/group", "POST", "201", day="2024-01-02"),
    ]
    df = cleansed(spark, *logs)
    counts = aggregates.created_group_counting(df, RUN)
    assert sorted((str(r.cre_dtm), r["count"]) for r in counts.collect()) == [("2024-01-01", 1), ("2024-01-02", 1)]
    assert aggregates.created_group_counting(df, RUN, day="2024-01-02").count() == 1


def test_applications_per_group(spark):
    bodies = ['{"memberId": 1, "groupId": 7}'] * 2 + ['{"groupId": 8}', "{broken", ""]
    logs = [request(n, "/api/v1/application", "POST", request=b) for n, b in enumerate(bodies)]
    counts = aggregates.top_application_groups(cleansed(spark, *logs), RUN)
    assert [(r.group_id, r["count"]) for r in aggregates.by_count(counts, "group_id").collect()] == [
        (None, 2), (7, 2), (8, 1),
    ]


def test_category_picks(spark):
    def body(*ids):
        return json.dumps({"categories": [{"id": i, "name": f"c{i}"} for i in ids]})

    bodies = [body(1, 2), body(1), body(), "{}", "", "{broken"]
    logs = [request(n, "/api/v1/group", "POST", "400", response=b) for n, b in enumerate(bodies)]
    counts = aggregates.top_group_categories(cleansed(spark, *logs), RUN)
    assert sorted((r.category_id, r.category_name, r["count"]) for r in counts.collect()) == [
        (1, "c1", 2), (2, "c2", 1),
    ]


def test_aggregate_mart_rerun(spark, folder):
    logs = [request(n, "/api/v1/group", "POST", "201", day=f"2024-01-0{n}") for n in (1, 2)]
    df = cleansed(spark, *logs)
    path = f"{folder}/counts"
    for run in (RUN, "2024-02-02 00:00:00"):
        for day in ("2024-01-01", "2024-01-02"):
            counts = aggregates.created_group_counting(df, run, day)
            aggregates.load_aggregate(spark, counts, path, aggregates.GROUP_COUNT_KEYS)
    rows = marts.read_mart(spark, path, schemas.GROUP_COUNTING).collect()
    assert sorted((str(r.cre_dtm), r["count"], str(r.etl_dtm)) for r in rows) == [
        ("2024-01-01", 1, "2024-02-02 00:00:00"), ("2024-01-02", 1, "2024-02-02 00:00:00"),
    ]


def test_shift_request_time(spark):
    logs = [request(1, "/a"), {**request(2, "/a"), "requestTime": "bad"}, {**request(3, "/a"), "requestTime": None}]
    kept, rejected = cleansing.shift_request_time(raw(spark, *logs))
    assert sorted((r.traceId, r.requestTime) for r in kept.collect()) == [
        ("t001", "2024-01-01T19:00:00.500000"), ("t003", None),
    ]
    assert [(r.traceId, r.requestTime) for r in rejected.collect()] == [("t002", "bad")]


def test_cleanse_applications(spark):
    logs = [
        request(1, "/x", request='{"groupAdminId":123,   "applicationId":456}', member="9"),
        request(2, "/x", request='{"groupAdminId":123}', member="9"),
        request(3, "/x", request='{"groupAdminId":123,   "applicationId":456}', member="x"),
    ]
    for fixed in (False, True):
        (row,) = cleansing.cleanse_applications(raw(spark, *logs), fixed).collect()
        assert (row.memberid, row.groupadminid, row.applicationid) == (9, 123, 456)
        assert str(row.requesttime) == "2024-01-01 10:00:00.500000"


def test_salvage(spark):
    body = json.dumps({"traceId": "1", "url": "/a", "response": "two\nlines"})
    lines = [f"INFO {body} end", "no json", "GET /admin {}", None, "<!DOCTYPE html>{}", '{"traceId": "2"}']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = cleansing.parse_salvaged(cleansing.salvage_json(df)).collect()
    assert sorted(((r.traceId or ""), r.response) for r in rows) == [
        ("", None), ("1", "two\nlines"), ("2", None),
    ]


def places(spark, *rows):
    full = [(i, m, n, *[None] * 5) for i, m, n in rows]
    return spark.createDataFrame(full, schemas.PLACE)


def view(n, member, place, day="2024-01-01"):
    return request(n, f"/api/v1/place/{place}", member=member, day=day, response=json.dumps({"id": place}))


def plain_top_places(views, mapping):
    """The favourite place told step by step: join, count, rank, join back, keep the first."""
    known = [(d, m, t, p, ml) for d, m, t, p in views for i, ml in mapping if i == str(p)]
    counts = Counter((d, m, ml, p) for d, m, _, p, ml in known)
    out = {}
    for (d, m, ml, p), n in counts.items():
        best = out.get((d, m))
        if best is None or (-n, p, ml) < best:
            out[d, m] = (-n, p, ml)
    result = {}
    for (d, m), (n, _, ml) in out.items():
        trace, place = min((t, p) for dd, mm, t, p, mml in known if (dd, mm, mml) == (d, m, ml))
        result[d, m] = (ml, -n, trace, place)
    return result


def test_top_place_against_the_plain_steps(spark):
    import random

    rng = random.Random(11)
    logs, views = [], []
    for n in range(600):
        member = "busy" if n % 3 == 0 else f"m{rng.randint(0, 20)}"
        place, day = rng.randint(0, 9), f"2024-01-0{rng.randint(1, 3)}"
        logs.append(view(n, member, place, day))
        views.append((day, member, f"t{n:03}", place))
    # Two places share a mapping, one has two mappings, one is listed twice, some are unknown.
    mapping = [("1", "A"), ("2", "A"), ("3", "B"), ("3", "C"), ("4", "D"), ("4", "D"), ("x5", "E"), ("6", "F")]
    dimension = places(spark, *[(i, ml, "n") for i, ml in mapping])
    counts = recommend.member_place_counts(cleansed(spark, *logs), dimension)
    top = recommend.member_top_place(counts, RUN).collect()
    assert {
        (str(r.cre_dtm), r.memberId): (r.ml_mapping_id, r.counts, r.traceId, r.id) for r in top
    } == plain_top_places(views, mapping)
    two_steps = recommend.top_places(cleansed(spark, *logs), dimension, RUN)
    assert sorted(map(tuple, two_steps.collect())) == sorted(map(tuple, top))
    # Views are counted without a sort.
    plan = two_steps._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_top_places_of_views_without_a_trace(spark):
    logs = [{**view(n, "1", 1 + n % 2), "traceId": None if n % 2 else f"t{n}"} for n in range(5)] + [{**view(9, "2", 1), "traceId": None}]
    logs += [{**view(7, "3", 2), "requestTime": None}, view(8, None, 1)]
    dimension = places(spark, ("1", "A", "a"), ("2", "A", "a"))
    df = cleansed(spark, *logs)
    one = recommend.member_top_place(recommend.member_place_counts(df, dimension), RUN).collect()
    two = recommend.top_places(df, dimension, RUN).collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 3


def test_recommendations_end_to_end(spark, folder):
    logs = [view(1, "1", 1), view(2, "1", 1), view(3, "1", 2), view(4, "2", 2), view(5, "3", 9)]
    dimension = places(spark, ("1", "A", "a"), ("2", "B", "b"), ("3", "X", "x"))
    top = recommend.member_top_place(
        recommend.member_place_counts(cleansed(spark, *logs), dimension), RUN
    )
    answers = scores.score_members(top, scores.fixed_scorer([{"X": 0.5, "?": 0.9}, {"B": 0.5}]), 4)
    rows = recommend.member_place_recommend(top, answers, dimension)
    assert rows.columns == ["cid", "memberId", "score", "traceId", "etl_dtm", "cre_dtm", "name"]
    want = [("?", 0.9, 1, None), ("B", 0.5, 2, "b"), ("X", 0.5, 3, "x")]
    assert sorted((r.memberId, r.traceId, r.cid, r.score, r.name) for r in rows.collect()) == sorted(
        (m, f"{t}_{n}", cid, s, name) for m, t in [("1", "t001"), ("2", "t004")] for cid, s, n, name in want
    )


def test_members_sharing_a_trace_get_unique_ids(spark):
    top = spark.createDataFrame(
        [(f"m{n}", "A", 1, None if n % 2 else "same", RUN, "2024-01-01", 1) for n in range(60)],
        "memberId string, ml_mapping_id string, counts bigint, traceId string, etl_dtm string, cre_dtm string, id bigint",
    ).withColumns({"etl_dtm": F.col("etl_dtm").cast("timestamp"), "cre_dtm": F.to_date("cre_dtm")})
    answers = scores.score_members(top, scores.fixed_scorer([{"X": 0.5, "Y": 0.9}]), 4)
    rows = recommend.member_place_recommend(top, answers, places(spark)).collect()
    ids = defaultdict(list)
    for r in rows:
        ids[r.traceId.startswith("same_")].append(int(r.traceId.split("_")[-1]))
    assert sorted(ids[True]) == sorted(ids[False]) == list(range(1, 61))


def test_the_same_recommendations_for_any_partitioning(spark, conf):
    logs = [view(n, str(n % 17), n * 7 % 5, f"2024-01-0{1 + n % 3}") for n in range(300)]
    dimension = places(spark, *[(str(i), f"p{i}", f"n{i}") for i in range(5)])
    seen = set()
    for parts in ("1", "7"):
        conf("spark.sql.shuffle.partitions", parts)
        df = cleansed(spark, *logs).repartition(int(parts))
        top = recommend.member_top_place(recommend.member_place_counts(df, dimension), RUN)
        answers = scores.score_members(top, scores.fixed_scorer([{"p1": 0.5, "p2": 0.5}]), 3)
        rows = recommend.member_place_recommend(top, answers, dimension).collect()
        seen.add(tuple(sorted(map(tuple, rows), key=str)))
    assert len(seen) == 1


REC = "cid string, memberId string, score double"


def test_lookup_and_fallback(spark):
    recs = spark.createDataFrame([("A", "1", 0.5), ("B", "1", 0.4), ("?", "1", 0.3), ("B", "2", 0.2)], REC)
    dimension = places(spark, ("10", "A", "a"), ("20", "B", "b"))
    images = spark.createDataFrame([("10", "i1"), ("10", "i2"), ("30", "i3")], "id string, image_path string")
    wanted = spark.createDataFrame([("1",), ("9",)], "memberId string")
    found = serving.recommendations_for_members(recs, wanted, dimension, images)
    assert sorted(map(tuple, found.collect())) == [("1", "10", "A", 0.5, "i1"), ("1", "10", "A", 0.5, "i2")]
    by_other_key = images.withColumnRenamed("id", "place_id")
    again = serving.recommendations_for_members(recs, wanted, dimension, by_other_key, "place_id")
    assert again.count() == 2
    fallback = serving.popular_fallback(recs, wanted, 2)
    assert sorted(map(tuple, fallback.collect())) == [("9", "?", 1), ("9", "B", 2)]
    assert "CartesianProduct" not in fallback._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in fallback._jdf.queryExecution().toString()


def test_fallback_without_any_recommendation(spark):
    wanted = spark.createDataFrame([("1",)], "memberId string")
    assert serving.popular_fallback(spark.createDataFrame([], REC), wanted).count() == 0


def test_coverage(spark):
    recs = spark.createDataFrame([("A", "1", 0.5), ("B", "1", None), ("C", "2", 0.1)], REC)
    assert sorted(map(tuple, serving.recommendation_coverage(recs).collect())) == [("1", 1), ("2", 1)]


def test_latest_per_member(spark):
    rows = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 1)], "memberId string, cid string, etl_dtm int")
    assert sorted(r.cid for r in recommend.latest_per_member(rows).collect()) == ["b", "c"]


def test_conversions(spark, tmp_path):
    log = {"traceId": "1", "url": "http://h/a", "method": "GET", "request": '{"a": "x, y"}'}
    (tmp_path / "a.json").write_text(json.dumps(log))
    convert.json_to_parquet(spark, f"{tmp_path}/a.json", f"{tmp_path}/pq")
    (row,) = marts.read_mart(spark, f"{tmp_path}/pq").collect()
    assert (row.url, row.method, row.request) == ("/a", "GET", '{"a": "x, y"}')
    convert.json_to_csv(spark, f"{tmp_path}/a.json", f"{tmp_path}/csv")
    convert.csv_to_parquet(spark, f"{tmp_path}/csv", f"{tmp_path}/pq2")
    (row,) = spark.read.parquet(f"{tmp_path}/pq2").collect()
    assert (row.traceId, row.url, row.request) == (1, "http://h/a", '{"a": "x, y"}')


def test_a_request_that_moves_leaves_no_old_row(spark, folder):
    def load(url, method, run_ts):
        raw = spark.createDataFrame(
            [("t1", url, method, "2024-01-02T03:04:05Z"), ("t2", "/b", "GET", "2024-01-02T03:04:05Z")],
            "traceId string, url string, method string, requestTime string",
        )
        clean = cleansing.cleanse_logs(raw, run_ts)
        cleansing.load_log_mart(spark, clean, f"{folder}/mart")

    load("/a", "GET", "2024-01-03 01:00:00")
    load("/z", "PUT", "2024-01-03 02:00:00")
    rows = marts.read_mart(spark, f"{folder}/mart").select("traceId", "url_part", "method").collect()
    assert sorted(map(tuple, rows)) == [("t1", "_z", "PUT"), ("t2", "_b", "GET")]


def test_requests_without_an_id_all_stay(spark):
    raw = spark.createDataFrame(
        [(None, "/a"), (None, "/b"), ("t", "/c"), ("t", "/c")], "traceId string, url string"
    ).selectExpr("*", "timestamp'2024-01-03' as etl_dtm")
    assert cleansing.dedup_logs(raw).count() == 3


def test_a_mart_keeps_requests_without_an_id_once(spark, folder):
    logs = [{**request(n, f"/a/{n}"), "traceId": None} for n in range(4)]
    for run_ts in (RUN, "2024-02-02 00:00:00"):
        clean = cleansing.cleanse_logs(raw(spark, *logs, request(9, "/b")), run_ts)
        cleansing.load_log_mart(spark, clean, f"{folder}/mart")
    rows = marts.read_mart(spark, f"{folder}/mart", schemas.CLEANSED_LOG).collect()
    assert sorted(r.url for r in rows) == ["/a/0", "/a/1", "/a/2", "/a/3", "/b"]
    assert {str(r.etl_dtm) for r in rows} == {"2024-02-02 00:00:00"}


def test_places_beyond_32_bits_are_known(spark):
    places = spark.createDataFrame([("3000000000", "m", "n")], "id string, ml_mapping_id string, name string")
    assert [r.id for r in recommend.place_mapping(places).collect()] == [3_000_000_000]


def test_numbers_of_a_shared_request_follow_the_score(spark):
    tops = [("m1", "p1", "t"), ("m2", "p2", "t"), ("m3", "p3", "u")]
    top_places = spark.createDataFrame(tops, "memberId string, ml_mapping_id string, traceId string").selectExpr(
        "*", f"timestamp'{RUN}' as etl_dtm", "date'2024-01-01' as cre_dtm"
    )
    answers = spark.createDataFrame(
        [("m1", "p1", [{"a": 0.1, "b": 0.8}]), ("m2", "p2", [{"a": 0.5, "c": 0.8}]), ("m3", "p3", [{"a": 0.2}])],
        schemas.SCORER_ANSWER,
    )
    places = spark.createDataFrame([("a", "n")], "ml_mapping_id string, name string")
    rows = recommend.member_place_recommend(top_places, answers, places).collect()
    assert sorted((r.traceId, r.memberId, r.cid) for r in rows) == [
        ("t_1", "m1", "b"), ("t_2", "m2", "c"), ("t_3", "m2", "a"), ("t_4", "m1", "a"), ("u_1", "m3", "a"),
    ]


def test_odd_vectors_do_not_disturb_others(spark):
    good = [(f"g{k}", [float(k), 1.0]) for k in range(9)]
    odd = [("inf", [float("inf"), 1.0]), ("nan", [float("nan"), 1.0]), ("null", None),
           ("hole", [None, 1.0]), ("long", [1.0, 1.0, 1.0]), ("zero", [0.0, 0.0])]
    items = spark.createDataFrame(good + odd, "ml_mapping_id string, embedding array<double>")
    plain = spark.createDataFrame(good, items.schema)

    def near(seeds, frame, rows):
        got = scores.similar_places(seeds, frame, block_rows=rows).collect()
        return sorted(map(tuple, got))

    expected = near(plain, plain, 4096)
    assert len(expected) == 9 * 5
    assert near(items, items, 4096) == near(items, items, 2) == expected
    one = plain.filter("ml_mapping_id = 'g3'")
    assert near(one, items, 2) == [r for r in expected if r[0] == "g3"]
