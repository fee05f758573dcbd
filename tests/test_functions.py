from datetime import date

import pytest
from pyspark.sql import functions as F

from trailmart.functions import payloads, text, times, urls


def one_column(spark, values, build):
    """The values of an expression over a column ``v``, in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


URLS = [
    ("/api/v1/place/12/", "_api_v1_place_", "12"),
    ("/api/v1/place/12", "_api_v1_place_", "12"),
    ("/api/v1/group", "_api_v1_group", None),
    ("/api/v1/group/", "_api_v1_group_", None),
    ("/", "_", None),
    ("", "_", None),
    ("123", "_", "123"),
    ("/12", "_", "12"),
    ("//12", "__", "12"),
    ("/a//12", "_a__", "12"),
    ("/a/12//", "_a_", "12"),
    ("/a/12/b", "_a_12_b", None),
    ("/a/12/34", "_a_12_", "34"),
    ("/a/b12", "_a_b12", None),
    ("/a/12?x=1", "_a_12?x=1", None),
    ("/a/１２", "_a_１２", None),
    ("/a/12\n", "_a_12\n", None),
    (None, None, None),
]


def test_url_classifier(spark):
    paths = [u[0] for u in URLS]
    assert one_column(spark, paths, urls.url_part) == [u[1] for u in URLS]
    assert one_column(spark, paths, urls.path_id) == [u[2] for u in URLS]


def test_url_classifier_against_segments(spark):
    """The same rule, told by path segments."""
    pieces = ["", "/", "a", "7", "42", "/9", "b/", "//", "3x"]
    paths = [x + y + z for x in pieces for y in pieces for z in pieces if x + y + z]

    def model(path):
        segments = path.rstrip("/").split("/")
        if segments[-1].isdigit():
            return "_".join(segments[:-1]) + "_", segments[-1]
        return path.replace("/", "_"), None

    routes = one_column(spark, paths, urls.url_part)
    ids = one_column(spark, paths, urls.path_id)
    assert list(zip(routes, ids, strict=True)) == [model(p) for p in paths]


def test_empty_path_can_stay_empty(spark):
    assert one_column(spark, ["", "/a/1"], lambda c: urls.url_part(c, False)) == ["", "_a_"]


def test_strip_origin(spark):
    values = ["http://h:9090/a/1", "https://h/a", "http://h", "/a", "ftp://h/a", None]
    assert one_column(spark, values, urls.strip_origin) == [
        "/a/1", "https://h/a", "", "/a", "ftp://h/a", None,
    ]
    assert one_column(spark, values, lambda c: urls.strip_origin(c, https=True))[1] == "/a"


def test_strip_query(spark):
    assert one_column(spark, ["/a?x=1#y", "/a#b", "/a/1", "/a?x\ny"], urls.strip_query) == [
        "/a", "/a", "/a/1", "/a",
    ]


def test_log_date(spark):
    values = ["2024-12-20T07:08:42.417937061", "xx", None, "2024-12-20"]
    assert one_column(spark, values, times.log_date) == [
        date(2024, 12, 20), None, None, date(2024, 12, 20),
    ]


SHIFTS = [
    ("2024-12-20T07:08:42.417937061", "2024-12-20T16:08:42.417937"),
    ("2024-12-31T15:00:00.5", "2025-01-01T00:00:00.500000"),
    ("2024-12-20T07:08:42.000000", "2024-12-20T16:08:42"),
    ("2024-12-20T07:08:42.0000009", "2024-12-20T16:08:42"),
    ("2024-12-20T07:08:42", None),
    ("2024-12-20T07:08:42.", None),
    ("2024-12-20T07:08:42.12x", None),
    ("2024-13-20T07:08:42.1", None),
    ("2024-12-20 07:08:42.1", None),
    ("text", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_shift_iso(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    assert one_column(spark, [s[0] for s in SHIFTS], lambda c: times.shift_iso(c, 9)) == [
        s[1] for s in SHIFTS
    ]
    # Two hours that do not exist, or exist twice, in some of the zones.
    days = ["2024-03-10T02:30:00.1", "2024-11-03T01:30:00.1"]
    assert one_column(spark, days, lambda c: times.shift_iso(c, 0)) == [
        "2024-03-10T02:30:00.100000", "2024-11-03T01:30:00.100000",
    ]


def test_shift_back(spark):
    assert one_column(spark, ["2024-01-01T00:30:00.25"], lambda c: times.shift_iso(c, -1)) == [
        "2023-12-31T23:30:00.250000"
    ]


def test_application_request(spark):
    values = [
        "", "{bad", '{"groupId":"12"}', '{"groupId":12,"memberId":"x"}', "[1]",
        '{"memberId": 4, "groupId": 9}', None,
    ]
    groups = one_column(
        spark, values, lambda c: payloads.application_request(c).getField("groupId")
    )
    assert groups == [None, None, None, 12, None, 9, None]


def test_group_categories(spark):
    values = ['{"categories":[{"id":1,"name":"a"}]}', '{"categories":[]}', "{}", "", None]
    first, *rest = one_column(spark, values, payloads.group_categories)
    assert [tuple(c) for c in first] == [(1, "a", None)]
    assert rest == [[], None, None, None]


def test_place_payload(spark):
    value = '{"id": 5, "latitude": 1.5, "categoryNames": ["a", "b"], "name": "n"}'
    (row,) = one_column(spark, [value], payloads.place)
    assert (row.id, row.name, row.latitude, row.categoryNames, row.images) == (
        5, "n", 1.5, ["a", "b"], None,
    )


def test_numbers_in_text(spark):
    assert one_column(spark, ["12", "x", None, "1.5"], payloads.as_int) == [12, None, None, None]
    assert one_column(
        spark, ["ab123cd", "ab12", "abxyz"], lambda c: payloads.fixed_offset_int(c, 3)
    ) == [123, 12, None]


def test_json_in_text(spark):
    values = ["x {a {b} c} y", "none", 'x {"a":\n1} y', "}{", None]
    assert one_column(spark, values, text.json_object) == [
        "{a {b} c}", None, '{"a":\n1}', None, None,
    ]
    assert one_column(spark, values, text.json_object_of_line) == [
        "{a {b} c}", "", "", "", None,
    ]


def test_unescape_newlines(spark):
    assert one_column(spark, ["a\\nb", "a\nb", "a\\tb"], text.unescape_newlines) == [
        "a\nb", "a\nb", "a\\tb",
    ]


def test_is_payload(spark):
    values = ["{}", "<!DOCTYPE html><p>", " <!DOCTYPE html>", "", None]
    assert one_column(spark, values, text.is_payload) == [True, False, True, True, False]


def test_unwrap_json_string(spark):
    values = ['"{\\"a\\": \\"x\\\\\\"y\\"}"', '{"a": 1}', ' "{}"', "", None]
    assert one_column(spark, values, text.unwrap_json_string) == [
        '{"a": "x\\"y"}', '{"a": 1}', "{}", "", None,
    ]
