import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.plans import convert
from trailmart.sinks import files as sinks
from trailmart.sources import files, jdbc, logs, marts


def log_line(**fields):
    return json.dumps({"traceId": "t", "url": "http://h/a", "method": "GET", **fields})


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines))
    return str(path)


def test_broken_line_gives_a_null_row(spark, tmp_path):
    path = write(tmp_path / "a.json", log_line(traceId="1", time=5, extra=1), "{broken", log_line(traceId="2"))
    df = logs.read_logs(spark, path)
    assert df.columns == schemas.RAW_LOG_FIELDS
    assert sorted(df.collect(), key=str) == sorted(
        [("1", None, None, "http://h/a", "GET", *[None] * 5, 5), ("2", None, None, "http://h/a", "GET", *[None] * 6), (None,) * 11],
        key=str,
    )


def test_no_paths_give_no_rows(spark):
    df = logs.read_logs(spark, [])
    assert df.columns == schemas.RAW_LOG_FIELDS and df.count() == 0


def test_glob_and_list_of_paths(spark, tmp_path):
    a = write(tmp_path / "d1" / "a.json", log_line(traceId="1"))
    b = write(tmp_path / "d2" / "b.json", log_line(traceId="2"))
    assert logs.read_logs(spark, f"{tmp_path}/d*/*.json").count() == 2
    assert logs.read_logs(spark, [a, b]).count() == 2


def test_day_folder(spark, tmp_path, caplog):
    write(tmp_path / "2024-01-01" / "a.json", log_line(traceId="1"))
    write(tmp_path / "2024-01-01" / "part" / "b.json", log_line(traceId="2"))
    write(tmp_path / "2024-01-01" / "c.txt", log_line(traceId="3"))
    write(tmp_path / "2024-01-02" / "c.txt", log_line(traceId="4"))
    found = logs.read_log_day(spark, f"{tmp_path}/", "2024-01-01")
    assert sorted(r.traceId for r in found.collect()) == ["1", "2"]
    assert logs.read_log_day(spark, str(tmp_path), "2024-01-02").count() == 0
    missing = logs.read_log_day(spark, str(tmp_path), "2024-01-03")
    assert missing.columns == schemas.RAW_LOG_FIELDS and missing.count() == 0
    assert "2024-01-03" in caplog.text


def test_wrapped_lines(spark, tmp_path):
    inner = log_line(traceId="1", request=json.dumps({"title": 'a "b"\n한글'}))
    path = write(tmp_path / "w.json", json.dumps(inner), log_line(traceId="2"), '"not json"', '"open')
    rows = {r.traceId: r for r in logs.read_wrapped_logs(spark, path).collect()}
    assert json.loads(rows["1"].request) == {"title": 'a "b"\n한글'}
    assert set(rows) == {"1", "2", None}
    # A plain reader sees no fields in a wrapped line.
    assert {r.traceId for r in logs.read_logs(spark, path).collect()} == {None, "2"}


def test_csv_drops_malformed_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name", "1,a", "x,b", '3,"c,d"')
    assert [tuple(r) for r in files.csv_strict(spark, path, "id int, name string").collect()] == [
        (1, "a"), (3, "c,d"),
    ]
    # Which columns a query needs makes no difference.
    read = files.csv_strict(spark, path, "id int, name string")
    assert read.count() == read.select("name").count() == 2
    assert [r.name for r in read.select("name").collect()] == ["a", "c,d"]


def test_csv_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name", "1,a", "x,b", '3,"c,d"', "4", "5,e,f")
    kept, rejected = files.csv_quarantine(spark, path, "id int, name string")
    strict = files.csv_strict(spark, path, "id int, name string")
    assert kept.columns == ["id", "name"]
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, strict.collect())) == [(1, "a"), (3, "c,d")]
    assert sorted(r.brokenLine for r in rejected.collect()) == ["4", "5,e,f", "x,b"]
    assert all(r.file.endswith("a.csv") for r in rejected.collect())
    assert kept.count() + rejected.count() == 5
    assert rejected.select("brokenLine").count() == 3


def test_csv_with_nested_json(spark, folder):
    value = json.dumps({"a": json.dumps({"b": 'x "y" \\ z, w'})})
    df = spark.createDataFrame([(value, 1)], "json_str string, n int")
    for escape in ("\\", '"'):
        sinks.overwrite_csv(df, f"{folder}/c", escape)
        back = files.csv_strict(spark, f"{folder}/c", "json_str string, n int", escape)
        assert [tuple(r) for r in back.collect()] == [(value, 1)]
        assert files.csv_inferred(spark, f"{folder}/c", escape).schema["n"].dataType.simpleString() == "int"


def test_csv_with_line_breaks(spark, folder):
    df = spark.createDataFrame([("a\nb", 1), ("c", 2)], "v string, n int")
    sinks.overwrite_csv(df, f"{folder}/c")
    back = files.csv_strict(spark, f"{folder}/c", "v string, n int", multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == [("a\nb", 1), ("c", 2)]


def test_places_are_text(spark, tmp_path):
    header = "id,ml_mapping_id,name,latitude,longitude,time,create_time,update_time"
    path = write(tmp_path / "place.csv", header, "1,100,n,1.0,2.0,t,c,u")
    (row,) = files.places(spark, path).collect()
    assert (row.id, row.ml_mapping_id, row.latitude) == ("1", "100", "1.0")


def test_json_schema(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"a": 1, "b": {"c": "x"}}', '{"a": 2.5}')
    found = json.loads(files.json_schema(spark, path))
    assert [(f["name"], f["type"] if isinstance(f["type"], str) else "struct") for f in found["fields"]] == [
        ("a", "double"), ("b", "struct"),
    ]


def test_column_json_schema(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"b": "x"}',), ("{broken",), (None,)], "v string")
    assert convert.column_json_schema(df, "v").first()[0] == "OBJECT<a: BIGINT, b: STRING>"


@pytest.fixture
def mart(spark, folder):
    rows = [(f"2024-{m:02}-{d:02}", d) for m, d in [(1, 30), (1, 31), (2, 1), (2, 3)]]
    df = spark.createDataFrame(rows, "cre_dtm string, v int").withColumn("cre_dtm", F.to_date("cre_dtm"))
    sinks.append_partitions(df, f"{folder}/mart", ["cre_dtm"])
    return f"{folder}/mart"


def test_period(spark, mart):
    df = marts.read_period(spark, mart, "2024-02-01", 3)
    assert sorted((r.cre_dtm, r.v) for r in df.collect()) == [
        (date(2024, 1, 30), 30), (date(2024, 1, 31), 31), (date(2024, 2, 1), 1),
    ]
    assert marts.read_period(spark, mart, date(2024, 2, 3), 1).count() == 1
    assert marts.read_period(spark, mart, "2024-02-03", 3).count() == 2
    assert len(df.select("v").inputFiles()) >= 3
    assert "PartitionFilters: [isnotnull(cre_dtm" in df._jdf.queryExecution().toString()


def test_period_with_all_days(spark, mart):
    assert marts.read_period(spark, mart, "2024-02-01", 3, require_all_days=True).count() == 3
    with pytest.raises(FileNotFoundError, match="2024-02-02"):
        marts.read_period(spark, mart, "2024-02-03", 3, require_all_days=True)


def test_one_partition(spark, mart):
    assert marts.read_partition(spark, mart, "2024-02-01").columns == ["v", "cre_dtm"]
    assert marts.read_partition(spark, mart, "2024-02-01", keep_column=False).columns == ["v"]
    sql = "select v + 1 as w from {df} where v = 1"
    assert [r.w for r in marts.query_partition(spark, mart, "2024-02-01", sql).collect()] == [2]


def test_partition_values_keep_their_type(spark, folder):
    df = spark.createDataFrame([("a", "007")], "v string, url_part string")
    sinks.append_partitions(df, f"{folder}/m", ["url_part"])
    assert marts.read_mart(spark, f"{folder}/m", "v string, url_part string").first().url_part == "007"


def test_table_options():
    assert jdbc.table_options("jdbc:x", "t", "s", {"user": "u"}) == {
        "user": "u", "url": "jdbc:x", "dbtable": "s.t",
    }
    assert jdbc.table_options("jdbc:x", "t", None, {})["dbtable"] == "t"


class Recorder:
    """Stands in for a session or a frame and keeps what is said to its reader or writer."""

    def __init__(self):
        self.said = []

    def __getattr__(self, name):
        if name in ("read", "write"):
            return self

        def call(*args, **named):
            self.said.append((name, args, named))
            return self

        return call


def test_database_read_in_parts():
    spark = Recorder()
    jdbc.read_table(spark, "jdbc:x", "t", "s", {"user": "u"}, jdbc.Split("id", 0, 100, 4))
    assert spark.said == [
        ("format", ("jdbc",), {}),
        ("options", (), {
            "user": "u", "url": "jdbc:x", "dbtable": "s.t", "partitionColumn": "id",
            "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
        }),
        ("load", (), {}),
    ]


def test_database_write():
    from trailmart.sinks.jdbc import write_table

    df = Recorder()
    write_table(df, "jdbc:x", "t", properties={"user": "u"}, column_types="a int")
    assert df.said == [
        ("format", ("jdbc",), {}),
        ("options", (), {
            "user": "u", "url": "jdbc:x", "dbtable": "t", "numPartitions": "8",
            "createTableColumnTypes": "a int",
        }),
        ("mode", ("overwrite",), {}),
        ("save", (), {}),
    ]


def test_export_period(spark, mart, monkeypatch):
    from trailmart.plans import serving

    written = []
    monkeypatch.setattr(
        serving.jdbc_sink, "write_table", lambda df, *rest: written.append((df.count(), *rest))
    )
    out = serving.export_period(spark, mart, "2024-02-03", "jdbc:x", "t", schema="s", min_day="2024-02-01")
    assert out.count() == 4 and written == [(4, "jdbc:x", "t", "s", None)]
    assert serving.export_period(spark, mart, "2024-01-31", "jdbc:x", "t", min_day="2024-02-01") is None
    assert len(written) == 1
    serving.export_mart(spark, mart, "v int, cre_dtm date", "jdbc:x", "all", "s", {"user": "u"})
    assert written[1] == (4, "jdbc:x", "all", "s", {"user": "u"})


def test_exports_pass_the_options_of_the_writer_on(spark, mart, monkeypatch):
    from trailmart.plans import serving

    said = []
    monkeypatch.setattr(serving.jdbc_sink, "write_table", lambda df, *rest, **options: said.append((df.schema, options)))
    options = {"mode": "append", "column_types": "v int", "connections": 2}
    serving.export_mart(spark, mart, "v int, cre_dtm date", "jdbc:x", "t", **options)
    serving.export_period(spark, mart, "2024-02-03", "jdbc:x", "t", mart_schema="v bigint, cre_dtm string", **options)
    assert [o for _, o in said] == [options, options]
    assert [s.simpleString() for s, _ in said] == ["struct<v:int,cre_dtm:date>", "struct<v:bigint,cre_dtm:string>"]
