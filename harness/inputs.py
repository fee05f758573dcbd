"""The driver's tables seen as the inputs of the library.

Most columns are SQL expressions that Spark and DuckDB read alike, so that both sides start from
the same rows; everything after that is computed separately.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_RUN = "2024-02-01 00:00:00"
SECOND_RUN = "2024-02-02 00:00:00"
LAST_DAY = "2024-01-30"

_SIGNUP_RESPONSE = (
    "concat('{\"categories\":[{\"id\":', cast(k % 10 as string), ',\"name\":\"c', "
    "cast(k % 10 as string), '\",\"depth\":2},{\"id\":', cast(10 + k % 7 as string), "
    "',\"name\":\"c', cast(10 + k % 7 as string), '\",\"depth\":1}]}')"
)
_VIEW_RESPONSE = (
    "concat('{\"id\":', cast(k as string), ',\"name\":\"p', cast(k as string), '\"}')"
)

# Access-log columns over events with k, the number in props. Both engines run these.
LOG_COLUMNS = {
    "traceId": "cast(event_id as string)",
    "memberId": "cast(user_id as string)",
    "clientIp": "concat('10.0.0.', cast(user_id % 256 as string))",
    "url": (
        "concat('http://app:9090', case event_type when 'signup' then '/api/v1/group' "
        "when 'purchase' then '/api/v1/application' "
        "when 'view' then concat('/api/v1/place/', cast(k as string)) "
        "when 'click' then '/api/v1/posts/' else '/admin/health' end)"
    ),
    "method": "case when event_type in ('signup','purchase') then 'POST' else 'GET' end",
    "requestParam": "cast(null as string)",
    "request": (
        "case when event_type = 'purchase' then concat('{\"memberId\": ', "
        "cast(user_id as string), ', \"groupId\": ', cast(k as string), '}') else '' end"
    ),
    "response": (
        f"case when event_type = 'signup' then {_SIGNUP_RESPONSE} "
        f"when event_type = 'view' then {_VIEW_RESPONSE} else '{{}}' end"
    ),
    "statusCode": (
        "case when event_type = 'error' then '500' "
        "when event_type in ('signup','purchase') and event_id % 10 = 0 then '400' "
        "when event_type in ('signup','purchase') then '201' else '200' end"
    ),
}
EVENT_NUMBER = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

# Application updates, written by the click events: ids sit at offsets 17 and 40.
PUT_REQUEST = (
    "concat('{\"groupAdminId\":', cast(100 + user_id % 900 as string), "
    "',   \"applicationId\":', cast(100 + k as string), '}')"
)

# The place dimension over part: small parts have ids that are no numbers.
PLACE_COLUMNS = {
    "id": (
        "case when p_type = 'SMALL' then concat('x', cast(p_partkey as string)) "
        "else cast(p_partkey as string) end"
    ),
    "ml_mapping_id": "cast(100000 + p_partkey as string)",
    "name": "p_name",
    "latitude": "cast(p_size as string)",
    "longitude": "cast(p_size as string)",
    "time": "p_brand",
    "create_time": "cast(null as string)",
    "update_time": "cast(null as string)",
}


def columns(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} as {name}" for name, sql in expressions.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.expr(EVENT_NUMBER))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event."""
    return _events(spark, sf_dir).selectExpr(
        *columns(LOG_COLUMNS),
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") as requestTime",
        "unix_millis(cast(ts as timestamp)) as time",
    )


def redelivered(logs: DataFrame) -> DataFrame:
    """Failed requests, delivered again as successful."""
    failed = logs.filter(F.col("statusCode").isin("400", "500"))
    return failed.withColumn("statusCode", F.lit("201"))


def application_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .filter("event_type = 'click'")
        .selectExpr(
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") as requestTime",
            "cast(user_id as string) as memberId",
            f"{PUT_REQUEST} as request",
        )
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*columns(PLACE_COLUMNS))


def place_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero to two images per part."""
    numbered = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "explode(slice(array(1, 2), 1, p_size % 3)) as n"
    )
    return numbered.selectExpr(
        "cast(p_partkey as string) as id",
        "concat('/img/', cast(p_partkey as string), '_', cast(n as string), '.png') as image_path",
    )


def place_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "cast(100000 + vec_id as string) as ml_mapping_id", "embedding"
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as memberId")


def as_json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
