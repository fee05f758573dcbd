"""Schemas of the logs, their JSON payloads, the dimensions and the marts, as DDL text.

Fixed values: field names, types and route names come from the services that write and read
this data, so they have to be spelled exactly like this.
"""

RAW_LOG = (
    "traceId string, memberId string, clientIp string, url string, method string, "
    "requestParam string, request string, response string, statusCode string, "
    "requestTime string, time bigint"
)
RAW_LOG_FIELDS = [field.split()[0] for field in RAW_LOG.split(", ")]

# The column in which readers keep the text of a line that cannot be parsed, if asked to.
BROKEN_LINE = "brokenLine"

CLEANSED_LOG = RAW_LOG + ", url_part string, pathParam string, cre_dtm date, etl_dtm timestamp"

REQUEST_APPLICATION = "memberId int, groupId int"
REQUEST_APPLICATION_PUT = "groupAdminId int, applicationId int"
RESPONSE_GROUP = "categories array<struct<id: int, name: string, depth: int>>"
RESPONSE_PLACE = (
    "id bigint, name string, description string, placeThumbnail string, address string, "
    "latitude double, longitude double, startTime string, endTime string, createTime string, "
    "updateTime string, categoryNames array<string>, images array<string>"
)

PLACE = (
    "id string, ml_mapping_id string, name string, latitude string, longitude string, "
    "time string, create_time string, update_time string"
)

GROUP_COUNTING = "count bigint, etl_dtm timestamp, cre_dtm date"
TOP_APPLICATION_GROUPS = "group_id int, count bigint, etl_dtm timestamp, cre_dtm date"
TOP_GROUP_CATEGORIES = (
    "category_id int, category_name string, count bigint, etl_dtm timestamp, cre_dtm date"
)
RECOMMENDATION = (
    "cid string, memberId string, score double, traceId string, etl_dtm timestamp, "
    "name string, cre_dtm date"
)
SCORER_ANSWER = (
    "memberId string, ml_mapping_id string, recommendations array<map<string, double>>"
)
STORED_ANSWER = SCORER_ANSWER + ", model_version string"

LOG_PARTITIONS = ["cre_dtm", "url_part", "method"]
DAY_PARTITION = ["cre_dtm"]

ROUTE_GROUP = "_api_v1_group"
ROUTE_APPLICATION = "_api_v1_application"
ROUTE_PLACE = "_api_v1_place_"
STATUS_CREATED = 201
TOP_K = 5
EXPORT_DAYS = 7
