"""JSON payload expressions: one narrow schema per route, parsed on read."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmart import schemas


def application_request(request: Column) -> Column:
    """Struct (memberId, groupId) of an application request."""
    return F.from_json(request, schemas.REQUEST_APPLICATION)


def group_categories(response: Column) -> Column:
    """Array of (id, name, depth) of a group response."""
    return F.from_json(response, schemas.RESPONSE_GROUP).getField("categories")


def place(response: Column) -> Column:
    """All thirteen fields of a place response; selecting one field parses only that one."""
    return F.from_json(response, schemas.RESPONSE_PLACE)


def place_id(response: Column) -> Column:
    return place(response).getField("id")


def application_put_request(request: Column) -> Column:
    """Struct (groupAdminId, applicationId) of an application update, by key."""
    return F.from_json(request, schemas.REQUEST_APPLICATION_PUT)


def fixed_offset_int(text: Column, start: int, length: int = 3) -> Column:
    """Integer at a fixed character offset, NULL when the characters are no number."""
    return F.substring(text, start, length).try_cast("int")


def as_int(text: Column) -> Column:
    """Integer of a text, NULL instead of an error for anything else."""
    return text.try_cast("int")
