"""URL expressions: origin removal and the route / path-id classifier."""

from pyspark.sql import Column
from pyspark.sql import functions as F

def strip_origin(url: Column, https: bool = False) -> Column:
    """Remove ``http://host`` from the front; ``https`` origins only when asked to."""
    return F.regexp_replace(url, r"^https?://[^/]+" if https else r"^http://[^/]+", "")


def strip_query(url: Column) -> Column:
    """Remove the query string and the fragment."""
    return F.regexp_replace(url, r"(?s)[?#].*", "")


def url_part(path: Column, name_empty: bool = True) -> Column:
    """Route name of a path: a trailing numeric id is cut off and ``/`` becomes ``_``.

    An empty path would turn into the NULL partition on write, so it is named ``_`` as well,
    unless ``name_empty`` is off. One replacement does it all: a filter on a computed route is
    pushed below the projection and evaluates every mention of ``path`` again.
    """
    trailing_id = r"(?:^|/)[0-9]+/*\z"
    cut = rf"\A\z|{trailing_id}" if name_empty else trailing_id
    return F.replace(F.regexp_replace(path, cut, "/"), F.lit("/"), F.lit("_"))


def path_id(path: Column) -> Column:
    """The trailing numeric id of a path as text, NULL when there is none."""
    segment = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    return F.when(segment.rlike(r"\A[0-9]+\z"), segment)
