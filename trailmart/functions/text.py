"""Expressions for raw text lines that carry JSON."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def unescape_newlines(text: Column) -> Column:
    r"""Turn the two characters ``\n`` into a line break."""
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def json_object(text: Column) -> Column:
    """Text from the first ``{`` to the last ``}``, over any number of lines; NULL without one."""
    first = F.instr(text, "{")
    last = F.length(text) - F.length(F.substring_index(text, "}", -1))
    return F.when((first > 0) & (last >= first), F.substring(text, first, last - first + 1))


def json_object_of_line(text: Column) -> Column:
    """The older extraction: an object on a single line, an empty string without one."""
    return F.regexp_extract(text, r"\{.*\}", 0)


def is_payload(text: Column) -> Column:
    """False for NULL and for HTML pages."""
    return text.isNotNull() & ~text.startswith("<!DOCTYPE html>")


def unwrap_json_string(line: Column) -> Column:
    """Decode a line that is a JSON string holding JSON; other lines stay as they are."""
    decoded = F.from_json(F.concat(F.lit('{"v":'), line, F.lit("}")), "v string").getField("v")
    return F.when(F.ltrim(line).startswith('"'), decoded).otherwise(line)
