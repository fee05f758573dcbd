"""Row filters."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(
    df: DataFrame, url_part: str, method: str, day: str | date | None = None
) -> DataFrame:
    """Rows of one route, optionally of one day; all three are partition columns of the log mart.

    Where they are computed and not read, the cheap method test comes first.
    """
    kept = (F.col("method") == method) & (F.col("url_part") == url_part)
    if day is not None:
        kept = kept & (F.col("cre_dtm") == F.lit(str(day)).cast("date"))
    return df.filter(kept)


def status(code: int, canonical: bool = False) -> Column:
    """Rows answered with ``code``; text that is no integer never matches.

    ``canonical=True`` compares the text itself, which the Parquet reader can push down. Use it
    when the writer is known to store plain digits.
    """
    if canonical:
        return F.col("statusCode") == str(code)
    return F.col("statusCode").try_cast("int") == code


def without_text(df: DataFrame, column: str, part: str) -> DataFrame:
    """Drop rows whose text contains ``part``; NULL rows go as well."""
    return df.filter(~F.contains(F.col(column), F.lit(part)))


def numeric_id(df: DataFrame, column: str = "id") -> DataFrame:
    """Keep rows whose id is an integer of up to 64 bits."""
    return df.filter(F.col(column).try_cast("bigint").isNotNull())


def of_member(df: DataFrame, member: str | int) -> DataFrame:
    return df.filter(F.col("memberId") == str(member))


def of_members(df: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of any member of a ``memberId`` frame."""
    return df.join(members.select("memberId").distinct(), "memberId", "left_semi")
