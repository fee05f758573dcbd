"""Joins of a large frame with a lookup frame."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int = 1,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on equal column names.

    No broadcast is forced: Spark broadcasts the lookup when its size, estimated or measured at
    run time, is under the session's threshold, and otherwise splits skewed keys of a sort-merge
    join (adaptive execution), which repeats the lookup rows of those keys only. Where the session
    has that off, ``salts`` > 1 spreads each key over that many tasks by a hash of ``spread_by`` and
    repeats the whole lookup as often. The hash depends on row values only, so a task that runs
    again sends its rows to the same place.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup join is left or inner")
    conf = facts.sparkSession.conf
    splits = all(conf.get(f"spark.sql.adaptive.{x}").lower() == "true" for x in ("enabled", "skewJoin.enabled"))
    if salts <= 1 or splits:
        return facts.join(lookup, list(on), how)
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    copies = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    salted_lookup = lookup.withColumn("_salt", F.explode(copies))
    return salted_facts.join(salted_lookup, [*on, "_salt"], how).drop("_salt")
