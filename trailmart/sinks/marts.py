"""Old and new rows of a mart as one frame; ``versions.upsert`` stores such a merge."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.operators import ranking


def merge_latest(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order_col: str = "etl_dtm",
    optional: str | None = None,
) -> DataFrame:
    """Old and new rows together, the newest of each key; columns are matched by name.

    Where the key column ``optional`` is NULL a row has no id of its own. Its content then stands
    for the id: a digest of all columns but ``order_col``.
    """
    casts = [F.col(f.name).cast(f.dataType) for f in new.schema.fields if f.name in old.columns]
    rest = [c for c in old.columns if c not in new.columns]
    both = old.select(*casts, *rest).unionByName(new, allowMissingColumns=True)
    if optional is None:
        return ranking.latest_by(both, keys, order_col)
    content = F.to_json(F.struct(*[c for c in both.columns if c != order_col]))
    digest = F.when(F.col(optional).isNull(), F.sha2(content.cast("binary"), 256))
    named = both.withColumn("_content", digest)
    return ranking.latest_by(named, [*keys, "_content"], order_col).drop("_content")
