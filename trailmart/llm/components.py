"""Connected components of links between 64-bit nodes, as joins and groupings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart import scratch


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Every node points to a smaller or equal one. A round lets the targets of linked nodes point
    to the smallest target seen over their links, then each node to its target's target, so the
    number of rounds grows with the logarithm of a component's diameter. A hub with very many
    links is cut down in the map tasks, since only minima are taken. Each round is a table in
    the shared folder. Labels only fall, so rounds end by themselves, when none moves.
    """
    edges = scratch.materialise(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct()
    )
    labels = scratch.materialise(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    )
    while True:
        ends = edges.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
        # Over each link: the target of one end may go to the smaller target of the other.
        hooks = (
            ends.where("lb < la")
            .groupBy(F.col("la").alias("label"))
            .agg(F.min("lb").alias("lower"))
        )
        hooked = labels.join(hooks, "label", "left").select(
            "node", F.coalesce("lower", "label").alias("label")
        )
        hooked = scratch.materialise(hooked)
        jumped = hooked.join(hooked.toDF("label", "further"), "label", "left").select(
            "node", F.coalesce("further", "label").alias("label"), F.lit(0).alias("_")
        )
        new = scratch.materialise(jumped.drop("_"))
        moved = new.join(labels.toDF("node", "old"), "node").where("label != old").limit(1).count()
        labels = new
        if not moved:
            return labels.withColumnRenamed("label", "component")
