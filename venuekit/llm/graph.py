"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuekit.session import discard, materialize


def thinned(links: DataFrame) -> DataFrame:
    """Fewer links (a, b) with the same components: each b keeps its smallest a, which is linked with its other ones.

    Members of a large group are mostly linked with the same few others, and so keep one link each.
    """
    first = F.min("a").over(Window.partitionBy("b"))
    ends = links.select("a", "b").distinct().select("a", "b", first.alias("first"))
    each = F.array(F.struct(F.col("first").alias("a"), "b"), F.struct(F.col("first").alias("a"), F.col("a").alias("b")))
    return ends.select(F.inline(each)).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of a link (a, b): label is the smallest id that can be reached from it.

    Each round takes the smallest label among the neighbours and then the label of that label, so a chain of n links takes
    about log n rounds. Tables are written between rounds; only the number of changes comes to the driver. A vertex with
    very many links is summed before the shuffle.
    """
    few = materialize(thinned(links), "links")
    both = materialize(
        few.select(F.col("a").alias("id"), F.col("b").alias("other")).union(few.select("b", "a")).distinct(), "links"
    )
    labels = materialize(both.groupBy("id").agg(F.least(F.min("other"), F.first("id")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("other"), F.col("label").alias("seen")), "other")
        least = seen.groupBy("id").agg(F.min("seen").alias("seen"))
        best = labels.join(least, "id").select("id", "label", F.least("label", "seen").alias("best"))
        jump = best.select(F.col("id").alias("to"), F.col("best").alias("further"))
        moved = best.join(jump, F.col("best") == F.col("to"), "left").select(
            "id", F.least("best", F.coalesce("further", "best")).alias("label"), F.col("label").alias("was")
        )
        moved = materialize(moved, "labels")
        changed = moved.where(F.col("label") != F.col("was")).limit(1).count()
        discard(labels)
        labels = moved.select("id", "label")
        labels._stored_path = moved._stored_path
        if not changed:
            discard(few, both)
            return labels


def labelled(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with the label of the id in ``key``; an id without a link is its own label."""
    found = rows.join(labels.select(F.col("id").alias("_id"), F.col("label").alias("_label")), F.col(key) == F.col("_id"), "left")
    return found.withColumn(name, F.coalesce("_label", key)).drop("_id", "_label")


def with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of ``components`` after more links (a, b): only the components that these join are gone through again."""
    ends = labelled(labelled(links, labels, "a", "la"), labels, "b", "lb").where("la <> lb")
    ends = materialize(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "ends")
    if ends.isEmpty():
        discard(ends)
        return labels
    joined = components(ends)
    moved = labelled(labels, joined, "label", "now").select("id", F.col("now").alias("label"))
    # an id that had no link so far was its own label
    fresh = joined.join(labels.select("id"), "id", "left_anti")
    made = materialize(moved.unionByName(fresh), "labels")
    discard(ends, joined)
    return made
