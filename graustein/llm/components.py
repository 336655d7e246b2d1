"""Connected components of a table of links, by contraction.

Every node hooks onto its smallest neighbour, pointer doubling brings each tree to its root,
and the links between roots are the next, smaller graph. Nothing but "is it empty" reaches
the driver, and every level is written, so a lost executor costs one level at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm.base import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a long, b long); label: the smallest node
    that can be reached. Loops and repeated links do no harm; no links give no rows."""
    edges = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "hooks")
        while True:
            higher = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = stored(up.join(higher, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "jumps")
            if up.filter("moved").isEmpty():
                break
            up = up.drop("moved")
        up = up.drop("moved")
        if labels is None:
            labels = up.withColumnRenamed("up", "label")
        else:
            labels = stored(labels.join(up.withColumnRenamed("node", "label"), "label", "left")
                            .select("node", F.coalesce("up", "label").alias("label")), "labels")
        a = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = stored(edges.join(a, "a").join(b, "b").filter("ra != rb")
                       .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
