"""Connected components of a table of edges, by contraction with joins and aggregates.

A round: every node points to its smallest neighbour (or itself), pointers are followed to
their roots, and the edges are rewritten between roots; equal edges merge and those within
a root go. Each round at least halves the nodes that still have an edge, so rounds are
logarithmic. The edges of a round are a written table: nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that an edge names; the root is one of the component's
    nodes, the same for all of them. Loops, repeated and reversed edges don't matter;
    edges with a null end are left out."""
    spark = edges.sparkSession
    live = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = written(spark, nodes.withColumn("root", F.col("node")), "components")
    live = written(spark, live.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "components-edges")
    while not live.isEmpty():
        ends = live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")),
                                             F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("e"))
        up = ends.groupBy("e.node").agg(F.min("e.to").alias("to")).select("node", F.least("node", "to").alias("to"))
        up = rooted(written(spark, up, "components-up"))
        half = live.join(up.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        whole = half.join(up.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        live = written(spark, whole.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                       "components-edges")
        labels = written(spark, labels.join(up.select(F.col("node").alias("root"), F.col("to").alias("top")), "root", "left")
                         .select("node", F.coalesce("top", "root").alias("root")), "components")
    return labels


def rooted(up: DataFrame) -> DataFrame:
    """Pointers (node, to) followed to their ends, doubling the way each time."""
    spark = up.sparkSession
    while True:
        far = up.join(up.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left")
        far = written(spark, far.select("node", F.coalesce("next", "to").alias("to"), (F.col("next") != F.col("to")).alias("moved")),
                      "components-up")
        up = far.select("node", "to")
        if far.filter("moved").isEmpty():
            return up
