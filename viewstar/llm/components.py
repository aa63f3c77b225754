"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.tables import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(v, c) for every vertex of ``edges`` (a, b): c is the smallest vertex reachable.

    First every vertex is drawn onto the smallest of itself and its
    neighbours (one aggregate), and edges are drawn along: most of a dense
    group falls together there, so only a small graph is left for the rounds.
    """
    both = written(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a"))
                   .toDF("v", "w").distinct(), "edges")
    near = written(both.groupBy("v").agg(F.least(F.first("v"), F.min("w")).alias("m")), "drawn")
    drawn = written(both.where("v < w").join(near.select("v", F.col("m").alias("a")), "v") \
        .join(near.select(F.col("v").alias("w"), F.col("m").alias("b")), "w") \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "drawn-edges")
    if drawn.isEmpty():  # every group fell together at once
        forget(both, drawn)
        return near.withColumnRenamed("m", "c")
    inner = _rounds(drawn)
    out = near.join(inner.select(F.col("v").alias("m"), "c"), "m", "left").select("v", F.coalesce("c", "m").alias("c"))
    out = written(out, "components")
    forget(both, near, drawn, inner)
    return out


def _rounds(edges: DataFrame) -> DataFrame:
    """Components by minimum labels with pointer jumping.

    Each round every vertex takes the smallest label among its neighbours and
    then the label of that label, so long chains shrink by half.  Every round
    is a written table: nothing is collected, and a lost executor re-reads
    files.  Hot vertices are folded by partial aggregation before the shuffle.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).toDF("v", "w"), "edges")
    labels = written(both.groupBy("v").agg(F.least(F.first("v"), F.min("w")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), "c"), "w").groupBy("v").agg(F.min("c").alias("near"))
        closer = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("far"))
        fresh = written(closer.join(jump, "c", "left").select("v", "old", F.least("c", F.coalesce("far", "c")).alias("c")),
                        "labels")
        forget(labels)
        labels = fresh
        if fresh.where("c <> old").isEmpty():
            forget(both)
            return labels
