"""Connected components of an edge table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import written


def connected(edges: DataFrame, u: str = "u", v: str = "v", rounds: int = 50) -> DataFrame:
    """node, root for every node of ``edges``; the root is the smallest node it reaches.

    Large stars and small stars in turn: every node's larger neighbours, then its smaller
    ones, are hung onto the smallest node in sight. A node with very many neighbours is a
    minimum taken in part before the shuffle and a join whose large side Spark can split;
    its neighbours are never gathered. Every round is written to the shared folder.
    """
    now = written(
        edges.select(F.greatest(u, v).alias("child"), F.least(u, v).alias("parent"))
        .where("child > parent")
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        both = now.union(now.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        low = both.groupBy("child").agg(F.min("parent").alias("low"))
        large = now.join(low.withColumnRenamed("child", "parent"), "parent", "left").select(
            "child", F.least("parent", "low").alias("parent")
        )
        low = large.groupBy("child").agg(F.min("parent").alias("low"))
        small = (
            large.join(low, "child")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("child").alias("child"), F.col("low").alias("parent")),
                        F.struct(F.col("parent").alias("child"), F.col("low").alias("parent")),
                    )
                ).alias("e")
            )
            .select("e.*")
            .where("child > parent")
            .distinct()
        )
        before, now = now, written(small, "edges")
        # Done when no edge was changed: every child hangs on a root.
        if now.join(before, ["child", "parent"], "left_anti").isEmpty() and (
            now.count() == before.count()
        ):
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = now.groupBy("child").agg(F.min("parent").alias("root"))
    return (
        roots.select(F.col("child").alias("node"), "root")
        .union(now.select(F.col("parent").alias("node"), F.col("parent").alias("root")))
        .groupBy("node")
        .agg(F.min("root").alias("root"))
    )
