"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import materialize

#: Keys that the nodes of one root are dealt to.
SALTS = 16


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v.  Returns node, root: the smallest node that can be reached.

    Every node takes the smallest root among its neighbours' and then its
    root's root, until nothing changes; the table is stored after each round,
    so that lost executors do not undo earlier rounds.
    """
    both = edges.select("u", "v").where("u <> v")
    both = materialize(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    roots = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")))
    while True:
        near = (both.join(roots.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("near")))
        lower = roots.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        # only roots that are not their own root any more move others; a root of very many nodes is dealt to several keys
        jump = lower.where("root <> node").select(F.col("node").alias("root"), F.col("root").alias("next"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        low = lower.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(jump, ["root", "salt"], "left").withColumn("next", F.coalesce("next", "root"))
        new = materialize(low.select("node", F.col("next").alias("root"), (F.col("next") != F.col("old")).alias("moved")))
        roots = new.select("node", "root")
        if new.where("moved").isEmpty():
            return roots
