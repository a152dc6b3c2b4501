"""Mixing sources to target weights (operator 3), with DataFrame functions only.

Capped water-filling sets each source's target; seeded systematic sampling
then takes whole repetitions of every document and one more of as many
documents as the fraction left asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import WORD, materialize, small_or_shuffled

#: Slices of a source's documents by seeded hash; only the one slice that the sample ends in is sorted.
SLICES = 4096


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the 0-based rank of each row by ``column`` (ascending, nulls last), whose values must be distinct.

    Range partitions are ranked side by side and moved up by the rows before
    them, so that no task sees all rows.
    """
    part = materialize(df.orderBy(F.col(column).asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    # one row for each partition: what stands before it
    sizes = part.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_last()))
    placed = part.withColumn("_within", within).join(F.broadcast(before), "_part")
    return placed.withColumn(name, (F.col("_within") - 1 + F.col("_base")).cast("long")).drop("_part", "_within", "_base")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """sources: source, source_size, weight (0 or more).  Adds ``target``, the words to take of each source.

    Targets share ``total`` by weight.  A source whose share is above
    ``max_epochs`` times its size is clamped there, and the excess is reshared
    by weight among the others until none is above.  If all are clamped, less
    than ``total`` is taken.  A round is one aggregation over the sources.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) > cap
        row = sources.agg(F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)).alias("held"),
                          F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)).alias("weights")).first()
        new = max(0.0, total - row["held"]) / row["weights"] if row["weights"] else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap).cast("double"))


def mix(docs: DataFrame, weights: DataFrame, total: float | None = None, max_epochs: float = 3.0, seed: int = 7, slices: int = SLICES) -> DataFrame:
    """docs: doc_id, source, size (long).  weights: source, weight (one row each).  Returns doc_id, source, size, source_size, target, repeats, taken.

    A source without a weight gets none of the mix.  total: words to take, by
    default as many as there are.  Every document is taken ``floor(target /
    source_size)`` times; the rest of the target is filled with one more of
    each document in the order of a seeded hash, and ends at the document
    that brings it nearest.  The order depends on seed, doc_id, source and size alone,
    so reruns agree; rows alike in all of these are ties and any of them may be the last.
    Null sources are one source; an empty source (size 0) takes nothing.
    """
    u = F.xxhash64(F.lit(seed), "doc_id", "source", "size")
    docs = materialize(docs.select("doc_id", "source", "size").withColumns({"_u": u, "_slice": F.pmod(F.shiftrightunsigned(u, 40), F.lit(slices)).cast("int")}))
    by_slice = materialize(docs.groupBy("source", "_slice").agg(F.sum("size").alias("_size")))
    sizes = by_slice.groupBy("source").agg(F.sum("_size").alias("source_size"))
    w = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
    sources = materialize(sizes.join(w, F.col("source").eqNullSafe(F.col("_source")), "left").select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    if total is None:
        total = float(sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    filled = water_fill(sources, total, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = filled.withColumn("whole", F.floor(epochs + 1e-9)).withColumn("extra", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))

    # the slice in which each source's extra words end, and what is left of them there
    up_to = F.sum("_size").over(Window.partitionBy("source").orderBy("_slice"))
    ends = (by_slice.withColumn("_end", up_to)
            .join(plan.select(F.col("source").alias("_s"), "extra"), F.col("source").eqNullSafe(F.col("_s")))
            .where((F.col("_end") - F.col("_size") < F.col("extra")) & (F.col("extra") <= F.col("_end")))
            .groupBy("_s").agg(F.min(F.struct("_slice", (F.col("extra") - F.col("_end") + F.col("_size")).alias("_left"))).alias("_cut")))
    plan = materialize(plan.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "whole", F.coalesce("_cut._slice", F.lit(-1)).alias("_cut"), F.coalesce("_cut._left", F.lit(0.0)).alias("_left")))

    joined = docs.join(small_or_shuffled(plan), F.col("source").eqNullSafe(F.col("_source")))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("_u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    border = joined.where(F.col("_slice") == F.col("_cut")).withColumn("_run", running).withColumn(
        "more", (F.col("_run") - F.col("size") / 2 <= F.col("_left")).cast("long")).drop("_run")
    clear = joined.where(F.col("_slice") != F.col("_cut")).withColumn("more", (F.col("_slice") < F.col("_cut")).cast("long"))
    return (clear.unionByName(border)
            .withColumn("repeats", F.col("whole").cast("long") + F.col("more"))
            .select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken")))


def rank_weights(sources: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """Distinct sources in order of code point, null last, with weights from a repeating cycle."""
    numbered = ranked(sources.select("source").distinct(), "source", "_rank")
    return numbered.select("source", F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (F.col("_rank") % len(cycle) + 1).cast("int")).alias("weight"))


def tempered_weights(sources: DataFrame, power: float = 0.7) -> DataFrame:
    """sources: source, source_size.  Weights by size to a power below 1: small sources weigh more than their share."""
    return sources.select("source", F.pow(F.col("source_size").cast("double"), F.lit(power)).alias("weight"))
