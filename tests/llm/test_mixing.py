from pyspark.sql import functions as F

from llm.conftest import ODD, SF
from upkeep.llm import mixing


def fill(sizes, weights, total, most):
    """Exact water level by bisection."""
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(most * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < total else (lo, mid)
    return [min(most * s, hi * w) for s, w in zip(sizes, weights, strict=True)]


def test_mix_of_documents(spark):
    import re

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = mixing.mix(docs, mixing.rank_weights(docs)).collect()
    again = mixing.mix(docs.repartition(7), mixing.rank_weights(docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sources = sorted({r["source"] for r in got})
    size = {s: sum(r["size"] for r in got if r["source"] == s) for s in sources}
    want = dict(zip(sources, fill([size[s] for s in sources], [(5, 2, 1)[k % 3] for k in range(len(sources))], sum(size.values()), 3), strict=True))
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]]))
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-3
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in sources:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own) / 2 + 1


def test_clamped_sources_and_odd_rows(spark, make_docs):
    rows = [(i, "w " * n, "en", s) for i, (n, s) in enumerate([(10, "a"), (1000, "b"), (900, None), (0, "empty"), (5, "b")])] + [(1, None, "en", "b"), (None, "w " * 7, "en", "a")]
    docs = make_docs(rows).withColumn("size", mixing.size_of(F.col("text"))).select("doc_id", "source", "size")
    got = mixing.mix(docs, mixing.rank_weights(docs)).collect()
    assert len(got) == len(rows)
    by = {r["source"]: r["target"] for r in got}
    want = fill([17, 1005, 0, 900], [5, 2, 1, 5], 1922, 3)  # a, b, empty, null last
    assert [round(by[s], 3) for s in ("a", "b", "empty", None)] == [round(x, 3) for x in want]
    assert mixing.mix(docs.where("false"), mixing.rank_weights(docs.where("false"))).count() == 0
    odd = make_docs(ODD).withColumn("size", mixing.size_of(F.col("text"))).select("doc_id", "source", "size")
    assert mixing.mix(odd, mixing.rank_weights(odd)).count() == len(ODD)


def test_one_slice_and_many_give_whole_targets(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 50).alias("size"))
    weights = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    for slices in (1, 64):
        total = mixing.mix(docs, weights, total=100_000.0, slices=slices).agg(F.sum("taken")).first()[0]
        assert abs(total - 100_000) <= 25
