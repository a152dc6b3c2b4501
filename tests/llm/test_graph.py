import numpy as np
from pyspark.sql import functions as F

from llm.conftest import SF
from upkeep.llm import graph_index
from upkeep.llm.queries import op7_neighbours


def brute(vectors, queries, k):
    out = {}
    for qid, q in queries:
        d = sorted({(float(np.sqrt(((np.array(v, float) - np.array(q, float)) ** 2).sum())), i) for i, v in vectors if i != qid and len(v) == len(q)})
        out[qid] = d[:k]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    return sum(len({i for _, i in w} & found.get(q, set())) for q, w in want.items()) / sum(map(len, want.values()))


def test_recall_against_brute_force(spark):
    sf = SF.replace("0.001", "0.1")
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op7_neighbours(spark, sf).collect()
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert recall(got, want) >= 0.95
    ids = dict(rows)
    by = {}
    for r in got:
        exact = np.sqrt(((np.array(ids[r["query_id"]], float) - np.array(ids[r["vec_id"]], float)) ** 2).sum())
        assert abs(exact - r["score"]) < 1e-12 and r["vec_id"] != r["query_id"]
        by.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for v in by.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, 11)) and [x[1:] for x in v] == sorted(x[1:] for x in v)


def test_ties_odd_vectors_and_small_tables(spark):
    rows = [(k, [1.0, 0.0]) for k in range(30)] + [(100, [2.0, 0.0]), (100, [2.0, 0.0]), (101, None), (102, [0.0, 0.0]), (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]),
                                                   (105, [None, 1.0]), (106, []), (107, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (200, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = {}
    for r in graph_index.search(df, df.where("vec_id in (0, 5, 100, 101, 102, 107)"), k=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert [x[1] for x in sorted(got[0])] == list(range(1, 11))
    assert [x[1] for x in sorted(got[5])] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert [x[1] for x in sorted(got[100])] == list(range(10)) and 101 not in got and 102 not in got and 107 not in got
    assert graph_index.search(df.where("false"), df, k=3).count() == 0
    few = df.where("vec_id in (100, 200)")
    assert sorted(tuple(r)[:3] for r in graph_index.search(few, few, k=10).collect()) == [(100, 1, 200), (200, 1, 100)]


def test_ties_of_different_vectors_and_huge_components(spark):
    hot = [(k, [float(j == k) for j in range(60)]) for k in range(60)]
    df = spark.createDataFrame(hot, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in graph_index.search(df, df.where("vec_id = 0"), k=10).collect())
    assert [x[1] for x in got] == list(range(1, 11)) and all(x[2] == 2.0 ** 0.5 for x in got)
    r = np.random.default_rng(9)
    rows = [(k, [float(x) for x in r.normal(size=8)]) for k in range(300)]
    rows += [(300, [1e300] + [0.0] * 7), (301, [-1.7e308, 1.0] + [0.0] * 6), (302, [1.7e308] + [0.0] * 7), (303, [1 + 2.0 ** -40] * 8), (304, [1 + 2.0 ** -41] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_index.search(df, df.where("vec_id % 50 = 0 or vec_id > 299"), k=10).collect()
    want = brute([x for x in rows if x[0] < 300 or x[0] > 302], [x for x in rows if (x[0] % 50 == 0 and x[0] < 300) or x[0] > 302], 10)
    near = [x for x in got if x["query_id"] in want]
    assert recall(near, want) > 0.98 and len(near) == 10 * len(want)
    ids = dict(rows)
    for x in near:
        assert x["score"] == np.sqrt(((np.array(ids[x["vec_id"]]) - np.array(ids[x["query_id"]])) ** 2).sum())
    assert all(x["score"] > 1e299 for x in got if 300 <= x["query_id"] <= 302) and {x["query_id"] for x in got} >= {300, 301, 302}


def test_many_shards(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=16).astype("f4")]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = graph_index.search(df, df.where(F.col("vec_id") % 50 == 0), k=10, shard=200).collect()
    assert recall(got, brute(rows, rows[::50], 10)) > 0.98
