import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.conftest import SF
from upkeep.llm import hard_negatives as hn


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 8), st.integers(1, 30))
def test_product_is_exact(seed, m, k, n, leaf, bits):
    r = np.random.default_rng(seed)
    a, b = r.integers(-2**bits, 2**bits, (m, k)), r.integers(-2**bits, 2**bits, (k, n))
    exact = a.astype(object) @ b.astype(object)
    if bits <= 28:
        assert (hn.strassen(a, b, leaf) == exact).all()
    else:  # wraps as 64-bit integers do
        assert (hn.strassen(a, b, leaf) == np.vectorize(lambda x: (x + 2**63) % 2**64 - 2**63, otypes=[np.int64])(exact)).all()


@settings(max_examples=300, deadline=None)
@given(st.integers(-2**62, 2**62), st.integers(0, 100), st.integers(0, 100))
def test_bounds_are_exact(p, low, high):
    lo, hi = (int(x[0]) for x in hn.bounds(np.array([p]), low, high))
    assert 100 * lo >= low * p > 100 * (lo - 1) and 100 * hi <= high * p < 100 * (hi + 1)


def brute(rows, asked, positives=5, negatives=10, low=30, high=90):
    def part(rows):
        kept = set()
        for i, label, v in rows:
            if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
                continue
            q = tuple(math.floor(256 * x) for x in v)
            if sum(x * x for x in q) < 2**62:
                kept.add((i, label, q))
        return sorted(kept)

    out = []
    rows = part(rows)
    for i, label, q in part(asked):
        scored = sorted((-sum(x * y for x, y in zip(q, p, strict=False)), j, other) for j, other, p in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out)


def odd_rows():
    r = np.random.default_rng(5)
    rows = [(k, int(r.integers(0, 3)), [float(x) for x in r.integers(-3, 4, 6) / 8]) for k in range(300)]  # many ties
    rows += [(400 + k, 1, rows[k][2]) for k in range(40)] + rows[:5]
    rows += [(500, None, [1.0]), (501, 1, None), (None, 1, [1.0] * 6), (502, 1, [1.0, None]), (503, 1, [math.nan] * 6), (504, 1, [math.inf]), (505, 2, [1e300] * 6), (506, 2, [-1e300]),
             (507, 0, [1.0, 2.0]), (508, 1, []), (509, 2, [0.0] * 6), (510, 0, [1e6, -1e6, 3e5, 0.0, 0.0, 0.0]), (511, 1, [1e6, 5e5, 3e5]), (7, 2, [0.5] * 6), (0, 1, [0.25] * 6)]
    return rows


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("cells", ["one", "many"])
def test_rows_against_brute_force(spark, monkeypatch, cells):
    if cells == "many":
        monkeypatch.setattr(hn, "CELL_BYTES", 10_000)
        monkeypatch.setattr(hn, "CELL_ROWS", 60)
        monkeypatch.setattr(hn, "TILE", 17)
        monkeypatch.setattr(hn, "LEAF", 2)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("no", "q", "kind", "cell", "rank", "score", "ids")})
    got = hn.mine(df, df.where("vec_id % 10 = 0")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, [x for x in rows if x[0] is not None and x[0] % 10 == 0])
    assert got


def test_few_and_no_rows(spark):
    for rows in ([], [(100, 1, [1.0])], [(100, 1, [1.0]), (1, 1, [0.5])], [(100, 1, [1.0]), (1, 1, [0.5]), (2, 2, [0.25])], [(100, 1, [1.0]), (1, 2, [0.5])], [(100, 1, [-1.0]), (1, 1, [1.0]), (2, 0, [1.0])],
                 [(100, 1, [0.0]), (1, 1, [1.0]), (2, 0, [1.0]), (3, 0, [])]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert sorted(tuple(r) for r in hn.mine(df, df.where("vec_id = 100")).collect()) == brute(rows, [x for x in rows if x[0] == 100])


def test_query_over_embeddings(spark):
    from upkeep.llm.queries import op13_hard_negatives

    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op13_hard_negatives(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, [x for x in rows if x[0] % 100 == 0]) and len(got) > 100
