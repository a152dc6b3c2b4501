"""Stored tables: scopes that delete them, stage tables that follow their sources; exact quantiles; the sorted extract."""
import math
import os
import random
import shutil

import pytest
from conftest import SMALL_SF
from pyspark.sql import functions as F

from upkeep.operators import stats
from upkeep.plans import catalog
from upkeep.session import materialize, stage_path, temporary_tables


def _there(path):
    return os.path.exists(path.removeprefix("file:"))


def test_a_scope_deletes_its_own_tables(spark, tmp_path):
    outside = materialize(spark.range(5))
    with temporary_tables(spark) as outer:
        a = materialize(spark.range(10))
        with temporary_tables(spark) as inner:
            b = materialize(a.withColumn("x", F.col("id") * 2))
            b.write.parquet(f"{tmp_path}/kept")
            stage_path(spark)  # a place that nothing is written to
            gone, still = list(inner), list(outer)
            assert len(gone) == 2 and len(still) == 1
        assert not _there(gone[0]) and _there(still[0]) and a.count() == 10
        kept = materialize(spark.range(3))
        outer.pop()
    assert not _there(still[0]) and kept.count() == 3
    assert outside.count() == 5 and spark.read.parquet(f"{tmp_path}/kept").count() == 10
    with pytest.raises(ValueError, match="stop"), temporary_tables(spark) as paths:
        materialize(spark.range(2))
        raise ValueError("stop")
    assert not _there(paths[0])


def test_stage_tables_follow_their_sources(spark, tmp_path):
    for t in catalog.STAGE_SOURCES:
        shutil.copy(f"{SMALL_SF}/{t}.parquet", tmp_path)
    made = []
    build = lambda: made.append(1) or len(made)
    sf = str(tmp_path)
    assert [catalog._stage(spark, sf, "x", build) for _ in range(2)] == [1, 1]
    spark.read.parquet(f"{SMALL_SF}/orders.parquet").limit(7).write.parquet(f"{sf}/more")
    os.replace(f"{sf}/more", f"{sf}/part.parquet.new")
    assert catalog._stage(spark, sf, "x", build) == 1  # not one of the sources
    os.utime(f"{sf}/orders.parquet", (1, 1))
    assert [catalog._stage(spark, sf, "x", build) for _ in range(2)] == [2, 2]


@pytest.mark.parametrize("max_rows", [2_000_000, 7])
def test_exact_quantile_against_sorting(spark, max_rows):
    r = random.Random(4)
    rows = [(g, r.choice([None, 1.5, r.gauss(0, 1), r.random()])) for g in ("a", "a", "b", "c") for _ in range(60)] + [("d", 3.0), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for share in (0.0, 0.25, 0.5, 0.995, 1.0):
        want = {}
        for g in "abcd":
            x = sorted(v for k, v in rows if k == g and v is not None)
            want[g] = x[max(0, math.ceil(share * len(x)) - 1)]
        assert {x["g"]: x["q"] for x in stats.exact_quantile(df, ["g"], "x", share, "q", max_rows).collect()} == want
    everything = sorted(v for _, v in rows if v is not None)
    assert stats.exact_quantile(df, [], "x", 0.9, "q", max_rows).first()["q"] == everything[math.ceil(0.9 * len(everything)) - 1]
    assert stats.exact_quantile(df.limit(0), ["g"], "x", 0.9).count() == 0


def test_extract_is_in_order(spark):
    got = [(r["building_id"], r["maintenance_date"]) for r in catalog.q_extract_sorted(spark, SMALL_SF).select("building_id", "maintenance_date").collect()]
    assert got == sorted(got) and len(got) == catalog.q_extract_join(spark, SMALL_SF).count() > 0
