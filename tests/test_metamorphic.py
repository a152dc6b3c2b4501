"""Shuffling input rows or changing shuffle partitioning must not change results."""

from pyspark.sql import functions as F

from upkeep.operators import features as FE
from upkeep.operators import quality as Q
from upkeep.sources.adapters import ADAPTER_TIE, records_from_tables
from tests.conftest import SMALL_SF


def _run(spark, recs):
    res = Q.clean(recs, as_of="2001-12-01", tie=ADAPTER_TIE, checkpoint=False)
    feats = FE.engineer(res.data, tie=ADAPTER_TIE)
    cols = sorted(feats.columns)
    return sorted(tuple(r) for r in feats.select(*cols).collect())


def test_order_and_partitioning_invariance(spark):
    recs = records_from_tables(spark, SMALL_SF, dirty=True)
    a = _run(spark, recs)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = _run(spark, recs.repartition(5).orderBy(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(a) > 1000
    assert a == b
