import random

import pytest
from pyspark.sql import functions as F

from llm.conftest import prose
from upkeep.llm import kneser_ney as kn
from upkeep.llm.common import materialize


def foreign(seed, n):
    r = random.Random(seed)
    words = "vuoi quando gatto zucchero pioggia bianco finestra quaderno chiave luglio".split()
    return " ".join(r.choice(words) + r.choice("aeiou") for _ in range(n))


def test_rare_languages_have_their_own_cut(spark, make_docs):
    """A rare language is judged by its own documents, and one without trusted text is kept."""
    rows = [(k, prose(k, 60), "en") for k in range(300)]
    rows += [(1000 + k, foreign(k, 60), "it") for k in range(12)]
    rows += [(2000 + k, "".join(random.Random(k).choices("qxzjkvw ", k=300)), "zz") for k in range(5)]
    rows += [(3000, "".join(random.Random(9).choices("qxzjkvw ", k=300)), "it")]
    labels = [(k, 1, 0) for k in range(250)] + [(1000 + k, 1, 0) for k in range(6)]
    got = {r["doc_id"]: r for r in kn.classify(materialize(make_docs(rows)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(got[2000 + k]["kept"] and got[2000 + k]["threshold"] is None for k in range(5))
    assert all(got[1000 + k]["kept"] for k in range(12)) and not got[3000]["kept"]
    assert sum(got[k]["kept"] for k in range(300)) >= 297


def test_a_language_with_two_trusted_documents_has_one_held_out(spark, make_docs):
    ids = [r["k"] for r in spark.range(200).select(F.col("id").alias("k")).where(~kn.held_out("k")).limit(3).collect()]
    docs = make_docs([(ids[0], "a b", "xx"), (ids[1], "b c", "xx"), (ids[2], "c d", "yy")])
    trusted = spark.createDataFrame([(i,) for i in ids], "_trusted long")
    held = {r["_trusted"] for r in kn.split(docs, trusted).where("_held").collect()}
    assert len(held) == 1 and held < set(ids[:2])


@pytest.mark.parametrize("n", [1, 10, 49, 50, 51, 400])
def test_threshold_follows_the_own_level_at_every_size(spark, n):
    r = random.Random(n)
    rows = [("big", 8.0 * 2.718 ** r.gauss(0, 0.1), 10_000, True) for _ in range(1000)] + [("rare", 30.0 * 2.718 ** r.gauss(0, 0.1), 10_000, True) for _ in range(n)]
    cut = {x["_lang"]: x["threshold"] for x in kn.thresholds(spark.createDataFrame(rows, "lang string, perplexity double, n_symbols long, trusted boolean")).collect()}
    assert 9.5 < cut["big"] < 13 and 32 < cut["rare"] < 56
