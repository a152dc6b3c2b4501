"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept, as stored Parquet,
and returns documents again (doc_id, text, lang, source, n_chars); the last
one returns the packed layout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import jaccard, kneser_ney, mixing, packing, secretscan
from upkeep.llm.common import prepare, table
from upkeep.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within their language's threshold (operator 4).

    Null and empty texts go.  Repeated rows and rows without doc_id are judged each on its own.
    """
    prepare(spark)
    return kneser_ney.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles with a Jaccard similarity of 0.8 or more (operator 8).

    Of repeated rows one stays; rows without doc_id come after all others of their group.  Texts without words link with nothing and stay.
    """
    prepare(spark)
    return jaccard.keep_one(docs.select(*COLUMNS), words=5, num=80, den=100)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by a mark and n_chars of the new text (operator 9).

    Rows without a secret, null and empty texts included, stay as they are.
    """
    prepare(spark)
    clean = secretscan.redact(F.col("text"), F.col("found"))
    return secretscan.scan(docs.select(*COLUMNS)).withColumn("text", clean).withColumn(
        "n_chars", F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix takes them (operator 3).

    Sources weigh by size to the power 0.7.  The mix is so large that the
    source with the smallest target in proportion is taken once whole, so no
    document with words is lost; none is taken more than 3 times.  Null sources are one source; a source
    in which no text has a word takes nothing; repeated rows share their repeats.
    """
    prepare(spark)
    sized = docs.select(*COLUMNS).withColumn("_size", mixing.size_of(F.col("text")))
    sources = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    weights = mixing.materialize(mixing.tempered_weights(sources).join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    row = weights.where("source_size > 0").agg(F.max(F.col("source_size") / F.col("weight")).alias("level")).first()
    total = weights.agg(F.sum(F.least(F.col("weight") * F.lit(float(row["level"] or 0)), 3.0 * F.col("source_size")))).first()[0] or 0.0
    taken = mixing.mix(sized.select("doc_id", "source", F.col("_size").alias("size")), weights.select("source", "weight"), total=float(total), max_epochs=3.0)
    # rows that agree in doc_id, source and size are dealt the sum of their repeats
    repeats = taken.groupBy("doc_id", "source", "size").agg(F.sum("repeats").alias("_sum"), F.count("*").alias("_rows")).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), F.ceil(F.col("_sum") / F.col("_rows")).cast("int").alias("_times"))
    joined = sized.join(repeats, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    return joined.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 1024 tokens (operator 10); null texts count as empty, repeated rows each."""
    prepare(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), capacity=1024, end_id=2, special=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("sequences", sequences)]

#: The classifier, the token ids and the packing cannot be said in SQL; tests/llm compares run(), stage by stage, with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
