"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import chat, fill_middle, fingerprint, graph_index, hard_negatives, jaccard, kneser_ney, mixing, packing, pii, secretscan, tokens, url_filter
from upkeep.llm.common import PLAIN_READS, materialize, table


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = tokens.write_token_files(docs, end_id=0, special=True)
    return tokens.token_digests(tokens.read_token_files(spark, shards))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    mixed = mixing.mix(docs, mixing.rank_weights(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    scored = kneser_ney.classify(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return scored.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", "kept")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(chat.text_parts(rows.unionByName(control))))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_index.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, num=85, den=100)
    return linked.select("doc_id", "n_shingles", "component_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = secretscan.scan(docs)
    base = F.filter("found", lambda x: x["kind"] < len(secretscan.BASE))
    kinds = F.transform("found", lambda x: x["kind"])
    number = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{r.name}") for k, r in enumerate(secretscan.BASE)]
    return found.select("doc_id", *number, F.sha2(secretscan.spelled(base, secretscan.RULES), 256).alias("base_sha256"),
                        secretscan.spelled(F.col("found"), secretscan.RULES).alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), capacity=1024, end_id=2, special=True)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = materialize(fill_middle.frame(table(spark, sf_dir, "documents", **PLAIN_READS).select("doc_id", "text")), **PLAIN_READS)
    done = fill_middle.digests(fill_middle.transform(framed, seed=1, moved=90, spm=20))
    return done.select("doc_id", "n", "form", F.col("cut").alias("prefix_chars"), (F.col("until") - F.col("cut")).alias("middle_chars"), "output_sha256", "restored_sha256")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda x: x["kind"] < len(pii.BASE))
    kinds = F.transform("found", lambda x: x["kind"])
    number = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{r.name}") for k, r in enumerate(pii.BASE)]
    names = [r.name for r in pii.RULES]
    return found.select("doc_id", *number, F.sha2(pii.spelled(base, names), 256).alias("base_sha256"), pii.spelled(F.col("found"), names).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(vectors, vectors.where("vec_id % 100 = 0"), positives=5, negatives=10, low=30, high=90)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_fingerprint, op2_token_files, op3_mix, op4_quality, op5_chat, op6_url_filter, op7_neighbours, op8_jaccard, op9_secrets, op10_packing, op11_fill_middle, op12_personal_data, op13_hard_negatives, pipeline)}
