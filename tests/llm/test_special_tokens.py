import zlib

import numpy as np
from tokenizers import Tokenizer

from llm.conftest import DOCS
from upkeep.llm import packing, queries, tokens

TEXTS = {1: "a<|endoftext|>b", 2: "plain words", 3: "<|endoftext|>", 4: "é <|endoftext|> 中"}


def test_queries_give_the_ids_of_the_library_call(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in TEXTS.items()], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(tokens.tokenizer_path())
    assert library.encode(TEXTS[1], add_special_tokens=False).ids == [64, 50256, 65]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    crc = lambda t, end: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes())
    files = {r["doc_id"]: r["ids_crc32"] for r in queries.op2_token_files(spark, str(tmp_path)).collect()}
    assert files == {k: crc(t, 0) for k, t in TEXTS.items()}
    for got in (queries.op10_packing(spark, str(tmp_path)), corpus_pipeline.sequences(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: r["ids_crc32"] for r in got.collect()} == {k: crc(t, 2) for k, t in TEXTS.items()}
    layout = packing.pack_documents(docs, special=True)
    assert sum(50256 in r["ids"] for r in packing.sequences(docs, layout, special=True).collect()) >= 1
