import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.conftest import ODD, SF
from upkeep.llm import tokens


def library():
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return t


LIBRARY = library()
ENCODER = tokens.Encoder(tokens.tokenizer_path())


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab '’éA1 \n\t\r\x1c\x85\xa0\x0b!_-s²½·×ɏʼ…€<|>", max_size=60)))
def test_words_and_whole_texts_have_the_same_ids(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def check(rows, got, end):
    line = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    want, start, by_id = [], 0, {}
    for d, t in line:
        ids = np.array([*LIBRARY.encode(t, add_special_tokens=False).ids, end], "<u4")
        by_id.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
        want.append(d)
        start += len(ids)
    seen = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got))
    assert [r[1] for r in seen] == want
    at = 0
    for s, d, n, crc in seen:
        assert s == at
        at += n
        by_id[d].remove((n, crc))
    assert not any(by_id.values()) and at == start


def test_files_read_back(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    check(rows, tokens.token_digests(tokens.read_token_files(spark, tokens.write_token_files(docs))).collect(), 0)
    check(ODD, tokens.token_digests(tokens.read_token_files(spark, tokens.write_token_files(make_docs(ODD), end_id=2))).collect(), 2)


def test_no_documents(spark, make_docs):
    shards = tokens.write_token_files(make_docs([]))
    assert shards == [] and tokens.token_digests(tokens.read_token_files(spark, shards)).count() == 0


def test_a_second_attempt_of_a_shard_is_not_read(spark, make_docs, tmp_path):
    first = tokens.write_token_files(make_docs(ODD), folder=str(tmp_path))
    second = tokens.write_token_files(make_docs(ODD), folder=str(tmp_path))
    assert {x["name"] for x in first}.isdisjoint(x["name"] for x in second)
    check(ODD, tokens.token_digests(tokens.read_token_files(spark, second)).collect(), 0)


def test_shards_end_at_their_number_of_ids(spark, make_docs, tmp_path):
    """Many shards a partition, each ended by the document that fills it; the same sequence of ids."""
    shards = tokens.write_token_files(make_docs(ODD).coalesce(1), folder=str(tmp_path), shard_ids=60)
    assert len({x["part"] for x in shards}) < len(shards)
    check(ODD, tokens.token_digests(tokens.read_token_files(spark, shards)).collect(), 0)
    for x in shards:
        off = np.fromfile(f"{x['name']}.off", "<u8")
        assert off[-1] == x["n_ids"] and off[-2] < 60 and len(off) == x["n_docs"] + 1


def test_slices_of_a_file_that_is_not_mapped(tmp_path):
    from pyarrow import fs

    np.arange(1000, dtype="<u2").tofile(f"{tmp_path}/x")
    for numbers in (tokens.Stored(fs.LocalFileSystem(), f"{tmp_path}/x", "<u2"), tokens._mapped(fs.LocalFileSystem(), f"{tmp_path}/x", "<u2")):
        assert len(numbers) == 1000 and numbers[10:13].tolist() == [10, 11, 12] and numbers[998:1200].tolist() == [998, 999] and len(numbers[5:5]) == 0


ALPHABET = "ab '’éA1 \n\t\rsdmtlvre×÷ɏ…€«–½中\x1c\x0b!_-"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=20), max_size=6))
def test_texts_that_share_a_slice_have_the_ids_of_each_alone(texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in ENCODER.each(texts)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_words_of_many_texts_are_looked_up_together():
    """One call of the library for all new words of a slice, each once; none for known words."""
    encoder, calls = tokens.Encoder(tokens.tokenizer_path()), []
    whole = encoder.whole
    encoder.whole = lambda texts: calls.append(texts) or whole(texts)
    texts = [f"stone {k} river {k % 7}" for k in range(500)]
    first = list(encoder.each(texts))
    assert len(calls) == 1 and len(set(calls[0])) == len(calls[0]) == 502
    assert list(encoder.each(texts)) == first and len(calls) == 1


def test_few_words_are_remembered(monkeypatch):
    """Beyond the bound only the words of the slice at hand stay; the ids are the same."""
    texts = [f"{k} stone w{k} w{k + 1}, w{k}!" for k in range(300)]
    want = list(tokens.Encoder(tokens.tokenizer_path()).each(texts))
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    monkeypatch.setattr(tokens, "CALL_WORDS", 3)
    encoder = tokens.Encoder(tokens.tokenizer_path())
    for text, ids in zip(texts, want, strict=True):
        assert list(encoder.each([text, "", text])) == [ids, b"", ids]
        assert len(encoder.words) == len(encoder.ids) < 100
    assert list(encoder.each(texts)) == want
