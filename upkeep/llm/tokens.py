"""Token ids of whole texts, and flat binary files of them (operator 2).

A dataset is a folder of shards.  A shard has three flat little-endian files:
``.ids`` (token ids, 16 bits wide if the vocabulary allows it, else 32),
``.off`` (64-bit offsets: document i has ids off[i] to off[i+1]) and ``.doc``
(64-bit document ids; the first ``n_null`` documents have none).  A shard ends with the
document that brings it to a number of ids, so none grows with the input.  A shard's
place in the whole sequence of ids is the prefix sum over the shards before
it.  All three are memory-mapped when read; where the store
cannot do that, each slice is read from its place in the file.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from upkeep.llm.common import in_order, partitions, texts_of
from upkeep.session import ensure_checkpoint_dir

#: Bytes of the words and ids that a worker remembers, about; beyond that it keeps those of the slice at hand.
REMEMBERED = 32 << 20
#: Bytes of text that are split into words at once, about; new words that one call of the library gets.
SLICE_BYTES, CALL_WORDS = 4 << 20, 4096
#: Ids at which a shard ends; documents and ids that one batch of the reader holds, about.
SHARD_IDS, READ_DOCS, READ_IDS = 1 << 26, 512, 1 << 22

# The characters of which ``word_starts`` knows the kind, and the kinds by (first) byte in UTF-8
_PLAIN = re.compile("[\x00-\x7fÀ-ɏ«»–—‘-„…€]*")
_OTHER, _LETTER, _DIGIT, _BLANK, _BREAK = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]] = _LETTER
_KIND[0x30:0x3A], _KIND[0x20], _KIND[0x09:0x0E] = _DIGIT, _BLANK, _BREAK


def word_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of byte-level BPE start, as an expression of the library's kind finds them:

    ``'(?:[sdmt]|ll|ve|re)| ?[letters]+| ?[digits]+| ?[others]+|[white]+(?![^white])|[white]+``.

    data: bytes of texts of ``_PLAIN`` characters, one after the other; begins: where each of them begins.
    """
    n = len(data)
    kind = _KIND[data]
    high = np.flatnonzero(data >= 0x80)
    signs = high[data[high] == 0xC3]
    kind[signs[np.isin(data[signs + 1], (0x97, 0xB7))]] = _OTHER  # × and ÷
    later = high[data[high] < 0xC0]
    for _ in range(2):  # characters have up to three bytes
        kind[later] = kind[later - 1]
    first = np.ones(n + 3, bool)
    first[:n] = False
    first[begins] = True
    white = kind >= _BLANK
    starts = first.copy()
    if n:
        starts[1:n] = (kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)
    # the last of several white characters stands apart if a word follows
    inner = np.flatnonzero(white[1:] & white[:-1]) + 1
    starts[inner] = ~first[inner + 1] & ~white[np.minimum(inner + 1, n - 1)]
    starts |= first
    # 's and its like, where the apostrophe starts a word
    ahead = np.append(data, np.zeros(2, np.uint8))
    at = np.flatnonzero((data == 0x27) & starts[:n])
    at = at[~first[at + 1]]
    one = at[np.isin(ahead[at + 1], list(b"sdmt"))]
    pair = ahead[at + 1].astype("<u2") * 256 + ahead[at + 2]
    two = at[np.isin(pair, [a * 256 + b for a, b in (b"ll", b"ve", b"re")]) & ~first[at + 2]]
    for short, size in ((one, 2), (two, 3)):
        starts[short + 1] = False
        starts[short + size] = True
    return np.flatnonzero(starts[:n])


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """Bytes ends[i] to ends[i+1] of ``data``, without a copy."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


class Encoder:
    """Ids of texts by the tokenizers library.

    Byte-level BPE works on one word at a time, so each distinct word goes to
    the library once and its ids are remembered.  Slices of many texts are split and
    their words looked up together, as Arrow arrays.  Texts with characters whose
    class may differ between Unicode versions go to the library whole, as do
    texts that spell a special token: with ``special`` that is this token, as by
    the library's default, else plain text.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        kind = json.loads(self.library.to_str())
        split = kind.get("pre_tokenizer") or {}
        self.by_word = (kind.get("normalizer") is None and split.get("type") == "ByteLevel"
                        and not split.get("add_prefix_space") and split.get("use_regex", True)
                        and kind["model"]["type"] == "BPE")
        self.special = [x["content"] for x in kind.get("added_tokens", ())]
        self.words = self.ids = pa.array([], pa.large_binary())

    def whole(self, texts: list[str]) -> pa.LargeBinaryArray:
        """Of each text, from one call of the library."""
        ids = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.fromiter(accumulate(map(len, ids), initial=0), "<i8", len(ids) + 1)
        return _binary(4 * ends, np.fromiter(chain.from_iterable(ids), "<u4", ends[-1]))

    def _of_words(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Of distinct words: the known ones are looked up among these, whose table is the smaller one."""
        found = pa.compute.index_in(self.words, value_set=words)
        at = np.full(len(words), -1)
        at[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        if len(new := words.filter(pa.array(at < 0))):
            if self.words.nbytes + self.ids.nbytes > REMEMBERED:
                kept = pa.array(at[at >= 0])
                self.words, self.ids = self.words.take(kept), self.ids.take(kept)
                at[at >= 0] = np.arange(len(kept))
            at[at < 0] = np.arange(len(self.words), len(self.words) + len(new))
            calls = (new.slice(k, CALL_WORDS).cast(pa.large_string()).to_pylist() for k in range(0, len(new), CALL_WORDS))
            self.ids = pa.concat_arrays([self.ids, *map(self.whole, calls)])
            self.words = pa.concat_arrays([self.words, new])
        return self.ids.take(pa.array(at))

    def _of_plain(self, texts: list[bytes]) -> Iterator[bytes]:
        begins = np.fromiter(accumulate(map(len, texts), initial=0), "<i8", len(texts) + 1)
        if not begins[-1]:
            return iter(texts)
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = word_starts(data, begins)
        words = _binary(np.append(starts, len(data)), data).dictionary_encode()
        ids = self._of_words(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[:len(ids) + 1]
        at = ends[np.searchsorted(starts, begins)].tolist()
        held = memoryview(ids.buffers()[2] or b"")
        return (bytes(held[a:b]) for a, b in zip(at, at[1:], strict=False))

    def each(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        here: list[bytes | str] = []
        size = 0
        for text in texts:
            plain = self.by_word and (text.isascii() or _PLAIN.fullmatch(text)) and not any(x in text for x in self.special)
            here.append(text.encode() if plain else text)
            size += len(here[-1])
            if size >= SLICE_BYTES:
                yield from self._of_slice(here)
                here, size = [], 0
        yield from self._of_slice(here)

    def _of_slice(self, texts: list[bytes | str]) -> Iterator[bytes]:
        plain = self._of_plain([x for x in texts if isinstance(x, bytes)])
        return (next(plain) if isinstance(x, bytes) else self.whole([x])[0].as_py() for x in texts)

    def __call__(self, text: str) -> bytes:
        return next(self.each([text]))

    @property
    def size(self) -> int:
        return self.library.get_vocab_size()


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """One of each kind per worker process."""
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = Encoder(path, special)
    return _ENCODERS[path, special]


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = 0,
                      id_column: str = "doc_id", text_column: str = "text", special: bool = True, shard_ids: int = SHARD_IDS) -> list[dict]:
    """Writes the ids of all texts, in ascending order of document id (null first), and returns the list of shards.

    folder: where all executors and the reader can write; by default a new
    one in ``spark.checkpoint.dir``.  Each text (null: empty) ends with
    ``end_id``; ``special`` as for ``Encoder``.  Rows with the same id stand together, by a hash of their
    text; every row is written.  Without rows there are no shards.  A partition
    starts a new shard after the document that brings one to ``shard_ids`` ids; a document is never split.  Each shard is written under a
    name of its own attempt and counts only if the task reports it, so a
    repeated task leaves no half-written shard in the list.  The list has one
    entry for each shard and ``base``, the ids in the shards before it.
    """
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens/{uuid.uuid4().hex}"
    path = tokenizer or tokenizer_path()
    rows = in_order(docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")), "doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, special), TaskContext.get().partitionId()
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        kind = np.dtype("<u2" if max(encode.size, end_id + 1) <= 1 << 16 else "<u4")
        end = np.array([end_id], "<u4").tobytes()
        shard, done = None, 0
        try:
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch, "text")
                for doc, coded in zip(ids, encode.each(texts), strict=True):
                    shard = shard or _Shard(store, f"{base}/{part:06d}-{done:04d}-{uuid.uuid4().hex}", kind)
                    shard.add(doc, coded + end)
                    if shard.n_ids >= shard_ids:
                        yield shard.close(part, done)
                        shard, done = None, done + 1
                if shard:
                    shard.flush()
            if shard:
                yield shard.close(part, done)
        finally:
            if shard:
                shard.end()

    shards = sorted((x.asDict() for x in rows.select("doc_id", "text").mapInArrow(write, SHARD).collect()), key=lambda x: (x["part"], x["shard"]))
    for x, base in zip(shards, accumulate([0, *(x["n_ids"] for x in shards)]), strict=False):
        x |= {"base": base, "folder": folder}
    return shards


SHARD = "part int, shard int, name string, width int, n_docs long, n_null long, n_ids long"


class _Shard:
    """The three files of one shard, being written."""

    def __init__(self, store: fs.FileSystem, name: str, kind: np.dtype) -> None:
        self.name, self.kind = name, kind
        self.files = [store.open_output_stream(f"{name}.{x}") for x in ("ids", "off", "doc")]
        self.files[1].write(np.zeros(1, "<u8").tobytes())
        self.n_docs = self.n_null = self.n_ids = 0
        self.ends: list[int] = []
        self.docs: list[int] = []

    def add(self, doc: int | None, ids: bytes) -> None:
        got = np.frombuffer(ids, "<u4").astype(self.kind)
        self.files[0].write(got.tobytes())
        self.n_ids += len(got)
        self.ends.append(self.n_ids)
        self.docs.append(doc or 0)
        self.n_null += doc is None

    def flush(self) -> None:
        self.files[1].write(np.array(self.ends, "<u8").tobytes())
        self.files[2].write(np.array(self.docs, "<i8").tobytes())
        self.n_docs += len(self.docs)
        self.ends, self.docs = [], []

    def end(self) -> None:
        for f in self.files:
            f.close()

    def close(self, part: int, number: int) -> pa.RecordBatch:
        self.flush()
        self.end()
        values = (part, number, self.name, self.kind.itemsize, self.n_docs, self.n_null, self.n_ids)
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 3)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in SHARD.split(", ")])


class Stored:
    """The numbers of a file in a store that cannot map it: each slice is one read at its place."""

    def __init__(self, store: fs.FileSystem, path: str, kind: str) -> None:
        self.file, self.kind = store.open_input_file(path), np.dtype(kind)
        self.n = self.file.size() // self.kind.itemsize

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at: slice) -> np.ndarray:
        lo, hi, _ = at.indices(self.n)
        return np.frombuffer(self.file.read_at(max(0, hi - lo) * self.kind.itemsize, lo * self.kind.itemsize), self.kind)


def _mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray | Stored:
    """The file's numbers, of which slices can be taken: memory-mapped where the store is a file system."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    return Stored(store, path, kind)


def read_token_files(spark: SparkSession, shards: list[dict]) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), ids (little-endian, 32 bits)."""
    schema = "doc_id long, start long, ids binary"
    listed = spark.createDataFrame([(x["name"], x["width"], x["n_null"], x["base"], x["folder"]) for x in shards],
                                   "name string, width int, n_null long, base long, folder string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in (x for b in batches for x in b.to_pylist()):
            store, _ = _store(x["folder"])
            ids, off, doc = (_mapped(store, f"{x['name']}.{k}", kind) for k, kind in (("ids", f"<u{x['width']}"), ("off", "<u8"), ("doc", "<i8")))
            lo = 0
            while lo < len(doc):
                ends = off[lo:lo + READ_DOCS + 1].astype("<i8")
                n = min(len(ends) - 1, max(1, int(np.searchsorted(ends, ends[0] + READ_IDS, "right")) - 1))
                here = ids[int(ends[0]):int(ends[n])].astype("<u4")
                at = (ends[:n + 1] - ends[0]).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if i < x["n_null"] else d for i, d in enumerate(doc[lo:lo + n].tolist(), lo)], pa.int64()),
                    pa.array(ends[:n] + x["base"], pa.int64()),
                    pa.array([here[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary()),
                ], ["doc_id", "start", "ids"])
                lo += n

    return listed.repartition(max(1, min(len(shards), 4 * partitions(spark)))).mapInArrow(read, schema)


def token_digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what ``read_token_files`` returns."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
