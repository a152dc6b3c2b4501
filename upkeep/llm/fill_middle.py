"""Fill-in-the-middle transformation over seekable compressed texts (operator 11).

``frame`` stores each text as independent zstandard frames with cumulative
unit counts (code points).  ``transform`` chooses form and cuts from a hash of
the document id, with DataFrame functions, decompresses only the frames that
a cut falls into, and passes all others on as they are.  ``digests`` and
``output_texts`` stream the ordered frames.

Every row is transformed on its own: nothing is shuffled, and rows that share
an id share their random numbers.  Null and empty texts have no frames and
stay plain; a row without an id is hashed as an empty one.  Only the id and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm import frames as fr
from upkeep.llm.common import texts_of

MARKS = ("<P>", "<S>", "<M>")

#: Most bytes of an Arrow batch here (a longer row makes one of its own): each worker holds it as Arrow, as Python objects and as frames.
BATCH_BYTES = 256 << 10


def _in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now sends a Python worker ``BATCH_BYTES`` at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def checked_marks(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """The marks of prefix, suffix and middle, if their places in an output are unambiguous for every text without them."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            if not a or (i != j and a in b) or any(b.startswith(a[k:]) for k in range(1, len(a))):
                raise ValueError(f"marks must not be empty, equal, contain or run into one another: {marks}")
    return marks


def frame(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (code points), marked (whether the text contains a mark), frames, ends (cumulative code points): one row per row of docs."""
    marks = checked_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            rows = [fr.framed(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([any(m in t for m in marks) for t in texts]),
                 pa.array([x for x, _ in rows], pa.list_(pa.binary())), pa.array([x for _, x in rows], pa.list_(pa.int64()))],
                ["doc_id", "n", "marked", "frames", "ends"])

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return _in_small_batches(rows).mapInArrow(run, "doc_id long, n long, marked boolean, frames array<binary>, ends array<bigint>")


def draw(key: Column, number: int, seed: int) -> Column:
    """Unsigned 32-bit number ``number`` (from 1) of a document: 8 hexadecimal digits of the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def transform(framed: DataFrame, seed: int = 1, moved: int = 90, spm: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Rows of ``frame`` (made with the same marks) as doc_id, n, form, cut, until, output, output_ends.

    ``moved`` of 100 documents are transformed, ``spm`` of 100 of these in the
    order suffix, prefix, middle, the others as prefix, suffix, middle.  The
    prefix ends after ``cut`` code points, the middle after ``until`` (both
    null if plain); output is a list of frames, output_ends their cumulative
    code points.  Texts that are empty or contain a mark stay plain.
    """
    p, s, m = (x.encode() for x in checked_marks(marks))
    one, two = (F.pmod(draw(F.col("doc_id"), k, seed), F.col("n") + 1) for k in (1, 2))
    plain = (F.col("n") == 0) | F.col("marked") | (F.pmod(draw(F.col("doc_id"), 3, seed), F.lit(100)) >= moved)
    form = F.when(plain, "plain").when(F.pmod(draw(F.col("doc_id"), 4, seed), F.lit(100)) < spm, "spm").otherwise("psm")
    chosen = framed.select("doc_id", "n", form.alias("form"), F.when(~plain, F.least(one, two)).alias("cut"), F.when(~plain, F.greatest(one, two)).alias("until"), "frames", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs, ends_of = [], []
            columns = (batch.column(c).to_pylist() for c in ("n", "form", "cut", "until", "frames", "ends"))
            for n, kind, cut, until, frames, ends in zip(*columns, strict=True):
                if kind != "plain":
                    out = fr.Writer()
                    parts = {p: (0, cut), s: (until, n), m: (cut, until)}
                    for mark in ((s, p, m) if kind == "spm" else (p, s, m)):
                        out.text(mark)
                        fr.copy_units(out, frames, ends, *parts[mark])
                    out.close()
                    frames, ends = out.frames, out.ends
                outputs.append(frames)
                ends_of.append(ends)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n", "form", "cut", "until")), pa.array(outputs, pa.list_(pa.binary())), pa.array(ends_of, pa.list_(pa.int64()))],
                ["doc_id", "n", "form", "cut", "until", "output", "output_ends"])

    return _in_small_batches(chosen).mapInArrow(run, "doc_id long, n long, form string, cut long, until long, output array<binary>, output_ends array<bigint>")


def restored(frames: list[bytes], form: str, marks: tuple[str, str, str] = MARKS) -> Iterator[bytes]:
    """The text that an output was made of, from output and form alone, one frame in memory at a time."""
    if form == "plain":
        yield from fr.stream(frames)
        return
    p, s, m = (x.encode() for x in marks)
    order = [s, p, m] if form == "spm" else [p, s, m]
    at, sizes = fr.find(frames, order)
    if at[0] != 0 or -1 in at:
        raise ValueError(f"this is no output in the form {form}")
    ranges = {mark: (lo + len(mark), hi) for mark, lo, hi in zip(order, at, [*at[1:], sizes[-1]], strict=True)}
    for mark in (p, m, s):
        yield from fr.stream_bytes(frames, sizes, *ranges[mark])


def _sha256(parts: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for x in parts:
        digest.update(x)
    return digest.hexdigest()


def digests(transformed: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n, form, cut, until, output_sha256 and restored_sha256 (of the text rebuilt from the output), from streamed frames."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, outputs = batch.column("form").to_pylist(), batch.column("output").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n", "form", "cut", "until")), pa.array([_sha256(fr.stream(x)) for x in outputs], pa.string()),
                 pa.array([_sha256(restored(x, f, marks)) for x, f in zip(outputs, forms, strict=True)], pa.string())],
                ["doc_id", "n", "form", "cut", "until", "output_sha256", "restored_sha256"])

    return _in_small_batches(transformed).mapInArrow(run, "doc_id long, n long, form string, cut long, until long, output_sha256 string, restored_sha256 string")


def output_texts(transformed: DataFrame) -> DataFrame:
    """doc_id, form and the output as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"".join(fr.stream(x)).decode() for x in batch.column("output").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("form"), pa.array(texts, pa.string())], ["doc_id", "form", "output"])

    return _in_small_batches(transformed.select("doc_id", "form", "output")).mapInArrow(run, "doc_id long, form string, output string")
