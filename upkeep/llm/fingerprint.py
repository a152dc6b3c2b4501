"""Document fingerprints of improbable features (operator 1).

A feature is a window of bytes.  Windows are ranked by how rare their entropy
is in the corpus; in each stretch of ``REACH`` windows the rarest is noted, and a window
noted by ``POPULAR`` stretches or more is a feature of the text.  Features are hashed
into Bloom filters, which are chained as they fill up.  Two fingerprints
are compared filter by filter, by the bits they share beyond what chance gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import in_order, materialize, texts_of
from upkeep.llm.shingles import mixed

#: Bytes of a window; windows of a stretch (a power of two); stretches that must note a window; classes of entropy.
WINDOW, REACH, POPULAR, CLASSES = 32, 64, 16, 1000
#: Bits of a filter, features in it, bits a feature sets.
FILTER_BITS, FILTER_FEATURES, FEATURE_BITS = 2048, 160, 5
#: Bytes that are ranked at once, unless one text is longer.
GROUP = 1 << 18

_c = np.arange(1, WINDOW + 1, dtype=float)
_cost = np.concatenate(([0.0], _c * np.log2(_c)))
_STEP = np.concatenate(([0], np.round(np.diff(_cost) * (1 << 16)))).astype(np.int64)  # c log c of the c-th like byte, less that of the one before
_MOST = int(_STEP.sum())


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class of entropy (0 to CLASSES) of the window that starts at each byte; the sum rolls along with the window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int16)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    total = np.empty(n, np.int64)
    total[0] = _STEP[1 + before[:WINDOW]].sum()
    total[1:] = _STEP[1 + before[WINDOW:]] - _STEP[1 + after[:n - 1]]
    np.cumsum(total, out=total)
    return ((_MOST - total) * CLASSES // _MOST).astype(np.int16)


def _groups(coded: list[bytes]) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(coded):
        hi, size = lo + 1, len(coded[lo])
        while hi < len(coded) and size + len(coded[hi]) <= GROUP:
            size += len(coded[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _windows(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes in a row (short ones filled up with zeros), their starts, their numbers of windows, the classes of all windows."""
    filled = [x.ljust(WINDOW, b"\0") if x else b"" for x in coded]
    sizes = np.array([len(x) for x in filled], np.int64)
    data = np.frombuffer(b"".join(filled), np.uint8)
    return data, np.cumsum(sizes) - sizes, np.maximum(0, sizes - WINDOW + 1), entropy_classes(data)


def class_counts(docs: DataFrame, column: str = "text") -> DataFrame:
    """class, n: how many windows of all texts have each class of entropy (``CLASSES`` + 1 rows at most)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            coded = [t.encode() for t in texts_of(batch, column)]
            for lo, hi in _groups(coded):
                _, starts, n, classes = _windows(coded[lo:hi])
                for s, k in zip(starts, n, strict=True):
                    if k:
                        total += np.bincount(classes[s:s + k], minlength=CLASSES + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["class", "n"])

    return docs.select(column).mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))


def rarity(counts: list[tuple[int, int]]) -> np.ndarray:
    """Rank of each class: 0 for the rarest; ties by class; classes never seen come first, as the rarest."""
    n = np.zeros(CLASSES + 1, np.int64)
    for k, v in counts:
        n[k] = v
    rank = np.empty(CLASSES + 1, np.int64)
    rank[np.lexsort((np.arange(CLASSES + 1), n))] = np.arange(CLASSES + 1)
    return rank


def digests(texts: list[str], rank: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """For each text its chain of filters (rows of 64-bit numbers) and the features of the last one.

    An empty text has no filter.  A text shorter than a window is one window, filled up with zeros.
    Stretches reach over both ends of a text, so the rarest window of a text is always a feature.
    """
    out: list[tuple[np.ndarray, int]] = []
    coded = [t.encode() for t in texts]
    for lo, hi in _groups(coded):
        data, starts, n, classes = _windows(coded[lo:hi])
        gap = REACH - 1
        at = np.cumsum(n + gap) - n  # where each text's windows begin in the padded line
        size = int((n + gap).sum()) + gap
        bits = size.bit_length()
        line = np.full(size, (CLASSES + 1) << bits, np.int64) + np.arange(size)
        for s, k, a in zip(starts, n, at, strict=True):
            line[a:a + k] = (rank[classes[s:s + k]] << bits) + np.arange(a, a + k)
        reach = 1
        while reach < REACH:
            line = np.minimum(line[:-reach], line[reach:])
            reach *= 2
        noted = line & ((1 << bits) - 1)
        edge = np.concatenate(([0], np.flatnonzero(noted[1:] != noted[:-1]) + 1, [len(noted)])) if len(noted) else np.zeros(1, int)
        often = np.diff(edge) >= POPULAR
        place = noted[edge[:-1]][often]
        real = line[edge[:-1]][often] >> bits <= CLASSES
        place = place[real]
        owner = np.searchsorted(at, place, side="right") - 1
        first = starts[owner] + place - at[owner]
        window = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[first].copy().view("<u8") if len(first) else np.empty((0, WINDOW // 8), np.uint64)
        h = np.zeros(len(first), np.uint64)
        for k in range(WINDOW // 8):
            h = mixed((h ^ window[:, k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
        features = np.bincount(owner, minlength=hi - lo)
        filters = -(-features // FILTER_FEATURES)
        base = np.cumsum(filters) - filters
        nth = np.arange(len(owner)) - (np.cumsum(features) - features)[owner]
        row = (base[owner] + nth // FILTER_FEATURES) * FILTER_BITS
        flags = np.zeros(int(filters.sum()) * FILTER_BITS, bool)
        for k in range(FEATURE_BITS):
            flags[row + ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(flags).view("<u8").reshape(-1, FILTER_BITS // 64)
        for d in range(hi - lo):
            f = int(filters[d])
            out.append((packed[base[d]:base[d] + f], int(features[d] - (f - 1) * FILTER_FEATURES) if f else 0))
    return out


def spelled(digest: tuple[np.ndarray, int]) -> str:
    """Number of filters, features in the last one, filters in base 64."""
    filters, last = digest
    return f"{len(filters)}:{last}:{base64.b64encode(filters.tobytes()).decode()}"


def parsed(text: str) -> tuple[np.ndarray, int]:
    n, last, data = text.split(":")
    return np.frombuffer(base64.b64decode(data), "<u8").reshape(int(n), FILTER_BITS // 64), int(last)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    """0 to 1.  Each filter of the shorter chain counts with the best filter of the other, in proportion to its features.

    Shared bits count from what two unrelated filters so full share by
    chance, and three deviations more, up to all bits of the emptier one.
    Equal fingerprints give 1; an empty text is like an empty text only.
    """
    if len(a[0]) == len(b[0]) and a[1] == b[1] and np.array_equal(a[0], b[0]):
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    if (len(a[0]), a[1]) > (len(b[0]), b[1]):
        a, b = b, a
    na, nb = np.bitwise_count(a[0]).sum(1).astype(float), np.bitwise_count(b[0]).sum(1).astype(float)
    score = np.zeros(len(a[0]))
    for i, row in enumerate(a[0]):
        shared = np.bitwise_count(row & b[0]).sum(1)
        chance = na[i] * nb / FILTER_BITS
        floor = chance + 3 * np.sqrt(chance * (1 - nb / FILTER_BITS))
        most = np.minimum(na[i], nb)
        with np.errstate(divide="ignore", invalid="ignore"):
            each = np.where(most > floor, (shared - floor) / (most - floor), (shared >= most).astype(float))
        score[i] = min(1.0, max(0.0, float(each.max())))
    weight = np.full(len(a[0]), float(FILTER_FEATURES))
    weight[-1] = a[1]
    return float((score * weight).sum() / weight.sum())


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, after: str) -> str:
    """The last quarter of the text's characters gives way to as many first ones of the next text."""
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


def _result(ids: list, texts: list[str], prints: list, afters: list[str], after_prints: list, rank: np.ndarray) -> pa.RecordBatch:
    changed = [edited(t, a) for t, a in zip(texts, afters, strict=True)]
    other = digests(changed, rank)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
        pa.array([spelled(p) for p in prints]), pa.array([spelled(p) for p in other]),
        pa.array([likeness(p, q) for p, q in zip(prints, other, strict=True)], pa.float64()),
        pa.array([likeness(p, q) for p, q in zip(prints, after_prints, strict=True)], pa.float64()),
    ], [x.split()[0] for x in RESULT.split(", ")])


def fingerprints(docs: DataFrame, column: str = "text", counts: list[tuple[int, int]] | None = None) -> DataFrame:
    """``docs`` with ``fingerprint``.  counts: rarity of entropy classes, by default those of these documents."""
    rank = rarity(counts if counts is not None else [(r["class"], r["n"]) for r in class_counts(docs, column).collect()])
    docs = docs.drop("fingerprint")
    fields = docs.schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [spelled(x) for x in digests(texts_of(batch, column), rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*fields, "fingerprint"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", fingerprint string")


def edits(docs: DataFrame, counts: list[tuple[int, int]] | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they are (see ``RESULT``).

    The next document is that by ascending doc_id (null first; rows of one
    doc_id by a hash of their text); after the last comes the first, which is the same
    one if there is only one.  Null text counts as empty.  Documents are
    range-partitioned once; the last one of each partition waits for
    the first of the next partition that has any, and both travel with a few rows for each partition.
    """
    rank = rarity(counts if counts is not None else [(r["class"], r["n"]) for r in class_counts(docs).collect()])
    rows = in_order(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text")
    names = [x.split()[0] for x in RESULT.split(", ")]
    wide = [*names, "part", "edge", "text"]

    def tagged(batch: pa.RecordBatch, part: int) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.string())], wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None

        def alone(row: tuple, edge: int) -> pa.RecordBatch:
            doc, text, _ = row
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), *(pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())),
                                               pa.array([part], pa.int32()), pa.array([edge], pa.int32()), pa.array([text])], wide)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                texts = piece.column("text").to_pylist()
                here = list(zip(piece.column("doc_id").to_pylist(), texts, digests(texts, rank), strict=True))
                if last is None:
                    yield alone(here[0], 1)
                line = ([last] if last else []) + here
                if len(line) > 1:
                    ids, texts, prints = (list(x) for x in zip(*line, strict=True))
                    yield tagged(_result(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], rank), part)
                last = line[-1]
        if last is not None:
            yield alone(last, 2)

    done = materialize(rows.select("doc_id", "text").mapInArrow(run, f"{RESULT}, part int, edge int, text string"))
    heads, tails = done.where("edge = 1").select("part", F.col("text").alias("after")), done.where("edge = 2").select("part", "doc_id", "text")
    # one row for each partition that has documents: which one follows it, the first after the last
    line = Window.orderBy("part")
    follows = heads.select("part", F.coalesce(F.lead("part").over(line), F.first("part").over(line)).alias("next"))
    open_ = tails.join(F.broadcast(follows), "part").join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "after")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, afters = texts_of(batch, "text"), texts_of(batch, "after")
            yield _result(batch.column("doc_id").to_pylist(), texts, digests(texts, rank), afters, digests(afters, rank), rank)

    return done.where("edge = 0").select(*names).unionByName(open_.mapInArrow(close, RESULT))


__all__ = ["class_counts", "digests", "edits", "fingerprints", "likeness", "parsed", "rarity", "spelled"]
