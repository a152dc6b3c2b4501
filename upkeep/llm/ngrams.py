"""Character n-gram tables, and scoring of texts by joins with them.

A symbol is a code point, 21 bits.  An n-gram of up to six symbols is two 64-bit numbers: ``gram``
has its last three symbols, the last one lowest, and ``head`` those before, in the same way (0 for
n-grams of up to three).  Its context is the n-gram without the last symbol, its shorter forms are its
low bits.

Scoring does not send every n-gram of every text through a join: a block of
texts sends each of its distinct n-grams once, gets their values back beside
the texts themselves, and adds the values up locally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import partitions, pieces, texts_of

BITS, EDGE = 21, (1 << 21) - 1  # bits of a symbol; the symbol before a text's first, above all code points
SYMBOLS = 1 << BITS
KEY, LOW = ["head", "gram"], 3  # columns of an n-gram; symbols in the second

#: Text of a block and of one slice of it, about.
BLOCK_BYTES, PIECE_BYTES = 64 << 20, 512 << 10


Keys = tuple[np.ndarray, np.ndarray]  # head and gram
NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


def _line(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts one after the other, their number in each, their places in a line with ``order - 1`` places before each text, and the length of that line as an array of edges."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    pad = order - 1
    place = np.arange(len(raw)) + np.repeat(np.arange(1, len(texts) + 1) * pad, lengths)
    return raw, lengths, place, np.full(len(raw) + len(texts) * pad, EDGE, np.int64)


def _joined(line: np.ndarray, bits: int, first: int, last: int) -> np.ndarray:
    """The symbols ``first`` to ``last - 1`` places before each, the nearest lowest."""
    code = np.zeros(len(line), np.int64)
    for back in range(first, min(last, len(line))):
        code[back:] += line[:len(line) - back] << (bits * (back - first))
    return code


def grams(texts: list[str], order: int) -> tuple[Keys, np.ndarray]:
    """The n-gram ending at each character of the texts, and each text's number of characters.

    Texts are preceded by ``order - 1`` edge symbols, so every character has one n-gram.
    """
    raw, lengths, place, line = _line(texts, order)
    line[place] = raw
    return (_joined(line, BITS, LOW, order)[place], _joined(line, BITS, 0, min(order, LOW))[place]), lengths


def distinct(texts: list[str], order: int) -> tuple[Keys, np.ndarray]:
    """The different n-grams of the texts and how often each occurs.

    The code points that occur are numbered; where an n-gram of such numbers fits into 63 bits, one sort of
    numbers does, else the two halves are ranked first.
    """
    raw, _, place, line = _line(texts, order)
    if not len(raw):
        return NONE, np.empty(0, np.int64)
    seen = np.zeros(0x110000, bool)
    seen[raw] = True
    alphabet = np.append(np.flatnonzero(seen), EDGE)
    bits = (len(alphabet) - 1).bit_length()
    if bits * order > 63:
        (head, gram), _ = grams(texts, order)
        heads, a = np.unique(head, return_inverse=True)
        lows, b = np.unique(gram, return_inverse=True)
        code, n = np.unique(a * len(lows) + b, return_counts=True)
        return (heads[code // len(lows)], lows[code % len(lows)]), n
    number = np.zeros(0x110000, np.int64)
    number[alphabet[:-1]] = np.arange(len(alphabet) - 1)
    line[:] = len(alphabet) - 1
    line[place] = number[raw]
    code, n = np.unique(_joined(line, bits, 0, order)[place], return_counts=True)
    head, gram = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    for back in range(order):
        symbol = alphabet[(code >> (bits * back)) & ((1 << bits) - 1)]
        if back < LOW:
            gram += symbol << (BITS * back)
        else:
            head += symbol << (BITS * (back - LOW))
    return (head, gram), n


def _added(a: Keys, n: np.ndarray, b: Keys, m: np.ndarray) -> tuple[Keys, np.ndarray]:
    """The n-grams of both, sorted, with the sums of their counts."""
    head, gram, both = (np.concatenate(x) for x in ((a[0], b[0]), (a[1], b[1]), (n, m)))
    if not len(head):
        return NONE, np.empty(0, np.int64)
    at = np.lexsort((gram, head))
    head, gram = head[at], gram[at]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(head) != 0) | (np.diff(gram) != 0))))
    return (head[first], gram[first]), np.add.reduceat(both[at], first)


def form(size: int) -> list[Column]:
    """The columns of an n-gram's form of ``size`` symbols."""
    low, high = min(size, LOW), max(size - LOW, 0)
    head = F.col("head").bitwiseAND((1 << (BITS * high)) - 1) if high else F.lit(0).cast("long")
    return [head.alias("head"), F.col("gram").bitwiseAND((1 << (BITS * low)) - 1).alias("gram")]


def context(size: int) -> list[Column]:
    """``c_head`` and ``c_gram``: the context of an n-gram of ``size`` symbols."""
    if size == 1:
        return [F.lit(0).cast("long").alias("c_head"), F.lit(0).cast("long").alias("c_gram")]
    gram, head = F.shiftright("gram", BITS), F.lit(0).cast("long")
    if size > LOW:
        gram = gram.bitwiseOR(F.shiftleft(F.col("head").bitwiseAND(SYMBOLS - 1), BITS * (LOW - 1)))
        head = F.shiftright("head", BITS)
    return [head.alias("c_head"), gram.alias("c_gram")]


def keyed(codes: DataFrame) -> DataFrame:
    """``codes`` with ``head``, which n-grams of up to three symbols may leave out."""
    return codes if "head" in codes.columns else codes.withColumn("head", F.lit(0).cast("long"))


def _numbered(rows: DataFrame) -> DataFrame:
    """With the number of the scan's partition, which stays the same within a union."""
    return rows.withColumn("_part", F.spark_partition_id())


def _block(piece: pa.RecordBatch, number: int) -> int:
    return (piece.column("_part")[0].as_py() << 24) + number


def _batches_of(keys: Keys, third: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(third), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000]) for x in (*keys, third)], names)


def counts(texts: DataFrame, order: int, column: str = "text") -> DataFrame:
    """head, gram, count over all texts; each block adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, sums = None, NONE, np.empty(0, np.int64)
        for number, piece in pieces(batches, column, PIECE_BYTES, BLOCK_BYTES):
            if block is not None and number != block:
                yield from _batches_of(keys, sums, [*KEY, "n"])
                keys, sums = NONE, np.empty(0, np.int64)
            block = number
            keys, sums = _added(keys, sums, *distinct(texts_of(piece, column), order))
        yield from _batches_of(keys, sums, [*KEY, "n"])

    return texts.select(column).mapInArrow(run, "head long, gram long, n long").groupBy(*KEY).agg(F.sum("n").alias("count"))


def wanted(texts: DataFrame, order: int, column: str = "text") -> DataFrame:
    """head, gram, block: the distinct n-grams of each block of texts, in the blocks that ``score`` makes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, sums = None, NONE, np.empty(0, np.int64)
        for count, piece in pieces(batches, column, PIECE_BYTES, BLOCK_BYTES):
            number = _block(piece, count)
            if block is not None and number != block:
                yield from _batches_of(keys, np.full(len(sums), block, np.int64), [*KEY, "block"])
                keys, sums = NONE, np.empty(0, np.int64)
            block = number
            keys, sums = _added(keys, sums, *distinct(texts_of(piece, column), order))
        if block is not None:
            yield from _batches_of(keys, np.full(len(sums), block, np.int64), [*KEY, "block"])

    return _numbered(texts.select(column)).mapInArrow(run, "head long, gram long, block long")


class _Table:
    """Values of a block's n-grams: a direct table by hash, and binary search where two n-grams share a place."""

    def __init__(self, keys: Keys, values: np.ndarray) -> None:
        mixed = self._mixed(keys)
        order = np.argsort(mixed)
        self.mixed, self.head, self.gram, self.values = mixed[order], keys[0][order], keys[1][order], values[order]
        self.shift = np.uint64(64 - max(10, (4 * len(values)).bit_length()))
        self.slot = np.zeros(1 << int(np.uint64(64) - self.shift), np.int32)
        self.slot[self.mixed >> self.shift] = np.arange(len(values), dtype=np.int32)

    @staticmethod
    def _mixed(keys: Keys) -> np.ndarray:
        x = keys[1].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + keys[0].view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)

    def __call__(self, keys: Keys) -> np.ndarray:
        head, gram = keys
        if not len(gram):
            return np.empty(0)
        if not len(self.values):
            raise RuntimeError("the scoring pass met texts that the first pass did not: the input must be a stored table")
        mixed = self._mixed(keys)
        at = self.slot[mixed >> self.shift].astype(np.int64)
        other = np.flatnonzero((self.gram[at] != gram) | (self.head[at] != head))
        found = np.searchsorted(self.mixed, mixed[other])
        while len(other):
            if (found >= len(self.mixed)).any() or (self.mixed[found] != mixed[other]).any():
                raise RuntimeError("the scoring pass met n-grams that the first pass did not: the input must be a stored table")
            at[other] = found
            wrong = (self.gram[found] != gram[other]) | (self.head[found] != head[other])
            other, found = other[wrong], found[wrong] + 1  # n-grams of the same hash stand side by side
        return self.values[at]


def score(rows: DataFrame, valued: DataFrame, order: int, column: str = "text", keep: bool = True) -> DataFrame:
    """``rows`` (without ``column`` unless ``keep``) with ``_chars`` (characters) and ``_sum`` (of the values of their n-grams).

    valued: head, gram, block, value for each row of ``wanted`` over the same stored
    table; both passes read it in the same order.  Rows travel to their
    block's values as compressed Arrow messages.
    """
    fields = [f for f in rows.schema.fields if keep or f.name != column]
    names = [f.name for f in fields]

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, piece in pieces(batches, column, PIECE_BYTES, BLOCK_BYTES):
            block, piece, sink = _block(piece, number), piece.drop_columns(["_part"]), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                out.write_batch(piece)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             ["block", "kind", *KEY, "value", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, heads, keys, values, lookup = None, [], [], [], None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(blocks)], strict=True):
                if a == b:
                    continue
                if blocks[a] != block:
                    block, heads, keys, values, lookup = blocks[a], [], [], [], None
                if kinds[a] == 0:
                    heads.append(batch.column("head").slice(a, b - a).to_numpy())
                    keys.append(batch.column("gram").slice(a, b - a).to_numpy())
                    values.append(batch.column("value").slice(a, b - a).to_numpy())
                    continue
                if lookup is None:
                    lookup = _Table((np.concatenate(heads), np.concatenate(keys)), np.concatenate(values)) if keys else _Table(NONE, np.empty(0))
                for data in batch.column("data").slice(a, b - a):
                    with pa.ipc.open_stream(data.as_buffer()) as source:
                        piece = source.read_next_batch()
                    code, lengths = grams(texts_of(piece, column), order)
                    of_char = np.concatenate(([0.0], np.cumsum(lookup(code))))
                    ends = np.cumsum(lengths)
                    yield pa.RecordBatch.from_arrays([*piece.select(names).columns, pa.array(lengths), pa.array(of_char[ends] - of_char[ends - lengths])], [*names, "_chars", "_sum"])

    sent = _numbered(rows).mapInArrow(wrap, "block long, kind int, head long, gram long, value double, data binary")
    back = valued.select("block", F.lit(0).alias("kind"), *KEY, "value", F.lit(None).cast("binary").alias("data"))
    both = back.unionByName(sent).repartition(4 * partitions(rows.sparkSession), "block").sortWithinPartitions("block", "kind")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return both.mapInArrow(run, f"{out}, _chars long, _sum double")


def shorter(codes: DataFrame, size: int) -> DataFrame:
    """The distinct n-grams' forms of ``size`` symbols."""
    return codes.select(*form(size)).distinct()


__all__ = ["BITS", "EDGE", "KEY", "SYMBOLS", "context", "counts", "distinct", "form", "grams", "keyed", "score", "shorter", "wanted"]
