"""Packing documents into sequences of bounded length (operator 10).

Documents longer than a sequence are cut into whole sequences and one shorter
first piece.  Pieces are dealt to shards of bounded size; each shard packs
its pieces best-fit and then improves the underfull sequences by local search.
What stays underfull in the shards meets in further rounds until one shard holds it.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import materialize, partitions, texts_of
from upkeep.llm.tokens import encoder, tokenizer_path

#: Pieces that one shard holds, about: what one task keeps in memory.
SHARD_PIECES = 50_000


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2,
           id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False, special: bool = True) -> DataFrame:
    """Every document's ids with ``end_id`` (null text: empty), cut if longer than ``capacity``.

    The pieces of a cut document have ``capacity`` ids each, but for the first,
    which has the rest.  with_ids: the ids too, little-endian 32-bit.
    ``special`` as for ``tokens.Encoder``.
    Repeated rows each give their own pieces.
    """
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, special), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, coded in zip(batch.column("doc_id").to_pylist(), encode.each(texts_of(batch, "text")), strict=True):
                ids = coded + end
                n = len(ids) // 4
                first = n if n <= capacity else n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    part = ids[4 * a:4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(part), *([part] * with_ids)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] * with_ids)]
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return rows.mapInArrow(cut, PIECE + ", ids binary" * with_ids)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: lists of indices into ``sizes``, which fall from large to small."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = defaultdict(list)
    open_ = 0  # bit f: some bin has f free
    for i, size in enumerate(sizes):
        if fitting := open_ >> size:
            free = size + (fitting & -fitting).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                open_ ^= 1 << free
            bins[at].append(i)
        else:
            free, at = capacity, len(bins)
            bins.append([i])
        if left := free - size:
            by_free[left].append(at)
            open_ |= 1 << left
    return bins


class _Slots:
    """What the underfull bins could take: (taken, free) of a bin, where ``taken`` is 0 or the size of one or two of its pieces that would leave.

    A piece of more than ``taken`` and at most ``taken + free`` can go there.
    """

    def __init__(self, capacity: int) -> None:
        self.bins: dict[tuple[int, int], dict[int, None]] = defaultdict(dict)
        self.free = [0] * (capacity + 1)  # by taken; bit f: some bin has this slot and f free
        self.of: dict[int, tuple[int, set[int]]] = {}

    def add(self, k: int, free: int, held: list[int]) -> None:
        one = sorted(set(held))
        taken = {0, *one, *(x + y for i, x in enumerate(one) for y in one[i + 1:]), *(2 * x for x in one if held.count(x) > 1)}
        self.of[k] = (free, taken)
        for t in taken:
            self.bins[t, free][k] = None
            self.free[t] |= 1 << free

    def remove(self, k: int) -> None:
        free, taken = self.of.pop(k)
        for t in taken:
            at = self.bins[t, free]
            del at[k]
            if not at:
                del self.bins[t, free]
                self.free[t] ^= 1 << free

    def best(self, size: int, free: int) -> tuple[int, int, int] | None:
        """(gain, bin, taken) of the slot that a piece of a bin with ``free`` fills most; of several, of a fullest bin.

        A move goes to a bin that is fuller than the rest of the giving one, an exchange to one at least as full as that.
        """
        if fits := (self.free[0] & ((1 << (free + size)) - 1)) >> size:
            least = size + (fits & -fits).bit_length() - 1
            return size, next(iter(self.bins[0, least])), 0
        for taken in range(max(1, size - free), size):
            need = size - taken
            if fits := (self.free[taken] & ((2 << free) - 1)) >> need:
                least = need + (fits & -fits).bit_length() - 1
                return need, next(iter(self.bins[taken, least])), taken
        return None


def improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Local search over the underfull bins, until none can give anything.

    The emptiest bin gives pieces to the others: a piece moves, changes places
    with one smaller piece, or with two whose sum is smaller, whichever fills
    the other bin most.  Each step raises the sum of squared fills, as the
    receiving bin is at least as full.  A bin that is empty goes; one that
    can give nothing more stays as it is, and is tried again when a bin has
    changed so that it can take one of its pieces.
    """
    fills = [sum(sizes[i] for i in b) for b in bins]
    done = [b for b, f in zip(bins, fills, strict=True) if f == capacity]
    rest = {k: b for k, (b, f) in enumerate(zip(bins, fills, strict=True)) if f < capacity}
    left = sum(fills[k] for k in rest)
    if len(rest) < 2 or left > (len(rest) - 1) * capacity:
        return bins  # as few bins as their sum allows
    slots, stuck = _Slots(capacity), defaultdict(dict)  # stuck: by size of a piece, the bins that could not give it
    still: set[int] = set()
    for k, b in rest.items():
        slots.add(k, capacity - fills[k], [sizes[i] for i in b])
    open_ = [(fills[k], k) for k in rest]
    heapq.heapify(open_)

    def reopen(k: int) -> None:
        still.discard(k)
        for i in rest[k]:
            stuck[sizes[i]].pop(k, None)
            if not stuck[sizes[i]]:
                del stuck[sizes[i]]
        heapq.heappush(open_, (fills[k], k))

    def changed(k: int) -> None:
        """Bins that can now give to bin k are open again."""
        free, taken = slots.of[k]
        for size in [s for s in stuck if any(t < s <= t + free for t in taken)]:
            for j in [j for j in stuck.get(size, ()) if j != k and (free < capacity - fills[j] + size if free >= size else free <= capacity - fills[j])]:
                reopen(j)

    while open_ and left <= (len(rest) - 1) * capacity:
        fill, source = heapq.heappop(open_)
        if source not in rest or source in still or fill != fills[source]:
            continue
        slots.remove(source)
        best = None  # (gain of the target, target, taken, size given)
        for size in sorted({sizes[i] for i in rest[source]}, reverse=True):
            if (found := slots.best(size, capacity - fill)) and (best is None or found[0] > best[0]):
                best = (*found, size)
        if best is None:
            still.add(source)
            for i in rest[source]:
                stuck[sizes[i]][source] = None
            slots.add(source, capacity - fill, [sizes[i] for i in rest[source]])
            continue
        gain, k, taken, size = best
        if k in still:
            reopen(k)
        slots.remove(k)
        back = _summing(rest[k], sizes, taken)
        given = next(i for i in rest[source] if sizes[i] == size)
        rest[source] = [x for x in rest[source] if x != given] + back
        rest[k] = [x for x in rest[k] if x not in back] + [given]
        fills[source] -= gain
        fills[k] += gain
        if fills[k] == capacity:
            done.append(rest.pop(k))
            left -= capacity
        if not rest[source]:
            del rest[source]
        for j in (source, k):
            if j in rest:
                slots.add(j, capacity - fills[j], [sizes[i] for i in rest[j]])
                heapq.heappush(open_, (fills[j], j))
        for j in (source, k):
            if j in rest:
                changed(j)
    return done + list(rest.values())


def _summing(pieces_: list[int], sizes: list[int], total: int) -> list[int]:
    """None, one or two of the pieces, of ``total`` together."""
    if not total:
        return []
    for a, x in enumerate(pieces_):
        if sizes[x] == total:
            return [x]
        for y in pieces_[a + 1:]:
            if sizes[x] + sizes[y] == total:
                return [x, y]
    raise AssertionError("no such pieces")


def _pack(rows: list[tuple], capacity: int) -> list[list[int]]:
    """Bins of indices into ``rows`` (doc_id, piece, start, length, ids_crc32)."""
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][3], rows[i][0] is not None, rows[i][0] or 0, rows[i][1], rows[i][4]))
    sizes = [rows[i][3] for i in order]
    return [[order[i] for i in b] for b in improve(best_fit(sizes, capacity), sizes, capacity)]


def pack(items: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Deals all pieces (columns of ``PIECE``) to sequences; adds sequence_id and offset.

    Pieces of one sequence stand without gaps from offset 0.  A round deals
    its pieces evenly to shards by their place in a stored table, so repeated
    rows spread too.  The emptiest sequences of each shard are dealt again
    with those of the others, until one shard holds them all; every other
    sequence is final.  They are so many that what is free in the final ones is less than one
    sequence over all shards, or as hold a third of a shard's pieces if that
    is less, but at least one.  After a round that left more than two thirds of its pieces
    (a sequence of more pieces than a third of a shard) shards are twice as large, so
    the rounds end.  No piece is dropped.  An empty table gives none.
    """
    spark = items.sparkSession
    done, rest, level = [], materialize(items.select(*[c.split()[0] for c in PIECE.split(", ")])), 0
    before = 0  # pieces of the round before
    while True:
        n = rest.count()
        if before and 3 * n > 2 * before:
            shard_pieces *= 2
        shards, last = max(1, -(-n // shard_pieces)), n <= shard_pieces
        dealt = rest.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(level)), F.lit(shards)).cast("long"))

        def run(batches: Iterator[pa.RecordBatch], level=level, last=last, shards=shards, shard_pieces=shard_pieces) -> Iterator[pa.RecordBatch]:
            shard, rows = None, []

            def packed() -> Iterator[pa.RecordBatch]:
                out, bins = [], _pack(rows, capacity)
                fills = [sum(rows[i][3] for i in b) for b in bins]
                again, room, free = set(), shard_pieces // 3, capacity * len(bins) - sum(fills)
                for b in () if last else sorted(range(len(bins)), key=lambda b: (fills[b], b)):
                    room -= len(bins[b])
                    if (room < 0 and again) or free * shards < capacity:
                        break
                    again.add(b)
                    free -= capacity - fills[b]
                for b, members in enumerate(bins):
                    at, number, final = 0, (level << 58) + (shard << 32) + b, b not in again
                    for i in members:
                        out.append((*rows[i], number, at, final))
                        at += rows[i][3]
                for lo in range(0, len(out), 50_000):
                    cols = zip(*out[lo:lo + 50_000], strict=True)
                    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                     ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "final"])

            for batch in batches:
                for *row, s in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                    if s != shard and rows:
                        yield from packed()
                        rows = []
                    shard = s
                    rows.append(tuple(row))
            if rows:
                yield from packed()

        out = materialize(dealt.repartition(max(1, min(shards, 8 * partitions(spark))), "shard").sortWithinPartitions("shard")
                          .mapInArrow(run, PIECE + ", sequence_id long, offset long, final boolean"))
        done.append(out.where("final").drop("final"))
        if last:
            break
        rest, level, before = materialize(out.where("not final").drop("final", "sequence_id", "offset")), level + 1, n
    result = done[0]
    for x in done[1:]:
        result = result.unionByName(x)
    return result


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, special: bool = True) -> DataFrame:
    return pack(pieces(docs, capacity, tokenizer, end_id, special=special), capacity)


def sequences(docs: DataFrame, layout: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, special: bool = True) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (array of int, pieces by offset).

    Pieces meet their place by document, piece and content; a sequence has at
    most ``capacity`` ids, so no group grows.  doc_id must tell documents apart here.
    """
    parts = pieces(docs, capacity, tokenizer, end_id, with_ids=True, special=special)
    at = layout.select(F.col("doc_id").alias("_doc"), F.col("piece").alias("_piece"), "sequence_id", "offset")
    joined = parts.join(at, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("piece") == F.col("_piece")))
    grouped = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.frombuffer(b"".join(p["ids"] for p in row), "<u4").astype("int32") for row in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                             ["sequence_id", "n_tokens", "ids"])

    return grouped.mapInArrow(build, "sequence_id long, n_tokens long, ids array<int>")
