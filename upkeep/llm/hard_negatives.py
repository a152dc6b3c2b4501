"""Hard-negative mining by exact integer matrix products (operator 13).

Anchors and candidates meet in the cells of a grid: a cell holds one bounded
block of anchors and streams one group of candidates past it, tile by tile.  A
tile's scores are one Strassen product of int64 matrices; shorter vectors and
odd sides are padded with zeros.  int64 arithmetic is exact modulo 2^64, so the
sums and differences of the recursion may wrap and the scores are still right,
as they fit.  Each anchor keeps small heaps, which merge by sorting: first its
nearest rows of the same label, then, for each of these, the best rows of
another label in the window that its score opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import materialize, partitions

#: Bytes of a cell's anchors and their heaps; rows of a tile on either side; most candidates of a cell; side below which products are not split.
CELL_BYTES, TILE, CELL_ROWS, LEAF = 64 << 20, 512, 1 << 20, 32
NONE = np.iinfo(np.int64).min  # a score that no row has


def strassen(a: np.ndarray, b: np.ndarray, leaf: int | None = None) -> np.ndarray:
    """a @ b of int64 matrices by seven products of halves, recursively; odd sides get a row or column of zeros."""
    leaf = leaf or LEAF
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,kj->ij", np.ascontiguousarray(a), np.ascontiguousarray(b))
    if m % 2 or k % 2 or n % 2:
        return strassen(np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2))), leaf)[:m, :n]
    a11, a12, a21, a22 = a[:m // 2, :k // 2], a[:m // 2, k // 2:], a[m // 2:, :k // 2], a[m // 2:, k // 2:]
    b11, b12, b21, b22 = b[:k // 2, :n // 2], b[:k // 2, n // 2:], b[k // 2:, :n // 2], b[k // 2:, n // 2:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:m // 2, :n // 2] = p1 + p4 - p5 + p7
    out[:m // 2, n // 2:] = p3 + p5
    out[m // 2:, :n // 2] = p2 + p4
    out[m // 2:, n // 2:] = p1 - p2 + p3 + p6
    return out


def merged(score: np.ndarray, ids: np.ndarray, more_score: np.ndarray, more_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two heaps (last axis, highest score first, ties by smaller id) as one of the first's size."""
    k = score.shape[-1]
    score, ids = np.concatenate((score, more_score), axis=-1), np.concatenate((ids, more_ids), axis=-1)
    order = np.lexsort((ids, ~score), axis=-1)[..., :k]  # ~ turns the order of integers round and cannot overflow
    return np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


def bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer n with low * positive <= 100 * n <= high * positive, without overflow."""
    q, r = np.divmod(positive, 100)
    return low * q - (-low * r // 100), high * q + high * r // 100


def integers(column: str = "embedding") -> Column:
    """floor(256 * x) of each component."""
    return F.transform(column, lambda x: F.floor(256 * x.cast("double")))


def taking_part(rows: DataFrame) -> DataFrame:
    """vec_id, label, q (integers): the distinct rows that take part, see ``mine``."""
    c = F.col("embedding")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    length = F.aggregate(c, F.lit(0.0), lambda s, x: s + F.pow(F.floor(256 * F.greatest(F.least(x.cast("double"), F.lit(2.0**54)), F.lit(-2.0**54))).cast("double"), F.lit(2.0)))
    rows = rows.select("vec_id", "label", "embedding").where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    return rows.where(length < 2.0**62).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), integers().alias("q")).distinct()


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers as a matrix; shorter rows end with zeros."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def _grid(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, by: list[str]) -> DataFrame:
    """Every block of anchors (kind 0) with every group of rows (kind 1), one cell to a partition, anchors first, both by ``by``."""
    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    group = F.pmod(F.xxhash64("vec_id", "label", "q", F.lit(2)), F.lit(groups))
    sides = [
        anchors.select("*", F.lit(0).alias("kind"), numbers(groups).alias("group")).withColumn("cell", F.col("group") + groups * F.pmod(F.xxhash64("no"), F.lit(blocks))).drop("group"),
        rows.select("*", F.lit(1).alias("kind"), numbers(blocks).alias("block")).withColumn("cell", group + groups * F.col("block")).drop("block"),
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return both.repartitionById(blocks * groups, F.col("cell").cast("int")).sortWithinPartitions("cell", "kind", *by)


def _cells(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of one cell and kind, of at most ``TILE`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in ("cell", "kind")], axis=1)
        edges = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1), len(key)]
        for a, b in zip(edges, edges[1:], strict=False):
            for lo in range(a, b, TILE):
                yield int(key[lo, 0]), batch.slice(lo, min(TILE, b - lo))


def _mined(grid: DataFrame, width: int, schema: str, start: Callable, tile: Callable, finish: Callable) -> DataFrame:
    """Runs each cell: start(anchors) gives its heaps, tile(heaps, x, ids, labels) takes in candidates, finish(heaps) gives its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, heaps = None, [], None
        for name, part in _cells(batches, width):
            if name != cell:
                if heaps is not None:
                    yield from finish(heaps)
                cell, held, heaps = name, [], None
            if part.column("kind")[0].as_py() == 0:
                held.append(part)
                continue
            if heaps is None:
                if not held:
                    continue
                heaps, held = start(pa.Table.from_batches(held).combine_chunks().to_batches()[0]), []
            tile(heaps, _padded(part.column("q"), width), part.column("vec_id").to_numpy(), part.column("label").to_numpy())
        if heaps is not None:
            yield from finish(heaps)

    return grid.mapInArrow(run, schema)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """vectors and anchors: vec_id, label, embedding.  Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of the vectors' components x as floor(256 * x).
    An anchor's positives are its first ``positives`` rows of the same label,
    by score, ties by smaller vec_id.  For each of them the first
    ``negatives`` rows of another label with low * positive_score <= 100 *
    negative_score <= high * positive_score are returned, ranked from 1; all, if there are fewer.

    Rows with a null id, label, vector or component, with a component that is
    not finite, or so long that scores would not fit 64 bits (the integers'
    squares add up to 2^62 or more) take no part.  Labels are integers.
    Rows given twice count once; rows that share only the id are rows of their own,
    but never positives or negatives of an anchor with that id.  A vector
    shorter than others counts as if it ended with zeros.  Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(taking_part(vectors))
    asked = materialize(taking_part(anchors).withColumn("no", F.monotonically_increasing_id()))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    n_anchors, more = asked.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    width = max(1, width, more)
    blocks = max(1, -(-n_anchors * (8 * width + 16 * positives * (1 + negatives)) // CELL_BYTES))
    groups = max(1, -(-2 * partitions(spark) // blocks), -(-n // CELL_ROWS))

    def start_positives(a: pa.RecordBatch) -> dict:
        m = a.num_rows
        return {"x": _padded(a.column("q"), width), "no": a.column("no").to_numpy(), "id": a.column("vec_id").to_numpy(), "label": a.column("label").to_numpy(),
                "score": np.full((m, positives), NONE), "ids": np.zeros((m, positives), np.int64)}

    def tile_positives(h: dict, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        # both sides come by label, so that only anchors within the tile's labels are multiplied
        begin, end = np.searchsorted(h["label"], labels[0]), np.searchsorted(h["label"], labels[-1], "right")
        for lo in range(begin, end, TILE):
            at = slice(lo, min(end, lo + TILE))
            score = strassen(h["x"][at], x.T)
            score[(h["label"][at, None] != labels) | (h["id"][at, None] == ids)] = NONE
            first = np.argsort(~score, axis=1, kind="stable")[:, :positives]
            h["score"][at], h["ids"][at] = merged(h["score"][at], h["ids"][at], np.take_along_axis(score, first, 1), ids[first])

    def finish_positives(h: dict) -> Iterator[pa.RecordBatch]:
        a, k = np.nonzero(h["score"] != NONE)
        for lo in range(0, len(a), 50_000):
            i, j = a[lo:lo + 50_000], k[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(h["no"][i]), pa.array(h["score"][i, j]), pa.array(h["ids"][i, j])], ["no", "score", "id"])

    near = _mined(_grid(asked, rows, blocks, groups, ["label", "vec_id"]), width, "no long, score long, id long", start_positives, tile_positives, finish_positives)
    place = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "id"))
    best = near.withColumn("place", place).where(F.col("place") <= positives).groupBy("no").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("best"))
    ready = materialize(asked.join(best, "no").select("no", "vec_id", "label", "q", F.col("best.score").alias("pos_score"), F.col("best.id").alias("pos_id")))

    def start_windows(a: pa.RecordBatch) -> dict:
        m = a.num_rows
        each = _padded(a.column("pos_score"), positives)
        have = np.arange(positives) < np.diff(a.column("pos_score").offsets.to_numpy())[:, None]
        least, most = bounds(each, low, high)
        return {"x": _padded(a.column("q"), width), "no": a.column("no").to_numpy(), "id": a.column("vec_id").to_numpy(), "label": a.column("label").to_numpy(),
                "pos_score": each, "pos_id": _padded(a.column("pos_id"), positives), "least": np.where(have, least, 1), "most": np.where(have, most, 0),
                "score": np.full((m, positives, negatives), NONE), "ids": np.zeros((m, positives, negatives), np.int64)}

    def tile_windows(h: dict, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for lo in range(0, len(h["x"]), TILE):
            at = slice(lo, lo + TILE)
            score = strassen(h["x"][at], x.T)
            score[(h["label"][at, None] == labels) | (h["id"][at, None] == ids)] = NONE
            order = np.argsort(~score, axis=1, kind="stable")
            score = np.take_along_axis(score, order, 1)
            for k in range(positives):
                # the window is a stretch of the sorted scores
                begin = (score > h["most"][at, k, None]).sum(axis=1)
                spot = begin[:, None] + np.arange(negatives)
                inside = np.minimum(spot, score.shape[1] - 1)
                got = np.take_along_axis(score, inside, 1)
                got[(spot >= score.shape[1]) | (got < h["least"][at, k, None])] = NONE
                if (got != NONE).any():
                    h["score"][at, k], h["ids"][at, k] = merged(h["score"][at, k], h["ids"][at, k], got, ids[np.take_along_axis(order, inside, 1)])

    def finish_windows(h: dict) -> Iterator[pa.RecordBatch]:
        a, k, j = np.nonzero(h["score"] != NONE)
        names = ["no", "anchor_id", "slot", "positive_id", "positive_score", "negative_id", "negative_score"]
        for lo in range(0, len(a), 50_000):
            p, q, r = a[lo:lo + 50_000], k[lo:lo + 50_000], j[lo:lo + 50_000]
            columns = h["no"][p], h["id"][p], q, h["pos_id"][p, q], h["pos_score"][p, q], h["ids"][p, q, r], h["score"][p, q, r]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "no long, anchor_id long, slot long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _mined(_grid(ready, rows, blocks, groups, ["vec_id"]), width, schema, start_windows, tile_windows, finish_windows)
    rank = F.row_number().over(Window.partitionBy("no", "slot").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
