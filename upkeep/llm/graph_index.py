"""Approximate nearest neighbours by pruned neighbour graphs (operator 7).

Vectors are dealt to shards of bounded size.  Each shard's graph is built in
batches: a greedy beam search from the shard's central vector proposes
neighbours of a new vector, and relaxed pruning keeps those that no kept
neighbour is much nearer to; kept edges also go back.  Every query
searches every shard's graph with a beam, and the exact distances of what the beams hold decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import materialize, partitions

#: Vectors of a shard, about; edges of a node; beam when building and when searching; slack of the pruning; new vectors of a batch.
SHARD, DEGREE, BUILD_BEAM, SEARCH_BEAM, SLACK, BATCH = 4000, 32, 64, 120, 1.2, 256
#: Largest component inside the graph, in units of the shard's median one.
FAR = 1e12


def _distances(x: np.ndarray, norms: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of q to its row of ids (-1: infinite)."""
    d = norms[ids] - 2 * np.einsum("bkd,bd->bk", x[ids], q)
    d[ids < 0] = np.inf
    return d


def beam_search(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for all rows of q at once: nodes found and their distances (less the query's own norm), nearest first, -1 where none.

    Each round opens the ``step`` nearest nodes of a beam that are not open yet, until none is left.
    """
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    dist = np.full((n, beam), np.inf, np.float32)
    opened = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(x) + 1), bool)  # the last column takes -1
    ids[:, 0] = entry
    dist[:, 0] = norms[entry] - 2 * (q @ x[entry])
    seen[:, entry] = True
    alive = np.arange(n)
    while len(alive):
        r = rows[:len(alive)]
        d = np.where(opened[alive], np.inf, dist[alive])
        at = np.argpartition(d, min(step, beam - 1), axis=1)[:, :step]
        best = np.take_along_axis(d, at, 1)
        live = np.isfinite(best).any(axis=1)
        if not live.all():
            alive = alive[live]
            if not len(alive):
                break
            at, best, r = at[live], best[live], rows[:len(alive)]
        a = alive[:, None]
        opened[a, at] = True
        nodes = np.where(np.isfinite(best), ids[a, at], -1)
        new = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(alive), -1)
        new = np.where(seen[a, new], -1, new)
        order = np.argsort(new, axis=1)
        new = np.take_along_axis(new, order, 1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        seen[a, new] = True
        seen[:, -1] = False
        all_ids = np.concatenate((ids[alive], new), axis=1)
        all_dist = np.concatenate((dist[alive], _distances(x, norms, q[alive], new).astype(np.float32)), axis=1)
        all_open = np.concatenate((opened[alive], np.zeros(new.shape, bool)), axis=1)
        keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids[alive], dist[alive], opened[alive] = all_ids[r, keep], all_dist[r, keep], all_open[r, keep]
    order = np.argsort(dist, axis=1)
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def prune(x: np.ndarray, norms: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Neighbours of each node among its candidates (-1: none): the nearest is kept, those that it is ``slack`` times nearer to go, and so on."""
    candidates = np.where(candidates == of[:, None], -1, np.sort(candidates, axis=1))
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    own = norms[of][:, None] + _distances(x, norms, x[of], candidates)
    order = np.argsort(own, axis=1)
    width = int((candidates >= 0).sum(axis=1).max(initial=1))
    candidates, own = np.take_along_axis(candidates, order, 1)[:, :width], np.take_along_axis(own, order, 1)[:, :width]
    alive = np.isfinite(own)
    vectors, cn = x[candidates], norms[candidates]
    out = np.full((len(of), degree), -1, np.int64)
    rows = np.arange(len(of))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = candidates[rows, first][some]
        chosen = vectors[rows, first]
        between = cn + cn[rows, first][:, None] - 2 * np.einsum("bkd,bd->bk", vectors, chosen)
        alive &= ~((slack * slack * between <= own) & some[:, None])
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, slack: float = SLACK, batch: int = BATCH) -> tuple[np.ndarray, int]:
    """The graph (row of neighbours for each vector, -1: none) and its entry, the vector nearest to the mean."""
    n = len(x)
    norms = np.einsum("nd,nd->n", x, x)
    entry = int(np.argmin(norms - 2 * x @ x.mean(axis=0)))
    graph = np.full((n + 1, degree), -1, np.int64)  # the last row is that of -1
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    for turn in range(2):
        lo = 1 if turn == 0 else 0
        while lo < n:
            hi = min(n, lo + (min(batch, max(1, lo)) if turn == 0 else batch))
            new = order[lo:hi]
            found, _ = beam_search(x, norms, graph, entry, x[new], beam)
            mates = np.broadcast_to(new[:32], (len(new), min(32, len(new)))) if turn == 0 else np.empty((len(new), 0), np.int64)
            graph[new] = prune(x, norms, new, np.concatenate((found, graph[new], mates), axis=1), degree, slack if turn else 1.0)
            # edges back, a node's new ones at once
            source, target = np.repeat(new, degree), graph[new].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            nodes, first, many = np.unique(target, return_index=True, return_counts=True)
            for a in range(0, len(nodes), 512):
                t, f, m = nodes[a:a + 512], first[a:a + 512], many[a:a + 512]
                back = np.full((len(t), int(m.max())), -1, np.int64)
                place = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
                back[np.repeat(np.arange(len(t)), m), place] = source[np.repeat(f, m) + place]
                graph[t] = prune(x, norms, t, np.concatenate((graph[t], back), axis=1), degree, slack if turn else 1.0)
            lo = hi
    return connected(x, norms, graph, entry), entry


def connected(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int) -> np.ndarray:
    """The graph with one more edge, from the nearest vector that the entry reaches, to each that it does not reach (many equal distances can cause that)."""
    while True:
        seen = np.zeros(len(x) + 1, bool)
        seen[[entry, -1]] = True
        front = np.array([entry])
        while len(front):
            front = np.unique(graph[front])
            front = front[~seen[front]]
            seen[front] = True
        reached, lost = np.flatnonzero(seen[:-1]), np.flatnonzero(~seen[:-1])[:BATCH]
        if not len(lost):
            return graph
        near = reached[np.argmin(norms[reached] - 2 * (x[lost] @ x[reached].T), axis=1)]
        for source, target in zip(near, lost, strict=True):
            free = np.flatnonzero(graph[source] < 0)
            if not len(free):
                graph, free = np.concatenate((graph, np.full((len(graph), 1), -1, np.int64)), axis=1), [graph.shape[1]]
            graph[source, free[0]] = target


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to q in double precision; scaled first only where the squares overflow."""
    with np.errstate(over="ignore", invalid="ignore"):
        apart = x - q
        out = np.sqrt((apart ** 2).sum(axis=1))
        for i in np.flatnonzero(~np.isfinite(out)):
            most = np.abs(apart[i]).max()
            out[i] = most * np.sqrt(((apart[i] / most) ** 2).sum()) if np.isfinite(most) else np.inf
    return out


def centred(base: np.ndarray) -> tuple[np.ndarray, float]:
    """The centre of a shard's vectors and the median of their components' distances from it."""
    centre = np.median(base, axis=0)
    apart = np.abs(base / 2 - centre / 2) * 2
    apart = apart[(apart > 0) & np.isfinite(apart)]
    return centre, float(np.median(apart)) if len(apart) else 1.0


def inside(x: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """Vectors as the graph sees them."""
    with np.errstate(over="ignore"):
        return np.clip((x - centre) / scale, -FAR, FAR).astype(np.float32)


def nearest(score: np.ndarray, k: int) -> np.ndarray:
    """Places of all scores up to the k-th smallest: ties of that one belong to them."""
    return np.flatnonzero(score <= np.partition(score, k - 1)[k - 1]) if len(score) > k else np.arange(len(score))


def valid_vector(column: str = "embedding"):
    """Not null, not zero, without null or non-finite components."""
    c = F.col(column)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return c.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(c, lambda v: v != 0), F.lit(False))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """vectors and queries: vec_id, embedding.  Returns query_id, rank (from 1), vec_id, score: each query's k nearest found.

    The measure is the Euclidean distance in double precision.  A query is
    no candidate of its own (by vec_id).  Vectors that are null, zero, or hold null or
    non-finite components take no part; vectors of different length are never compared.
    Scores come from the vectors as doubles; only the graph works on 32-bit numbers, centred and
    scaled by medians and cut at ``FAR``, so that a huge component does not blur the rest.
    Equal vectors are one node, which keeps the k + 1 smallest ids, enough for
    any result; a vector given twice under one id counts once.  Equal
    distances rank by vec_id.  With fewer candidates than k all that are found are returned.
    Rows without a vec_id take no part.
    """
    ok = vectors.where(valid_vector() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    nodes = materialize(ok.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
                        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    count = nodes.count()
    shards = max(1, -(-count // shard))
    asked = queries.where(valid_vector() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")).distinct()
    stored = nodes.select(F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("long").alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "ids", "embedding")
    sent = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "query_id", F.lit(None).cast("array<bigint>").alias("ids"), "embedding")
    both = stored.unionByName(sent).withColumn("dim", F.size("embedding"))
    both = both.repartition(max(1, min(4 * partitions(nodes.sparkSession), shards)), "shard").sortWithinPartitions("shard", "dim", "kind", "query_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, ids, ready = None, [], [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("shard", "dim", "kind")], axis=1) if batch.num_rows else np.empty((0, 3))
            edges = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(key)], strict=True):
                if a == b:
                    continue
                group, rows = tuple(key[a, :2]), batch.slice(a, b - a)
                if group != current:
                    current, parts, ids, ready = group, [], [], None
                x = rows.column("embedding").flatten().to_numpy().reshape(b - a, -1)
                if key[a, 2] == 0:
                    parts.append(x)
                    ids.extend(rows.column("ids").to_pylist())
                    continue
                if not parts:
                    continue
                if ready is None:
                    exact = np.concatenate(parts)
                    centre, scale = centred(exact)
                    x32 = inside(exact, centre, scale)
                    ready = (exact, centre, scale, x32, np.einsum("nd,nd->n", x32, x32), *build(x32))
                exact, centre, scale, x32, norms, graph, entry = ready
                names = rows.column("query_id").to_pylist()
                for lo in range(0, len(x), BATCH):
                    q = x[lo:lo + BATCH]
                    found, _ = beam_search(x32, norms, graph, entry, inside(q, centre, scale), min(beam, max(2, len(exact))))
                    out = []
                    for name, vector, nodes_ in zip(names[lo:lo + BATCH], q, found, strict=True):
                        nodes_ = nodes_[nodes_ >= 0]
                        score = distances(exact[nodes_], vector)
                        # one more than k, as the query's own vector may be among them
                        near = sorted((float(score[o]), v) for o in nearest(score, k + 1) for v in ids[nodes_[o]] if v != name)[:k]
                        out += [(name, v, s) for s, v in near]
                    if out:
                        qs, vs, ss = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int64()), pa.array(vs, pa.int64()), pa.array(ss, pa.float64())], ["query_id", "vec_id", "score"])

    found = both.mapInArrow(run, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
