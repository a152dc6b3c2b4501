"""Exact Jaccard join of documents on word n-grams (operator 8).

1. Each text becomes the set of its n-gram hashes.  Equal sets form a class.
2. A filter keeps documents that can have a partner: in an order by hash,
   two sets that reach the threshold share several members of prefixes of
   a known length (see ``prefix_of``), so a document whose prefix has too few members
   that occur elsewhere has none.  Members travel in packed arrays, one for
   each block of documents and shard of hashes.
3. Among the documents left, members are ordered rare first.  Two sets that reach
   the threshold share a member of their short prefixes.  Length, positional
   and suffix filters thin the pairs in every round; each pair is verified once,
   as pairs that a round has tried are left out of the later ones.

Only connections are wanted, not all pairs of a group.  Linear rounds verify
for each posting the pairs with a few others of the same prefix member that
lie in another component, as long as a round joins a sixteenth of the
components.  The last round takes all pairs that share a prefix
member and still lie in different components; so no link between components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import materialize, partitions, pieces, small_or_shuffled, texts_of
from upkeep.llm.components import components
from upkeep.llm.shingles import shingle_sets

#: Text that one block holds, about (its prefix members take about half of that); what one shard holds, about, of the members sent.
BLOCK_BYTES, SHARD_BYTES = 16 << 20, 32 << 20
#: 64-bit words of a set's parity sketch.
SKETCH = 16
#: Partners that each posting has in a linear round, and about the postings of one list of them.
LAGS, LIST = 16, 64
#: Most bytes of an Arrow batch here: batches of whole sets are held several times on both sides.
SET_BYTES = 4 << 20
#: Keys that the rows of one large component or class of equal sets are dealt to, each with a copy of its one row.
SALTS = 16
MANY = 0xFFFFFFFF  # in place of a document: several of the block's documents have this member


def least_common(n: int, num: int, den: int) -> int:
    """Members that a set of n must share with any partner: intersection >= num/den * union >= num/den * n."""
    return -(-num * n // den)


def surplus(n: int) -> int:
    return max(1, 15 * n // 100)


def prefix_of(n: int, num: int, den: int) -> int:
    """So many members in hash order that two linked sets share at least the smaller ``surplus`` of them within both prefixes."""
    return min(n, n - least_common(n, num, den) + surplus(n))


def _scan(docs: DataFrame, k: int, num: int, den: int, shards: int) -> DataFrame:
    """Rows of documents (kind 0) and packed prefix members (kind 1), stored."""
    bits = shards.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, int]] = []
        docs_of: list[tuple] = []
        block = None
        names = ["kind", "row", "doc_id", "n", "digest", "block", "ord", "own", "need", "shard", "keys"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

        def flush() -> Iterator[pa.RecordBatch]:
            name = (part << 24) + block
            keys = np.concatenate([x for x, _ in held]) if held else np.empty(0, np.uint64)
            owner = np.concatenate([np.full(len(x), o, np.uint32) for x, o in held]) if held else np.empty(0, np.uint32)
            held.clear()
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            del order
            same = keys[1:] == keys[:-1]
            several = np.concatenate(([False], same)) | np.concatenate((same, [False])) if len(keys) else np.empty(0, bool)
            own = np.bincount(owner[several], minlength=len(docs_of)) if len(docs_of) else []
            first = np.concatenate(([True], ~same)) if len(keys) else np.empty(0, bool)
            sent, by = keys[first], np.where(several, np.uint32(MANY), owner)[first]
            del keys, owner, same, several, first
            rows = [(0, r, d, n, digest, name, o, int(own[o]), need, None, None) for o, (r, d, n, digest, need) in enumerate(docs_of)]
            for lo in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo:lo + 20_000], strict=True), kinds, strict=True)], names)
            shard = (sent >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sent), np.int64)
            low = ((sent << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
            cut = np.searchsorted(shard, np.arange(shards + 1))
            full = [k for k in range(shards) if cut[k + 1] > cut[k]]
            for lo in range(0, len(full), 64):
                packed = [(1, None, None, None, None, name, None, None, None, k, low[cut[k]:cut[k + 1]].tobytes() + by[cut[k]:cut[k + 1]].astype("<u4").tobytes())
                          for k in full[lo:lo + 64]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed, strict=True), kinds, strict=True)], names)

        for number, piece in pieces(batches, "text", 4 << 20, BLOCK_BYTES):
            if number != block and block is not None:
                yield from flush()
                docs_of = []
            block = number
            for r, d, members in zip(piece.column("row").to_pylist(), piece.column("doc_id").to_pylist(), shingle_sets(texts_of(piece, "text"), k), strict=True):
                n = len(members)
                if n:
                    held.append((members[:prefix_of(n, num, den)].copy(), len(docs_of)))  # a view would keep the whole set
                need = min(surplus(n), surplus(least_common(n, num, den)))
                docs_of.append((r, d, n, hashlib.blake2b(members.tobytes(), digest_size=16).digest(), need))
        if block is not None:
            yield from flush()

    schema = "kind int, row long, doc_id long, n int, digest binary, block long, ord long, own int, need int, shard int, keys binary"
    return materialize(docs.mapInArrow(run, schema))


def _elsewhere(scan: DataFrame, shards: int) -> DataFrame:
    """block, ord, cnt: prefix members that other blocks have too; a shard sends each block one packed list of counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            half = [(len(x) // 8, b, np.frombuffer(x, "<u4")) for b, x in held]
            key = np.concatenate([x[:n] for n, _, x in half])
            by = np.concatenate([x[n:] for n, _, x in half])
            block = np.repeat(np.arange(len(half)), [n for n, _, _ in half])
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            shared = np.empty(len(key), bool)
            shared[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            hit = shared & (by != MANY)
            pair, count = np.unique((block[hit].astype(np.int64) << 32) + by[hit], return_counts=True)
            cut = np.searchsorted(pair >> 32, np.arange(len(half) + 1))
            sums = [(half[k][1], (pair[a:b] & MANY).astype("<u4").tobytes() + count[a:b].astype("<u4").tobytes()) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
            for lo in range(0, len(sums), 64):
                blocks, data = zip(*sums[lo:lo + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], ["block", "sums"])

        for batch in batches:
            for s, b, x in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "keys")), strict=True):
                if s != shard and held:
                    yield from flush()
                    held = []
                shard = s
                held.append((b, x))
        if held:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cnt = None, np.zeros(0, np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(cnt)
            for lo in range(0, len(at), 100_000):
                part = at[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int64)), pa.array(part), pa.array(cnt[part])], ["block", "ord", "cnt"])

        for batch in batches:
            for b, x in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                if b != block:
                    yield from rows()
                    block, cnt = b, np.zeros(0, np.int64)
                ords, n = np.split(np.frombuffer(x, "<u4"), 2)
                more = np.bincount(ords, n).astype(np.int64)
                if len(more) > len(cnt):
                    cnt, more = more, cnt
                cnt[:len(more)] += more
        yield from rows()

    sent = scan.where("kind = 1").select("shard", "block", "keys")
    most = 4 * partitions(scan.sparkSession)
    sums = sent.repartition(max(1, min(shards, most)), "shard").sortWithinPartitions("shard").mapInArrow(run, "block long, sums binary")
    return sums.repartition(most, "block").sortWithinPartitions("block").mapInArrow(add, "block long, ord long, cnt long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (u, v) those that reach the threshold; a first look at parts of the sets, which share at most the smaller count, spares most merges."""
    left = sets.select(F.col("vid").alias("u"), F.col("members").alias("a"))
    right = sets.select(F.col("vid").alias("v"), F.col("members").alias("b"))

    def reach(x: bytes, y: bytes) -> bool:
        p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
        total = len(p) + len(q)
        must = -(-num * total // (num + den))
        parts = np.arange(1, 65, dtype=np.uint64) << np.uint64(58)
        cp, cq = (np.diff(np.searchsorted(z, parts[:-1]), prepend=0, append=len(z)) for z in (p, q))
        if np.minimum(cp, cq).sum() < must:
            return False
        merged = np.sort(np.concatenate((p, q)))
        same = int((merged[1:] == merged[:-1]).sum())
        return den * same >= num * (total - same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [reach(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("a"), batch.column("b"), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return joined.mapInArrow(run, "u long, v long")


def _new_links(pairs: DataFrame, tried: DataFrame | None, sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Links among the pairs (u, v) that are not tried yet and pass the suffix filter, and all tried ones."""
    pairs = pairs.distinct()
    if tried is not None:
        pairs = pairs.join(tried, ["u", "v"], "left_anti")
    u, v = (sets.select(F.col("vid").alias(f"{k}_vid"), F.struct("n", "sketch").alias(k)) for k in ("a", "b"))
    thin = pairs.join(u, F.col("u") == F.col("a_vid")).join(v, F.col("v") == F.col("b_vid")).where(_near_enough("a", "b", num, den)).select("u", "v")
    thin = materialize(thin)
    return materialize(_verified(thin, sets, num, den)), thin if tried is None else tried.unionByName(thin)


def _sketch(members: np.ndarray) -> np.ndarray:
    """Of each class of hashes whether the set has an odd number of members in it.

    Two sets' sketches differ in at most as many bits as the sets have members that are not shared.
    """
    odd = np.bincount((members & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _near_enough(a: str, b: str, num: int, den: int) -> Column:
    """Suffix filter: the sketches differ in no more bits than linked sets have members apart."""
    apart = sum((F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(SKETCH)), F.lit(0))
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return apart <= both - 2 * F.ceil(num * both / F.lit(num + den))


def _may_link(a: str, b: str, num: int, den: int) -> Column:
    """Length and positional filter of two postings that share a member."""
    na, nb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "pos") for x in (a, b))
    rest = 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & (rest * (num + den) >= num * (na + nb))


def _linear_pairs(placed: DataFrame, number: int, num: int, den: int) -> DataFrame:
    """For each posting the pairs (u, v) with the few before it that lie in another component.

    Postings of a member stand by length in round 0, then in an order by hash
    that differs from round to round; a frequent member's are cut into many lists.
    """
    order = ["n", "vid"] if number == 0 else [F.xxhash64("vid", F.lit(number))]
    w = Window.partitionBy("h", F.pmod(F.xxhash64(F.lit(number), "vid"), 1 + F.floor(F.col("df") / LIST))).orderBy(*order)
    place = F.struct("n", "vid", "pos", "root")
    steps = (placed.select(place.alias("me"), F.array(*[F.lag(place, k).over(w) for k in range(1, LAGS + 1)]).alias("others"))
             .select("me", F.explode("others").alias("other")).where("other.root <> me.root").where(_may_link("me", "other", num, den)))
    return steps.select(F.least("me.vid", "other.vid").alias("u"), F.greatest("me.vid", "other.vid").alias("v"))


def _open(postings: DataFrame, found: DataFrame, sets: DataFrame) -> tuple[DataFrame, int]:
    """Postings, with root and sketch, of the members that sets of different components share, and the number of components there."""
    placed = postings.join(found.withColumnRenamed("node", "vid"), "vid", "left").withColumn("root", F.coalesce("root", "vid"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
    open_ = materialize(placed.join(mixed, "h").join(sets.select("vid", "sketch"), "vid"))
    return open_, open_.select("root").distinct().count()


def link(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Components of documents whose sets of ``words``-grams have intersection/union >= num/den.

    docs: a stored table with doc_id and text (it is read twice and must give
    the same rows in the same order).  Returns one row per row of docs: row
    (its number in the scan), doc_id, n_shingles, component_id (the smallest
    doc_id reachable, null only if all are null) and first (true for one row
    of each component: the smallest doc_id, then row).  Null text is empty;
    a document without words has no shingles and links with nothing, not
    even its like.  Rows with the same doc_id are documents of their own.
    Hashes have 64 bits; with 16 more bytes for equal sets, no cap on any list.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SET_BYTES))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 << max(4 * partitions(spark) - 1, total // SHARD_BYTES).bit_length()
    scan = _scan(rows, words, num, den, shards)
    seen = scan.where("kind = 0").drop("kind", "shard", "keys")
    hits = _elsewhere(scan, shards)
    alive = (seen.where("n > 0").join(hits, ["block", "ord"], "left")
             .where(F.col("own") + F.coalesce("cnt", F.lit(0)) >= F.col("need")))
    # one row of each class of equal sets stands for it
    classes = materialize(alive.groupBy("digest", "n").agg(F.min("row").alias("vid")))
    wanted = small_or_shuffled(classes.select(F.col("vid").alias("row")))
    chosen = rows.join(wanted, "row", "left_semi")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, piece in pieces(batches, "text", 4 << 20, 1 << 60):
            found = shingle_sets(texts_of(piece, "text"), words)
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array([len(x) for x in found], pa.int32()), pa.array([x.tobytes() for x in found], pa.binary()), pa.array([_sketch(x) for x in found], pa.list_(pa.int64()))], ["vid", "n", "members", "sketch"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                m = [np.frombuffer(x, "<u8").view("<i8") for x in part.column("members").to_pylist()]
                n = part.column("n").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("vid").to_numpy(), n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(m))], ["vid", "n", "h"])

    sets = materialize(chosen.mapInArrow(members, "vid long, n int, members binary, sketch array<bigint>"))
    each = sets.select("vid", "n", "members").mapInArrow(single, "vid long, n int, h long")
    often = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "h")
    # members that occur once come first in rare-first order; they take places, but join nothing
    ordered = (shared.groupBy("vid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("m"))
               .withColumn("alone", F.col("n") - F.size("m"))
               .withColumn("prefix", F.col("n") - F.ceil(F.col("n") * num / F.lit(den)).cast("int") + 1))
    postings = materialize(ordered.where("prefix > alone")
                           .select("vid", "n", "alone", F.posexplode(F.slice("m", F.lit(1), (F.col("prefix") - F.col("alone")).cast("int"))).alias("i", "x"))
                           .select(F.col("x.h").alias("h"), F.col("x.df").alias("df"), "vid", "n", (F.col("alone") + F.col("i")).alias("pos")))
    links, tried = _new_links(_linear_pairs(postings.withColumn("root", F.col("vid")), 0, num, den), None, sets, num, den)
    found = components(links)
    open_, roots = _open(postings, found, sets)
    number = 1
    while roots:
        new, tried = _new_links(_linear_pairs(open_, number, num, den), tried, sets, num, den)
        links = links.unionByName(new)
        found = components(links)
        before = roots
        open_, roots = _open(postings, found, sets)
        number += 1
        if 16 * roots > 15 * before:
            break
    if roots:
        a, b = open_.alias("a"), open_.alias("b")
        cross = (a.join(b, F.col("a.h") == F.col("b.h")).where((F.col("a.vid") < F.col("b.vid")) & (F.col("a.root") != F.col("b.root")))
                 .where(_may_link("a", "b", num, den) & _near_enough("a", "b", num, den))
                 .select(F.col("a.vid").alias("u"), F.col("b.vid").alias("v")))
        more, tried = _new_links(cross, tried, sets, num, den)
        if not more.isEmpty():
            found = components(links.unionByName(more))

    # a class or component with very many rows is dealt to several keys, each with a copy of its one row
    salt, salts = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    of = classes.select(F.col("digest").alias("_digest"), F.col("n").alias("_n"), "vid").join(found.withColumnRenamed("node", "vid"), "vid", "left")
    group = of.select("_digest", "_n", F.coalesce("root", "vid").alias("root"), salts.alias("_salt"))
    with_root = materialize(seen.withColumn("salt", salt).join(group, (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n")) & (F.col("salt") == F.col("_salt")), "left")
                            .select("row", "doc_id", "n", "salt", F.col("root").isNotNull().alias("linked"), F.coalesce("root", "row").alias("root")))
    best = (with_root.where("linked").groupBy("root").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("top"))
            .select("root", "least", F.col("top.row").alias("top"), salts.alias("salt")))
    return (with_root.join(best, ["root", "salt"], "left")
            .select("row", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("linked"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce(F.col("top") == F.col("row"), F.lit(True)).alias("first")))


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs that are the first of their component, with all columns.

    A row is left out only if its number and its doc_id are those of the scan before.
    """
    dropped = link(docs, words, num, den).where("not first").select(F.col("row").alias("_row"), F.col("doc_id").alias("_doc"))
    dropped = small_or_shuffled(materialize(dropped))
    same = (F.col("_at") == F.col("_row")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_doc"))
    return docs.withColumn("_at", F.monotonically_increasing_id()).join(dropped, same, "left_anti").drop("_at")
