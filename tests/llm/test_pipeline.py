import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from llm.conftest import DOCS, ODD, SF, prose
from llm.test_jaccard import sets
from llm.test_kneser_ney import Brute
from llm.test_mixing import fill
from llm.test_packing import check
from llm.test_secretscan import brute as secret_spans
from upkeep.llm import kneser_ney as kn
from upkeep.llm import mixing
from upkeep.llm import secretscan as ss


def brute_quality(spark, rows, labels):
    """Ids kept: perplexity by dictionaries, thresholds with numpy."""
    verdicts = {}
    for d, q, t in labels:
        verdicts.setdefault(d, []).append(q == 1 and t != 1)
    trusted = {d for d, v in verdicts.items() if d is not None and all(v)}
    mine = [r for r in rows if r[0] in trusted]
    by_hash = {r["d"]: r["h"] for r in spark.createDataFrame([(d,) for d in {r[0] for r in mine}], "d long").select("d", F.xxhash64("d").alias("h")).collect()}
    held = {d for d in by_hash if by_hash[d] % kn.HELD_OUT == 0}
    for lang in {r[2] for r in mine}:
        ids = {r[0] for r in mine if r[2] == lang}
        if len(ids) > 1 and not ids & held:
            held.add(min(ids, key=by_hash.get))
    model = Brute([r[1] for r in mine if r[0] not in held], kn.ORDER)
    allow = lambda n: math.exp(kn.SHORT / math.sqrt(max(n, 1)))
    score = [model.perplexity(r[1] or "") for r in rows]
    logs = {}
    for r, p in zip(rows, score, strict=True):
        if r[0] in held and p is not None:
            logs.setdefault(r[2], []).append(math.log(p / allow(len(r[1]))))

    def quantile(x):
        return sorted(x)[max(0, math.ceil(kn.KEPT_SHARE * len(x)) - 1)]

    several = {k: v for k, v in logs.items() if len(v) > 1}
    freedom = sum(len(v) - 1 for v in several.values())
    spread = (sum(len(v) * np.var(v) for v in several.values()) / freedom) ** 0.5 if freedom else kn.SPREAD
    off = [(x - np.mean(v)) * math.sqrt(len(v) / (len(v) - 1)) for v in several.values() for x in v]
    tail = max(quantile(off), 0.0) if off else 2.6 * spread
    cut = {k: math.exp((len(v) * quantile(v) + kn.PRIOR * (np.mean(v) + tail + kn.ERRORS * spread / math.sqrt(len(v)))) / (len(v) + kn.PRIOR)) * kn.ROOM for k, v in logs.items()}
    return [r for r, p in zip(rows, score, strict=True) if p is not None and (r[2] not in cut or p <= cut[r[2]] * allow(len(r[1])))], trusted


def brute_near(rows):
    """One row of each group of rows linked at 0.8 over five-word shingles: the smallest id."""
    s = [sets(r[1], 5) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            same = len(s[a] & s[b])
            if same and 100 * same >= 80 * (len(s[a]) + len(s[b]) - same):
                root[top(a)] = top(b)
    first = {}
    for i, r in enumerate(rows):
        first[top(i)] = min(first.get(top(i), r), r, key=lambda x: (x[0] is None, x[0] or 0))
    return list(first.values())


def brute_secrets(rows):
    out = []
    for r in rows:
        at, text = 0, []
        for a, _, b in secret_spans(r[1], ss.RULES):
            if a >= at:
                text += [(r[1] or "")[at:a], "[SECRET]"]
            at = max(at, b)
        out.append((r[0], "".join(text) + r[1][at:] if text else r[1], *r[2:4], len("".join(text) + r[1][at:]) if text else r[4]))
    return out


def check_mixture(before, after):
    """Sources reach their targets by whole documents, each floor or ceil(target / size) times and nothing else."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = Counter()
    for r in before:
        size[r[3]] += words(r[1])
    names = sorted(size, key=str)
    weights = [size[s] ** 0.7 for s in names]
    level = max(size[s] / w for s, w in zip(names, weights, strict=True) if w)
    total = sum(min(level * w, 3 * size[s]) for s, w in zip(names, weights, strict=True))
    target = dict(zip(names, fill([size[s] for s in names], weights, total, 3), strict=True))
    times = Counter(after)
    assert set(times) <= set(before)
    for s in names:
        own = [r for r in before if r[3] == s and words(r[1])]
        epochs = target[s] / size[s] if size[s] else 0
        assert all(math.floor(epochs + 1e-9) <= times[r] <= math.ceil(epochs - 1e-9) for r in own)
        assert abs(sum(times[r] * words(r[1]) for r in own) - target[s]) <= max(words(r[1]) for r in own) / 2 + 1


def test_run_against_brute_force(spark, tmp_path):
    """Each stage of run() against a plain version, over documents with odd rows; what run() returns is the last one's."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    rows += [(10_000 + k, t, "en", "odd", None if t is None else len(t)) for k, (_, t) in enumerate(ODD[:5] + ODD[8:])] + [(10_500, prose(4, 80), "xx", None, 1), (10_501, "key: token = abcdefghijklmnop", "xx", "odd", 2)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    seen, old = {}, list(corpus_pipeline.STAGES)

    def watched(name, stage):
        def run(s, docs, sf):
            seen[name] = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
            return stage(s, docs, sf)
        return run

    corpus_pipeline.STAGES[:] = [(n, watched(n, f)) for n, f in old]
    try:
        packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        corpus_pipeline.STAGES[:] = old
    order = lambda x: sorted(x, key=str)
    assert order(seen["quality"]) == order(rows)
    kept, trusted = brute_quality(spark, rows, labels)
    assert order(seen["near_duplicates"]) == order(kept)
    mine = [r for r in rows if r[0] in trusted]
    assert sum(r in kept for r in mine) >= 0.98 * len(mine)  # trusted documents stay
    assert order(seen["secrets"]) == order(brute_near(kept))
    assert order(seen["mixture"]) == order(brute_secrets(seen["secrets"]))
    check_mixture(seen["mixture"], seen["sequences"])
    assert any("[SECRET]" in r[1] for r in seen["mixture"])
    # every copy that the mix takes is packed, the pieces of copies side by side
    bins, least = check([r[:2] for r in seen["sequences"]], packed, 1024, 2)
    assert bins <= least * 1.02 + 1


def test_odd_rows_pass_every_stage(spark, make_docs, tmp_path):
    make_docs([*ODD, *((50 + k, prose(k, 50), None, None) for k in range(5))]).write.parquet(f"{tmp_path}/d")
    make_docs([]).write.parquet(f"{tmp_path}/e")
    for path in ("d", "e"):
        docs = spark.read.parquet(f"{tmp_path}/{path}")
        for name, stage in corpus_pipeline.STAGES:
            out = mixing.materialize(stage(spark, docs, SF))
            texts = [r["text"] for r in docs.collect()]
            if name == "quality":
                assert all(r["text"] for r in out.collect()) and Counter(r["text"] for r in out.collect()) <= Counter(texts)  # null and empty texts go
            elif name == "secrets":
                assert out.count() == len(texts)
            assert (out.count() > 0) == (path == "d")
            docs = out if "text" in out.columns else docs


def test_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{k}_") for q in names) for k in range(1, 14)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
