import hashlib
import math
from collections import Counter

import numpy as np

from llm.conftest import ODD, SF, prose
from upkeep.llm import fingerprint as fp


def test_entropy_classes_equal_direct_computation():
    data = np.frombuffer((prose(5, 40) + "aaaa" * 20).encode(), np.uint8)
    got = fp.entropy_classes(data)
    assert len(got) == len(data) - fp.WINDOW + 1
    for i in range(0, len(got), 7):
        c = Counter(data[i:i + fp.WINDOW].tolist())
        h = -sum(v / fp.WINDOW * math.log2(v / fp.WINDOW) for v in c.values()) / math.log2(fp.WINDOW)
        assert abs(got[i] - h * fp.CLASSES) <= 1.01


def test_digests_do_not_depend_on_neighbours():
    texts = [t or "" for _, t in ODD] + [prose(k, 30 * k) for k in range(20)]
    rank = fp.rarity([(k, k * k % 997) for k in range(fp.CLASSES + 1)])
    together = [fp.spelled(d) for d in fp.digests(texts, rank)]
    alone = [fp.spelled(fp.digests([t], rank)[0]) for t in texts]
    assert together == alone
    assert all((t == "") == s.startswith("0:") for t, s in zip(texts, together, strict=True))


def brute(rows):
    line = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    return line


def test_edits_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    line = brute([tuple(r) for r in docs.collect()])
    got = {r["doc_id"]: r for r in fp.edits(docs).collect()}
    assert len(got) == len(line)
    for (d, t), (_, after) in zip(line, [*line[1:], line[0]], strict=True):
        k = len(t) // 4
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + after[:k]).encode()).hexdigest()
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
    long = [r for r in got.values() if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] for r in long]) > 0.6
    assert np.median([r["near_next"] for r in long]) < 0.1


def test_odd_rows(spark, make_docs):
    got = fp.edits(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert len(by_text[9]) == 1 and by_text[8] == by_text[9] and by_text[1] == by_text[2]
    assert fp.edits(make_docs([])).count() == 0
    one = fp.edits(make_docs([(5, "just one document here")])).collect()
    assert one[0]["near_next"] == 1.0
    assert fp.fingerprints(make_docs(ODD)).count() == len(ODD)
