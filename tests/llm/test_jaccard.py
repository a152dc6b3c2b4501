import random
import re

import pytest

from llm.conftest import ODD, SF, prose
from upkeep.llm import jaccard


def sets(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    """(doc_id, set size, smallest id reachable) of every row."""
    s = [sets(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    holders = {}
    for i, x in enumerate(s):
        for g in x:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for h in holders.values() for n, a in enumerate(h) for b in h[n + 1:]}
    for a, b in pairs:
        same = len(s[a] & s[b])
        if den * same >= num * (len(s[a]) + len(s[b]) - same):
            root[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    least = {k_: min((x for x in v if x is not None), default=None) for k_, v in least.items()}
    return sorted(((d, len(s[i]), least[top(i)]) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, tmp_path, k, num, den, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, row int, n string, component_id string")
    df.repartition(parts).write.parquet(f"{tmp_path}/d")
    got = jaccard.link(spark.read.parquet(f"{tmp_path}/d"), k, num, den).collect()
    assert sum(r["first"] for r in got) == len({(r["component_id"]) for r in got if r["component_id"] is not None}) or any(r["component_id"] is None for r in got) or len({r["doc_id"] for r in got}) < len(got)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80)])
def test_documents(spark, tmp_path, k, num):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, tmp_path, k, num, 100) == brute(rows, k, num, 100)


def edited(text, r, share):
    return " ".join(f"e{r.random():.6f}" if r.random() < share else w for w in text.split(" "))


@pytest.mark.parametrize("share", [0.01, 0.02, 0.03])
def test_chains_of_near_copies(spark, tmp_path, share):
    """Copies of copies and copies of one text, some just above and some just below the threshold."""
    r = random.Random(int(share * 1000))
    rows, i = [], 0
    for base in range(6):
        text = prose(base, 80 + 40 * base)
        for _ in range(12):
            rows.append((i, text if r.random() < 0.3 else edited(prose(base, 80 + 40 * base), r, share)))
            text = edited(text, r, share) if r.random() < 0.5 else text
            i += 1
    rows += [(i + k, prose(900 + k, r.choice([1, 3, 4, 5, 30]))) for k in range(60)]
    r.shuffle(rows)
    assert run(spark, rows, tmp_path, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_no_pair_is_verified_twice(spark, tmp_path, monkeypatch):
    """Sets of 905 out of 1,000 members: all share many, none reaches the threshold; and some that do."""
    r = random.Random(1)
    words = [f"w{k}" for k in range(1000)]
    rows = [(k, " ".join(sorted(r.sample(words, 905)))) for k in range(60)]
    rows += [(100 + k, " ".join(x for x in words if r.random() > 0.04)) for k in range(20)]
    seen = []
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a, f=jaccard._verified: seen.extend((x["u"], x["v"]) for x in pairs.collect()) or f(pairs, *a))
    assert run(spark, rows, tmp_path, 1, 85, 100) == brute(rows, 1, 85, 100)
    assert len(seen) == len(set(seen)) > 0


def test_odd_rows(spark, tmp_path):
    rows = [*ODD, (20, "TWO WORDS"), (21, "two  words"), (22, "two words more"), (None, prose(2, 60).upper())]
    assert run(spark, rows, tmp_path, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_empty_table_and_keep_one(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/e")
    assert jaccard.link(spark.read.parquet(f"{tmp_path}/e")).count() == 0
    make_docs(ODD).write.parquet(f"{tmp_path}/o")
    docs = spark.read.parquet(f"{tmp_path}/o")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    groups = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80, 100)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and ids.count(9) == 0 and {1, 2, 3, None} <= set(ids)
    assert len(ids) < len(groups)
