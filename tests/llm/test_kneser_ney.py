import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from llm.conftest import ODD, SF, prose
from upkeep.llm import kneser_ney as kn
from upkeep.llm.ngrams import BITS, EDGE, SYMBOLS


def symbols(text, order):
    return [EDGE] * (order - 1) + [ord(c) for c in text]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts, order):
        top = Counter()
        for t in texts:
            s = symbols(t, order)
            top.update(tuple(s[i - order + 1:i + 1]) for i in range(order - 1, len(s)))
        self.tables = [top]
        for _ in range(order - 1):
            self.tables.insert(0, Counter(g[1:] for g in self.tables[0]))
        self.order = order
        self.d = []
        self.totals, self.mass = [], []
        for t in self.tables:
            n = [sum(1 for v in t.values() if v == k) for k in (1, 2, 3, 4)]
            if not n[0] or not n[1]:
                d = [0.5, 0.75, 0.9]
            else:
                y = n[0] / (n[0] + 2 * n[1])
                raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y for k in (1, 2, 3)]
                d = [min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, 1)]
            total, mass = defaultdict(int), defaultdict(float)
            for g, c in t.items():
                total[g[:-1]] += c
                mass[g[:-1]] += d[min(c, 3) - 1]
            self.d.append(d)
            self.totals.append(total)
            self.mass.append(mass)

    def p(self, g):
        q = 1 / SYMBOLS
        for size in range(1, self.order + 1):
            h = g[-size:]
            c, total = self.tables[size - 1].get(h, 0), self.totals[size - 1].get(h[:-1], 0)
            if total:
                q = max(c - self.d[size - 1][min(c, 3) - 1], 0) / total + self.mass[size - 1][h[:-1]] / total * q if c else self.mass[size - 1][h[:-1]] / total * q
        return q

    def perplexity(self, text):
        s = symbols(text, self.order)
        if not text:
            return None
        return math.exp(-sum(math.log(self.p(tuple(s[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(s))) / len(text))


TRUSTED = [prose(k, 40) for k in range(8)] + ["там на реке стоит дом и тут " * k for k in (3, 5)] + ["河边的房子在北风中很冷" * k for k in (3, 4)]


def stored(df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}")
    return df.sparkSession.read.parquet(f"{tmp_path}/{name}")


def test_perplexity_equals_brute_force(spark, make_docs, tmp_path):
    rows = [*ODD[:5], *ODD[7:], *((100 + k, t) for k, t in enumerate(TRUSTED)), *((112 + k, prose(12 + k, 40)) for k in range(8)), (120, "там дом 河北")]
    docs = stored(make_docs(rows), tmp_path, "docs")
    labels = spark.createDataFrame([(100 + k, 1, 0) for k in range(12)] + [(112, 0, 0), (113, 1, 1), (114, 1, None), (114, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = kn.classify(docs, labels).collect()
    assert len(got) == len(rows)
    held = {r["k"] for r in spark.range(100, 112).select(F.col("id").alias("k")).where(kn.held_out("k")).collect()}
    assert 0 < len(held) < 12
    model = Brute([TRUSTED[k] for k in range(12) if 100 + k not in held], kn.ORDER)
    text_of = defaultdict(list)
    for d, t in rows:
        text_of[d].append(t)
    for r in got:
        want = [model.perplexity(t or "") for t in text_of[r["doc_id"]]]
        assert any(w == r["perplexity"] or (w is not None and r["perplexity"] is not None and math.isclose(w, r["perplexity"], rel_tol=1e-9)) for w in want)
        assert r["kept"] == (r["perplexity"] is not None and r["perplexity"] <= r["threshold"])


def test_probabilities_of_a_context_sum_to_one(spark, make_docs):
    """After a context that was seen, and after one that was not, all symbols together."""
    texts = [prose(k, 30) for k in range(5)] + ["там там тут"]
    tables = kn.train(make_docs(list(enumerate(texts))), order=3)
    seen = {tuple(map(ord, x)) for x in ("th", "та")}
    for a, b in [*seen, (ord("q"), ord("q"))]:
        codes = spark.range(SYMBOLS).select(F.lit(0).cast("long").alias("head"), (F.lit((a << 2 * BITS) + (b << BITS)) + F.col("id")).alias("gram"))
        known = codes.join(tables[-1], ["head", "gram"], "left_semi").count()
        assert (known > 0) == ((a, b) in seen)
        assert math.isclose(kn.probabilities(codes, tables).agg(F.sum("p")).first()[0], 1.0, rel_tol=1e-9)


def test_held_out_labels(spark):
    """Junk must score worse than good documents that the model has not seen."""
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = kn.classify(docs.select("doc_id", "lang", "text"), labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["perplexity"] for r in got if r["quality"] == 1]
    bad = [r["perplexity"] for r in got if r["quality"] == 0]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.8
    assert sum(r["kept"] for r in got if r["quality"] == 1) >= 0.97 * len(good)


def test_empty_tables(spark, make_docs, tmp_path):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = stored(make_docs([(1, "some text"), (2, None)]), tmp_path, "docs")
    got = {r["doc_id"]: r["kept"] for r in kn.classify(docs, none).collect()}
    assert got == {1: True, 2: False}
    assert kn.classify(stored(make_docs([]), tmp_path, "none"), none).count() == 0
