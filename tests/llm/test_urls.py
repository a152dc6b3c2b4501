import math
import re
from collections import Counter

from llm.conftest import SF
from upkeep.llm import url_filter as uf
from upkeep.llm.ngrams import EDGE, SYMBOLS


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [(h + p, v) for h, p, v in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0])) if fit else (None, None)


def symbols(t, order):
    return [EDGE] * (order - 1) + [ord(c) for c in t]


def brute_ratio(urls, good, bad, order):
    def model(texts):
        table = Counter(tuple(s[i - size + 1:i + 1]) for t in texts for s in [symbols(t, order)] for i in range(order - 1, len(s)) for size in range(1, order + 1))
        total, kinds = Counter(), Counter()
        for g, c in table.items():
            total[g[:-1], len(g)] += c
            kinds[g[:-1], len(g)] += 1

        def p(g):
            q = 1 / SYMBOLS
            for size in range(1, order + 1):
                h = (g[-size:][:-1], size)
                if total[h]:
                    q = (table[g[-size:]] + kinds[h] * q) / (total[h] + kinds[h])
            return q
        return p
    a, b = model(good), model(bad)
    out = {}
    for u in urls:
        s = symbols(u, order)
        out[u] = sum(math.log(a(g)) - math.log(b(g)) for i in range(order - 1, len(s)) for g in [tuple(s[i - order + 1:i + 1])]) / len(u) if u else 0.0
    return out


ODD = ["http://A.Example.NET/en/x", "https://example.net/en", "nothing", "", None, "http://net/x", "ftp://de.example.com/de/?q#f", "x://fr.org/fr/a?b://c", "http://other.test/页", "http:///p", "a://b://c/d", "http://EXAMPLE.org\n/fr/"]


def test_hosts_rules_and_ratio(spark, tmp_path):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()] + [(10_000 + k, u) for k, u in enumerate(ODD)] + [(10_000, ODD[0]), (None, "http://a.net/")]
    spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, verdict string, host string").write.parquet(f"{tmp_path}/p")
    got = uf.judge(spark.read.parquet(f"{tmp_path}/p")).collect()
    assert len(got) == len(pages)
    url_of = dict(pages)
    from pyspark.sql import functions as F

    held = {r["url"] for r in spark.read.parquet(f"{tmp_path}/p").where(F.pmod(F.xxhash64("url"), F.lit(uf.HELD_OUT)) == 0).collect()}
    ruled = [(u, rule(*parts(u))[1]) for _, u in pages]
    ratio = brute_ratio({u or "" for _, u in pages}, [u for u, v in ruled if v == "allow" and u not in held], [u for u, v in ruled if v == "block" and u not in held], uf.ORDER)
    for r in got:
        u = url_of[r["page_id"]]
        assert (r["host"], r["path"]) == parts(u)
        want, verdict = rule(r["host"], r["path"])
        assert r["rule"] == want
        assert math.isclose(r["difference"], ratio[u or ""], rel_tol=1e-9, abs_tol=1e-12)
        assert r["verdict"] == (verdict or ("allow" if r["difference"] > r["threshold"] else "block"))


def test_held_out_accuracy(spark):
    got = uf.judge(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet")).where("rule is not null").collect()
    right = {v: [(r["difference"] > r["threshold"]) == (v == "allow") for r in got if r["verdict"] == v] for v in ("allow", "block")}
    assert all(sum(x) > 0.85 * len(x) for x in right.values())


def test_without_rules_and_empty(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.test/"), (2, None)], "page_id long, url string").write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p")
    assert [r["verdict"] for r in uf.judge(df).collect()] == ["allow"] * 2
    assert uf.judge(df.where("false")).count() == 0
