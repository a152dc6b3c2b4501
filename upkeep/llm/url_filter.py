"""URL filter (operator 6): allow and block rules, and for other URLs a character language-model ratio.

URLs that a rule decides train two variable-order Markov models, one of
allowed and one of blocked URLs.  Other URLs are allowed if the difference of
their log-likelihoods, per character, is above a threshold that URLs held out
from training calibrate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import materialize
from upkeep.llm.ngrams import KEY, SYMBOLS, context, counts, form, score, shorter, wanted

# The rules (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: Symbols of the longest n-gram; one URL in so many is held out from training; steps of the threshold.
ORDER, HELD_OUT, STEPS = 5, 5, 4000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null.  rules: a short list of (host, path, verdict)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def models(urls: DataFrame, order: int = ORDER) -> list[DataFrame]:
    """urls: url, allowed.  Tables (head, gram, good, bad) of orders 1 to ``order``, stored: counts in allowed and blocked URLs."""
    good = counts(urls.where("allowed"), order, "url").select(*KEY, F.col("count").alias("good"), F.lit(0).cast("long").alias("bad"))
    bad = counts(urls.where("not allowed"), order, "url").select(*KEY, F.lit(0).cast("long").alias("good"), F.col("count").alias("bad"))
    tables = [materialize(good.unionByName(bad).groupBy(*KEY).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))]
    for size in range(order - 1, 0, -1):
        tables.insert(0, materialize(tables[0].select(*form(size), "good", "bad").groupBy(*KEY).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))))
    return tables


def ratios(codes: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """head, gram, value: the difference of the logarithms of its last symbol's probability in both models.

    Each order is smoothed by its next shorter (Witten-Bell): p = (count + kinds * q) / (total + kinds),
    kinds being the number of different symbols seen after the context; a context never seen leaves p to q.
    """
    lower, at = None, ["c_head", "c_gram"]
    below = {"good": F.lit(1.0 / SYMBOLS), "bad": F.lit(1.0 / SYMBOLS)}
    for size, table in enumerate(tables, 1):
        totals = table.select("*", *context(size)).groupBy(*at).agg(*[f for m in ("good", "bad") for f in (F.sum(m).alias(f"{m}_total"), F.sum((F.col(m) > 0).cast("long")).alias(f"{m}_kinds"))])
        ask = shorter(codes, size) if size < len(tables) else codes.select(*KEY)
        row = ask.join(table, KEY, "left").select("*", *context(size)).join(totals, at, "left")
        if lower is not None:
            short = [c.alias(f"s_{k}") for c, k in zip(form(size - 1), KEY, strict=True)]
            row = row.select("*", *short).join(lower.select(
                *[F.col(k).alias(f"s_{k}") for k in KEY], F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad")), [f"s_{k}" for k in KEY])
            below = {m: F.col(f"q_{m}") for m in ("good", "bad")}
        zero = lambda c: F.coalesce(c, F.lit(0))
        p = {m: F.when(zero(F.col(f"{m}_total")) == 0, below[m]).otherwise(
            (zero(F.col(m)) + F.col(f"{m}_kinds") * below[m]) / (F.col(f"{m}_total") + F.col(f"{m}_kinds"))) for m in ("good", "bad")}
        lower = materialize(row.select(*KEY, *[p[m].alias(f"p_{m}") for m in ("good", "bad")]))
    return lower.select(*KEY, (F.log("p_good") - F.log("p_bad")).alias("value"))


def threshold(held: DataFrame, steps: int = STEPS) -> float:
    """The length-normalised difference that best tells held-out allowed from blocked URLs (mean of both classes' accuracy).

    Differences are counted in at most ``2 * steps + 1`` classes between -8 and 8; of equally good thresholds the one nearest to 0.
    """
    step = F.round(F.least(F.greatest(F.col("difference"), F.lit(-8.0)), F.lit(8.0)) / 8 * steps).cast("int")
    by_step = held.groupBy(step.alias("step")).agg(F.sum("allowed").alias("good"), F.sum(1 - F.col("allowed")).alias("bad"))
    classes = sorted((r["step"], r["good"], r["bad"]) for r in by_step.collect())
    goods, bads = sum(x[1] for x in classes), sum(x[2] for x in classes)
    if not goods or not bads:
        return 0.0
    best, above, below = None, goods, 0
    for at, good, bad in classes:
        mean = above / goods + below / bads
        if best is None or (mean, -abs(at)) > best[:2]:
            best = (mean, -abs(at), at)
        above, below = above - good, below + bad
    return (best[2] - 0.5) * 8.0 / steps


def judge(pages: DataFrame, rules=RULES, order: int = ORDER, id_column: str = "page_id") -> DataFrame:
    """pages: a stored table with page_id and url.  Returns page_id, host, path, rule, verdict, difference, threshold.

    Every row is judged on its own, repeated rows alike.  A URL that is null
    or has no ``://`` has neither host nor path nor rule.  The method allows a
    URL whose difference is above the threshold; one that is null or empty has
    difference 0.  If rules decide no URL as allowed, or none as blocked, the
    models cannot tell and URLs without a rule are allowed.
    """
    url = pages["url"]
    rows = pages.select(pages[id_column].alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "url", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("ruled"))
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    known = rows.where("ruled is not null").withColumn("allowed", F.col("ruled") == "allow")
    tables = models(known.where(~held).select("url", "allowed"), order)
    asked = materialize(wanted(rows, order, "url").groupBy(*KEY).agg(F.collect_list("block").alias("blocks")))
    valued = asked.join(ratios(asked.select(*KEY), tables), KEY).select(*KEY, "value", F.explode("blocks").alias("block"))
    scored = materialize(score(rows, valued, order, "url").withColumn(
        "difference", F.when(F.col("_chars") > 0, F.col("_sum") / F.col("_chars")).otherwise(F.lit(0.0))))
    cut = threshold(scored.where(F.col("ruled").isNotNull() & held).select("difference", (F.col("ruled") == "allow").cast("long").alias("allowed")))
    both = tables[0].agg(F.sum("good"), F.sum("bad")).first()
    tells = F.lit(bool(both[0] and both[1]))
    by_method = F.when(~tells | (F.col("difference") > cut), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"), "difference", F.lit(cut).alias("threshold"))


__all__ = ["RULES", "host_of", "judge", "models", "path_of", "ratios", "rule_of", "threshold"]
