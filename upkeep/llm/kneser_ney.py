"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text (operator 4).

Counts of the longest n-grams come from the trusted texts; every shorter
order counts in how many longer n-grams a form occurs.  The probabilities of
the n-grams that the corpus contains follow from joins of sharded tables,
one order after the other.  A document's perplexity is that of its
characters; a document is rejected above its language's threshold, which comes from
trusted documents of this language that are held out from training.  A
language without any is not judged: its documents are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import materialize, small_or_shuffled
from upkeep.llm.ngrams import KEY, SYMBOLS, context, counts, form, keyed, score, shorter, wanted
from upkeep.operators.stats import exact_quantile

#: Symbols of an n-gram; held-out trusted documents that a threshold lets pass, and the room above that.
ORDER, KEPT_SHARE, ROOM = 4, 0.995, 1.05
#: Documents that the spread over all languages counts for beside a language's own quantile; standard errors of a language's centre;
#: the spread of log perplexities where no language has two held-out documents to tell it.
PRIOR, ERRORS, SPREAD = 50, 2.0, 0.15
#: One trusted document in so many is held out; allowance for short texts, whose perplexity varies more (see ``allowance``).
HELD_OUT, SHORT = 5, 2.5


def discounts(table: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the counts of counts (one row)."""
    c = F.col("count")
    n = [x or 0 for x in table.agg(*[F.sum((c == k).cast("long")) for k in (1, 2, 3, 4)]).first()]
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]  # too little text to estimate them
    y = n[0] / (n[0] + 2 * n[1])
    guess = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(guess, 1)]


def train(trusted: DataFrame, order: int = ORDER, column: str = "text") -> list[DataFrame]:
    """Tables (head, gram, count) of orders 1 to ``order``, stored: counts at the top, numbers of continuations below."""
    tables = [materialize(counts(trusted, order, column))]
    for size in range(order - 1, 0, -1):
        tables.insert(0, materialize(tables[0].select(*form(size)).groupBy(*KEY).agg(F.count("*").alias("count"))))
    return tables


def probabilities(codes: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """head, gram, p for the distinct n-grams ``codes`` (head, gram, of the longest order).

    p = max(count - D(count), 0) / total + (D1 N1 + D2 N2 + D3 N3) / total * p of the next shorter form,
    from one symbol in ``SYMBOLS`` at the bottom; total, N1, N2 and N3 (continuations seen once, twice, more often) are those of the context.
    A context that was never seen leaves p to the shorter form.
    """
    lower, below, codes, at = None, F.lit(1.0 / SYMBOLS), keyed(codes), ["c_head", "c_gram"]
    for size, table in enumerate(tables, 1):
        d1, d2, d3 = discounts(table)
        c = F.col("count")
        off = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        totals = table.select("*", *context(size)).groupBy(*at).agg(F.sum("count").alias("total"), F.sum(off).alias("mass"))
        ask = shorter(codes, size) if size < len(tables) else codes.select(*KEY)
        row = ask.join(table, KEY, "left").select("*", *context(size)).join(totals, at, "left")
        if lower is not None:
            short = [c.alias(f"s_{k}") for c, k in zip(form(size - 1), KEY, strict=True)]
            row = row.select("*", *short).join(lower.select(*[F.col(k).alias(f"s_{k}") for k in KEY], F.col("p").alias("q")), [f"s_{k}" for k in KEY])
            below = F.col("q")
        own = F.greatest(F.coalesce(c - off, F.lit(0.0)), F.lit(0.0)) / F.col("total")
        p = F.when(F.col("total").isNull(), below).otherwise(own + F.col("mass") / F.col("total") * below)
        lower = materialize(row.select(*KEY, p.alias("p")))
    return lower


def perplexities(docs: DataFrame, tables: list[DataFrame], column: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` (a stored table; its text only if ``keep_text``) with ``n_symbols`` and ``perplexity`` (null for null or empty text)."""
    order = len(tables)
    asked = materialize(wanted(docs, order, column).groupBy(*KEY).agg(F.collect_list("block").alias("blocks")))
    logs = probabilities(asked.select(*KEY), tables).select(*KEY, F.log("p").alias("value"))
    valued = asked.join(logs, KEY).select(*KEY, "value", F.explode("blocks").alias("block"))
    scored = score(docs, valued, order, column, keep_text)
    return (scored.withColumn("n_symbols", F.col("_chars"))
            .withColumn("perplexity", F.when(F.col("_chars") > 0, F.exp(-F.col("_sum") / F.col("_chars")))).drop("_chars", "_sum"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as of good quality and never as bad or toxic; an id with contradicting labels is not trusted."""
    bad = F.coalesce(F.col("quality") != 1, F.lit(True)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return (labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
            .where("bad = 0").select(F.col("doc_id").alias("_trusted")))


def allowance() -> Column:
    """exp(SHORT / sqrt(characters)): what a text's perplexity may be above a long one's."""
    return F.exp(SHORT / F.sqrt(F.greatest("n_symbols", F.lit(1))))


def held_out(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(HELD_OUT)) == 0


def split(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``trusted`` (_trusted) with ``_held``: one document in ``HELD_OUT``, and one of each language with several that has none by that."""
    row = F.xxhash64("_trusted")
    mine = docs.select("doc_id", "lang").join(trusted, F.col("doc_id") == F.col("_trusted")).select("lang", "_trusted").distinct()
    spare = (mine.groupBy("lang").agg(F.max(held_out("_trusted")).alias("any"), F.count("*").alias("n"), F.min_by("_trusted", row).alias("_spare"))
             .where("not any and n > 1").select("_spare").distinct())
    spare = small_or_shuffled(materialize(spare))
    return (trusted.join(spare, F.col("_trusted") == F.col("_spare"), "left")
            .select("_trusted", (held_out("_trusted") | F.col("_spare").isNotNull()).alias("_held")))


def thresholds(scored: DataFrame, kept_share: float = KEPT_SHARE, room: float = ROOM) -> DataFrame:
    """_lang, threshold of each language that has trusted documents (``trusted`` true) without training.

    Logarithms of perplexities are compared less their allowance.  A
    language's n documents give its centre (mean) and its own quantile.  The
    quantile counts n times, and ``PRIOR`` times the centre plus the quantile of the
    distances from their centres over all languages plus ``ERRORS`` standard
    errors of the centre: few documents do not tell a quantile, but their level is always
    that of their own language.  Both quantiles are exact at every size.
    """
    x, n = F.log(F.col("perplexity") / allowance()), F.col("n")
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))  # null is a language of its own
    logs = materialize(scored.where("trusted and perplexity is not null").select("lang", key.alias("_key"), x.alias("x")))
    by_lang = materialize(logs.groupBy("_key").agg(
        F.first("lang").alias("_lang"), F.count("*").alias("n"), F.avg("x").alias("centre"), F.var_pop("x").alias("var"))
        .join(exact_quantile(logs, ["_key"], "x", kept_share, "own"), "_key").drop("_key"))
    several = by_lang.where("n > 1")
    freedom = several.agg(F.sum(n * F.col("var")), F.sum(n - 1)).first()
    spread = max(freedom[0], 0.0) ** 0.5 / freedom[1] ** 0.5 if freedom[1] else SPREAD
    off = (F.col("x") - F.col("centre")) * F.sqrt(n / (n - 1))
    apart = logs.join(small_or_shuffled(several), F.col("lang").eqNullSafe(F.col("_lang"))).select(off.alias("off"))
    tail = exact_quantile(apart, [], "off", kept_share, "tail").first()
    tail = max(tail[0], 0.0) if tail else 2.6 * spread
    common = F.col("centre") + tail + ERRORS * spread / F.sqrt(n)
    return by_lang.select("_lang", (F.exp((n * F.col("own") + PRIOR * common) / (n + PRIOR)) * room).alias("threshold"))


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, kept_share: float = KEPT_SHARE, keep_text: bool = True) -> DataFrame:
    """``docs`` (a stored table with doc_id, text, lang and any others; the text is left out unless ``keep_text``) with n_symbols, perplexity, threshold and kept.

    All trusted text is counted, but for the held-out fifth, and every
    document is scored whole.  A document is kept if its perplexity is at
    most its threshold, which includes its allowance.  Null or
    empty text has no perplexity and is not kept.  In a language without any held-out trusted
    document (of a single trusted one, none is held out) there is nothing to compare with: its threshold is null and all
    its documents that have text are kept.  Repeated rows are scored each on its own; added columns replace
    columns of the same name.
    """
    docs = docs.drop("n_symbols", "perplexity", "threshold", "kept")
    trusted = materialize(trusted_ids(labels))
    marked = small_or_shuffled(materialize(split(docs, small_or_shuffled(trusted))))
    learned = marked.where("not _held")
    tables = train(docs.select("doc_id", "text").join(learned, F.col("doc_id") == F.col("_trusted"), "left_semi"), order)
    scored = materialize(perplexities(docs, tables, keep_text=keep_text))
    held = marked.where("_held").withColumn("trusted", F.lit(True))
    flags = scored.select("doc_id", "lang", "perplexity", "n_symbols").join(held, F.col("doc_id") == F.col("_trusted"))
    by_lang = small_or_shuffled(materialize(thresholds(flags, kept_share)))
    joined = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return decide(joined.withColumn("threshold", F.col("threshold") * allowance()))


def decide(scored: DataFrame) -> DataFrame:
    keep: Column = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    return scored.withColumn("kept", keep)
