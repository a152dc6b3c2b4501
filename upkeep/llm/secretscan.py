"""Secret scans through a trigram index (operator 9), with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived.
The index holds, for the trigrams that any query names, the documents that
contain them; intersecting and uniting postings gives the candidates of each
rule, and the regular expression runs on these alone.  A rule from which no
trigram follows scans every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm import spans
from upkeep.llm.common import materialize, small_or_shuffled


@dataclass(frozen=True)
class Rule:
    """group: the part whose length counts (0: the whole match); least: its fewest characters, shorter matches are passed over."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in the order in which they are listed
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,100}@"),
)
RULES = BASE + MORE

#: A query: (AND of OR-sets).  None: nothing is known, every document may match.
Query = frozenset | None

#: Most strings that a part of a pattern is spelled out to.
SPELLED = 64


def _strings(items: list) -> set[str] | None:
    """All strings that a parsed sequence matches, lower-cased, if they are few; else None."""
    out = {""}
    for op, arg in items:
        if op is C.LITERAL:
            part = {chr(arg).lower()}
        elif op is C.IN and all(k is C.LITERAL for k, _ in arg):
            part = {chr(v).lower() for _, v in arg}
        elif op is C.SUBPATTERN:
            part = _strings(arg[-1])
        elif op is C.BRANCH:
            each = [_strings(x) for x in arg[1]]
            part = None if None in each else set().union(*each)
        elif op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 3:
            one = _strings(arg[2])
            part = None if one is None else {s for n in range(arg[0], arg[1] + 1) for s in reduce(lambda a, _: {x + y for x in a for y in one}, range(n), {""})}
        else:
            part = None
        if part is None:
            return None
        out = {a + b for a in out for b in part}
        if len(out) > SPELLED:
            return None
    return out


def _grams(strings: set[str]) -> frozenset:
    """The set of alternatives (each a set of trigrams, all of which occur) of one spelled-out stretch; empty if one is too short."""
    if any(len(s) < 3 for s in strings):
        return frozenset()
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def trigram_query(pattern: str) -> list[frozenset]:
    """Conditions that all hold for a text with a match: each a set of alternatives, each of these a set of trigrams that occur together.

    Trigrams are of the lower-cased text.  An empty list: no trigram is mandatory.
    """
    conditions: list[frozenset] = []

    def visit(items: list) -> None:
        run: set[str] = {""}

        def close() -> None:
            nonlocal run
            if grams := _grams(run):
                conditions.append(grams)
            run = {""}

        for op, arg in items:
            one = _strings([(op, arg)])
            if one is not None and len(run) * len(one) <= SPELLED:
                run = {a + b for a in run for b in one}
                continue
            close()
            if one is not None:
                run = one
            elif op is C.SUBPATTERN:
                visit(list(arg[-1]))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
                visit(list(arg[2]))
        close()

    visit(list(_parser.parse(pattern)))
    return conditions


def index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (gram, doc_id) of every trigram that some rule's query names."""
    grams = sorted({g for r in rules for cond in trigram_query(r.pattern) for alt in cond for g in alt})
    if not grams:
        return docs.select(F.lit("").alias("gram"), "doc_id").where(F.lit(False))
    low = docs.select("doc_id", F.lower("text").alias("low"))
    present = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("low"), g))
    return low.select("doc_id", F.explode(present).alias("gram")).distinct()


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and one Boolean column for each rule with mandatory trigrams: whether the document's postings meet its query."""
    flags = {}
    for r in rules:
        conds = trigram_query(r.pattern)
        if conds:
            have = lambda g: F.max(F.col("gram") == F.lit(g))
            flags[r.name] = reduce(Column.__and__, (reduce(Column.__or__, (reduce(Column.__and__, map(have, sorted(alt))) for alt in sorted(cond, key=sorted))) for cond in conds))
    if not flags:
        return postings.select(F.col("doc_id").alias("_doc")).where(F.lit(False))
    out = postings.groupBy("doc_id").agg(*[v.alias(f"_may_{k}") for k, v in flags.items()])
    return out.where(reduce(Column.__or__, (F.col(f"_may_{k}") for k in flags))).withColumnRenamed("doc_id", "_doc")


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end) of the rule's matches: leftmost, not overlapping, in code points; too short ones are left out after matching."""
    inner = re.sub(r"^\(\?i\)", "", rule.pattern)
    flag = "(?i)" if rule.pattern.startswith("(?i)") else ""
    stepped = F.lit(rf"{flag}([\s\S]*?)({inner})|[\s\S]+")
    gaps, whole = F.regexp_extract_all(text, stepped, F.lit(1)), F.regexp_extract_all(text, stepped, F.lit(2))
    core = whole if not rule.group else F.regexp_extract_all(text, stepped, F.lit(2 + rule.group))
    lengths = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(whole, F.length).alias("len"), F.transform(core, F.length).alias("core"))
    kind = "array<struct<start:int,kind:int,stop:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.array(F.struct(begin.alias("start"), F.lit(order).alias("kind"), (begin + x["len"]).alias("stop")))
        keep = (x["len"] > 0) & (x["core"] >= rule.least)
        return F.struct((begin + x["len"]).alias("at"), F.when(keep, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(lengths, start, step, lambda acc: acc["found"])


def _quick(rule: Rule) -> Column:
    """Whether the rule's expression occurs at all, with its least length where that is the whole match's."""
    simple = re.fullmatch(r"(.*\])\+", rule.pattern)
    if simple and not rule.group and rule.least and rule.pattern.startswith("["):
        return F.col("text").rlike(f"{simple[1]}{{{rule.least}}}")
    return F.col("text").rlike(rule.pattern)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``found``: array of (start, kind, stop), sorted; kind is the rule's place in ``rules``.

    Null text counts as empty.  Rows that share a doc_id (or have none) share
    their candidates, which costs time at most, as every candidate is verified.
    Spans of different rules may overlap.
    """
    postings = materialize(index(docs.select("doc_id", "text"), rules))
    may = small_or_shuffled(materialize(candidates(postings, rules)))
    joined = docs.join(may, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    each = []
    for k, r in enumerate(rules):
        indexed = f"_may_{r.name}"
        test = F.coalesce(F.col(indexed), F.lit(False)) if indexed in may.columns else F.lit(True)
        each.append(F.when(test & _quick(r), spans_of(F.col("text"), r, k)).otherwise(F.array().cast("array<struct<start:int,kind:int,stop:int>>")))
    extra = [c for c in may.columns]
    return joined.withColumn("found", F.array_sort(F.concat(*[F.coalesce(e, F.array().cast("array<struct<start:int,kind:int,stop:int>>")) for e in each]))).drop(*extra)


def spelled(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``; overlapping spans make one stretch."""
    return spans.redact(text, found, mark)
