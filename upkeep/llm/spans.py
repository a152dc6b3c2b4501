"""Match positions, running folds and redaction with DataFrame functions alone.

Spark returns what an expression matches but not where.  Here each match comes
with the gap before it, so that places are running sums of lengths.  Folds and
cuts go in blocks, so that a text with very many matches does not cost their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Items of a block of a running fold; code points of a chunk of a text that is cut.
BLOCK, CHUNK = 256, 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often the body names it, also inside its lambdas."""
    return F.transform(F.array(value), body)[0]


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """Array of the states (of type ``kind``) after each item: step(zero, first), and so on."""
    none, none_yet = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def within(s: Column, x: Column) -> Column:
        return let(step(s["state"], x), lambda new: F.struct(new.alias("state"), F.concat(s["out"], F.array(new)).alias("out")))

    def over(v: Column) -> Column:
        def block(acc: Column, b: Column) -> Column:
            part = F.aggregate(F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), F.struct(acc["state"].alias("state"), none.alias("out")), within)
            return let(part, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        last = F.floor((F.size(v) - 1) / F.lit(BLOCK)).cast("int")
        return F.aggregate(F.sequence(F.lit(0), last), F.struct(zero.cast(kind).alias("state"), none_yet.alias("out")), block, lambda acc: F.flatten(acc["out"]))

    return let(items, lambda v: F.when(F.size(v) > 0, over(v)).otherwise(none))


def matches(text: Column, pattern: str, near: int = 0) -> Column:
    """Array of (start, stop, match, near) of all matches: leftmost, not overlapping, in code points.

    ``near``: lower-cased text of up to so many code points on either side, as
    far as the next match.  The expression must not match the empty string; in
    it ``\\G`` stands for the end of the match before, and groups have no numbers.
    """
    stepped = F.lit(rf"([\s\S]*?)(?:({pattern})|\z)")  # the last one has no match, and the gap that remains
    both = F.struct(F.regexp_extract_all(text, stepped, F.lit(1)).alias("gaps"), F.regexp_extract_all(text, stepped, F.lit(2)).alias("whole"))

    def placed(v: Column) -> Column:
        ends = running(F.zip_with(v["gaps"], v["whole"], lambda g, w: F.length(g) + F.length(w)), F.lit(0), lambda s, n: s + n, "int")

        def row(e: Column, w: Column, i: Column) -> Column:
            around = F.lower(F.concat_ws(" ", F.right(v["gaps"][i], F.lit(near)), F.left(F.get(v["gaps"], i + 1), F.lit(near)))) if near else F.lit("")
            return F.struct((e[i] - F.length(w)).alias("start"), e[i].alias("stop"), w.alias("match"), around.alias("near"))

        return let(ends, lambda e: F.filter(F.transform(v["whole"], lambda w, i: row(e, w, i)), lambda x: x["match"] != ""))

    return let(both, placed)


def redact(text: Column, found: Column, mark: str) -> Column:
    """The text with every stretch that spans (with start and stop, sorted by start) cover replaced by ``mark``; overlapping spans make one stretch."""
    chunks = F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{CHUNK}}}"), F.lit(0))

    def piece(chunk: Column, g: Column) -> Column:
        first, last = (F.floor(x / F.lit(CHUNK)).cast("int") for x in (g["a"], g["b"] - 1))

        def part(k: Column) -> Column:
            begin = F.greatest(g["a"], k * CHUNK)
            return F.substr(F.get(chunk, k), begin - k * CHUNK + 1, F.least(g["b"], (k + 1) * CHUNK) - begin)

        return F.when(g["b"] > g["a"], F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")

    def cut(v: Column) -> Column:
        covered = running(v["found"], F.lit(0), lambda s, x: F.greatest(s, x["stop"]), "int")

        def gaps(c: Column) -> Column:
            before = F.transform(v["found"], lambda x, i: F.struct(F.coalesce(F.get(c, i - 1), F.lit(0)).alias("a"), x["start"].cast("int").alias("b")))
            rest = F.array(F.struct(F.element_at(c, -1).alias("a"), v["length"].alias("b")))
            return F.concat(F.filter(before, lambda g: g["b"] >= g["a"]), rest)

        return F.array_join(F.transform(let(covered, gaps), lambda g: piece(v["chunks"], g)), mark)

    whole = F.struct(chunks.alias("chunks"), found.alias("found"), F.length(text).alias("length"))
    return F.when(F.size(found) > 0, let(whole, cut)).otherwise(text)


def spelled(found: Column, names: list[str]) -> Column:
    """kind:start:stop of each span, comma-joined; kind is a span's place in ``names``."""
    listed = F.array(*[F.lit(x) for x in names])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(listed, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")
