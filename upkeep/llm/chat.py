"""Chat formatting with typed content parts (operator 5).

A message is a list of parts (text, image, audio, document).  A visitor
flattens them in order: text is escaped, other parts become placeholders and
are recorded as attachments with the tokens they expand to.  Turns are marked by control
strings; the escape keeps these out of texts and can be undone, so the
formatted text can be read back whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import partitions

#: Control strings of the template.
BEGIN, INST, INST_END, END, ROLE, ROLE_END, PART, PART_END = "<s>", "[INST]", "[/INST]", "</s>", "<|role|>", "<|text|>", "<|part|>", "<|/part|>"
CONTROLS = (BEGIN, INST, INST_END, END, ROLE, ROLE_END, PART, PART_END)
NULL_ROLE = "<\\|none|>"  # no escaped text has this form, as escaping doubles its own mark

#: Tokens of a part: an image's tiles of so many pixels a side and tokens a tile, audio's tokens a second, a document's tokens a page.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 336, 144, 25, 600

_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_MARK = re.compile("|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    """A backslash becomes two; a control string gets one after its first character and so is none any more."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Visitor:
    """Flattens the parts of messages and keeps what they refer to."""

    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: dict) -> str:
        kind = part.get("kind") or "text"
        return getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def _attached(self, part: dict, kind: str, tokens: int) -> str:
        number = len(self.attachments)
        self.attachments.append({"number": number, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self.tokens += tokens
        return f"{PART}{escape(kind)}:{number}:{tokens}{PART_END}"

    def visit_image(self, part: dict) -> str:
        tiles = -(-max(1, int(part.get("width") or 1)) // TILE) * -(-max(1, int(part.get("height") or 1)) // TILE)
        return self._attached(part, "image", tiles * TILE_TOKENS)

    def visit_audio(self, part: dict) -> str:
        return self._attached(part, "audio", max(1, round(float(part.get("seconds") or 0) * SECOND_TOKENS)))

    def visit_document(self, part: dict) -> str:
        return self._attached(part, "document", max(1, int(part.get("pages") or 1)) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> str:
        """A kind that is not known stays as a placeholder without tokens."""
        return self._attached(part, str(part.get("kind")), 0)


def turn(role: str | None, body: str, first: bool) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text under the loss mask begins and ends (assistant turns only).

    User turns stand in instruction marks; other roles are named.
    """
    head = BEGIN if first else ""
    if role == "user":
        return f"{head}{INST} {body} {INST_END}", 0, 0
    if role == "assistant":
        return f"{head} {body}{END}", len(head) + 1, len(head) + 1 + len(body)
    named = NULL_ROLE if role is None else escape(role)
    return f"{head}{ROLE}{named}{ROLE_END}{body}{END}", 0, 0


def format_turns(rows: list[tuple[str | None, list[dict]]]) -> tuple[str, list[tuple[int, int]], Visitor]:
    """Formatted text, spans under the loss mask (offsets in it) and the visitor with the attachments."""
    out, at, spans, visitor = [], 0, [], Visitor()
    for k, (role, parts) in enumerate(rows):
        text, a, b = turn(role, "".join(visitor.visit(p) for p in parts), not k)
        if role == "assistant":
            spans.append((at + a, at + b))
        out.append(text)
        at += len(text)
    return "".join(out), spans, visitor


def read_turns(formatted: str) -> list[tuple[str | None, str]]:
    """Role and (unescaped) text of each turn of a formatted text."""
    marks = [(m[0], m.start(), m.end()) for m in _MARK.finditer(formatted)]
    out, at, k = [], 0, 0
    if formatted.startswith(BEGIN):
        at, k = len(BEGIN), 1
    marks = [x for x in marks[k:] if x[0] not in (PART, PART_END)]
    k = 0
    while at < len(formatted):
        mark, a, b = marks[k]
        if a == at and mark == INST:
            _, end, at = marks[k + 1]
            out.append(("user", unescape(formatted[b + 1:end - 1])))
            k += 2
        elif a == at and mark == ROLE:
            (_, r_end, t_start), (_, end, at) = marks[k + 1], marks[k + 2]
            role = formatted[b:r_end]
            out.append((None if role == NULL_ROLE else unescape(role), unescape(formatted[t_start:end])))
            k += 3
        else:
            out.append(("assistant", unescape(formatted[at + 1:a])))
            at, k = b, k + 1
    return out


_PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,stop:long>>, attachments array<struct<number:int,kind:string,ref:string,tokens:int>>, attachment_tokens long"


def text_parts(rows: DataFrame) -> DataFrame:
    """Rows with a plain ``text`` as rows with ``parts``: one text part each (null: empty)."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                    F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))
    return rows.withColumn("parts", F.array(part).cast(_PARTS))


def format_conversations(rows: DataFrame) -> DataFrame:
    """rows: conv_id, turn, role, parts.  One formatted conversation per conv_id (see ``FORMATTED``).

    Turns stand in ascending order (null first); rows of one turn by role and
    content, repeated rows each once.  Rows without a conv_id are one
    conversation.  Null parts are no parts.  Offsets count code points.  A
    task reads its sorted rows one conversation at a time; a conversation
    becomes one value, so it is what must fit in memory.  A table without rows gives none.
    """
    sorted_ = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "parts")
               .repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", F.to_json("parts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("start", pa.int64()), ("stop", pa.int64())]), pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())])

        def made(done: list[tuple]) -> pa.RecordBatch:
            ids, texts, spans, seen = zip(*((c, *format_turns(t)) for c, t in done), strict=True)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(kinds[0])),
                pa.array([v.attachments for v in seen], pa.list_(kinds[1])), pa.array([v.tokens for v in seen], pa.int64())],
                ["conv_id", "formatted", "loss", "attachments", "attachment_tokens"])

        current, turns, done, begun = None, [], [], False
        for batch in batches:
            for conv, role, parts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "parts")), strict=True):
                if begun and conv != current:
                    done.append((current, turns))
                    turns = []
                    if len(done) >= 200:
                        yield made(done)
                        done = []
                current, begun = conv, True
                turns.append((role, parts or []))
        if begun:
            yield made([*done, (current, turns)])

    return sorted_.select("conv_id", "role", "parts").mapInArrow(run, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the formatted texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
                turns = read_turns(text)
                whole = "".join(f"{r or ''}\n{t}\n" for r, t in turns)
                under = "".join(unescape(text[x["start"]:x["stop"]]) for x in loss)
                rows.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                                             ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
