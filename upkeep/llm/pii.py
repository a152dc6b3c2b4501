"""Personal data by patterns, checksums and context (operator 12), with DataFrame functions only.

Each rule's regular expression proposes spans, its check (Luhn, mod-97, number
ranges) confirms them, and words close by raise or lower the score that the
rule starts from.  Spans of the base kinds stay whatever their score; others
need ``LEAST``.

A row is scanned on its own, so nothing is shuffled.  Null and empty texts
have no spans; repeated rows have the same.  The expressions are possessive or
anchored at the start of a run, so that no text costs the square of its length or the stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.spans import let, matches, redact, spelled  # noqa: F401  (redact and spelled are used with ``found``)

#: Code points on either side in which context words count; least score of a span that is not of a base kind.
NEAR, LEAST = 40, 0.5
FOUND = "array<struct<start:int,kind:int,stop:int,score:double>>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Whether the digits of x pass Luhn's check: every second one from the right doubled, less 9 above 9, the sum a multiple of 10."""
    def total(rev: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            value = F.substr(rev, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + value - F.when(value > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), add)

    return let(F.reverse(digits(x)), total) % 10 == 0


def mod97(x: Column) -> Column:
    """Whether an account number passes: the first four characters last, letters as 10 to 35, the number leaves 1 modulo 97."""
    def rest(s: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(s, i, F.lit(1))) - 1
            return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)

    plain = F.replace(x, F.lit(" "), F.lit(""))
    return F.length(plain).between(15, 34) & (let(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4))), rest) == 1)


def small_parts(x: Column) -> Column:
    """Whether no part of a dotted number is above 255."""
    def fits(part: Column) -> Column:
        return let(F.regexp_replace(part, "^0+", ""), lambda s: (F.length(s) < 3) | ((F.length(s) == 3) & (s <= "255")))

    return F.forall(F.split(x, r"\."), fits)


def social_number(x: Column) -> Column:
    """Whether the three parts are numbers that are given out."""
    return ~x.rlike("^(000|666|9)|-00-|-0000$")


def n_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda x: F.length(digits(x)).between(least, most)


@dataclass(frozen=True)
class Rule:
    """start: the score without context; words: what raises it by ``more``; against: what lowers it by as much; quick: an expression that every text with a match matches."""

    name: str
    pattern: str
    start: float
    check: Callable[[Column], Column] | None = None
    words: str = ""
    against: str = ""
    more: float = 0.3
    quick: str = ""


_LOCAL = "A-Za-z0-9._%+-"
# a run of digits with single spaces or hyphens between them
_RUN = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){%s}+(?![\x20-]?[0-9])"
_CARD = "card|credit|debit|visa|mastercard|amex|karte|kreditkarte|tarjeta|carte"
_PHONE = "phone|telephone|tel|call|cell|mobile|fax|whatsapp|telefon|handy|anruf|téléphone|appel|portable|teléfono|móvil|llame"
_NUMBER = "order|invoice|isbn|serial|ref|reference|ticket|version|rechnung|bestellung|facture|commande|factura|pedido"

# The base kinds, in the order in which they are listed.  Their spans are those of these fixed values:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)   parts at most 255
#   card  [0-9]([\x20-]?[0-9])+                  14 to 19 digits, Luhn
#   phone \+[0-9][\x20().0-9-]+[0-9]             10 to 15 digits
# A match starts where a run of the first class does (or where the match before ended), and runs are taken whole.
BASE = (
    Rule("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, words="mail|email|e-mail|contact|write|schreiben|correo|courriel", quick="@[A-Za-z0-9-]"),
    Rule("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, small_parts, "ip|address|server|host|router|adresse|dirección", "version|release|section|chapter", quick=r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    Rule("card", _RUN % "13,18", 0.7, luhn, _CARD, _NUMBER, quick=r"(?:[0-9][\x20-]?+){13}[0-9]"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, n_digits(10, 15), _PHONE, _NUMBER, quick=r"\+[0-9][\x20().0-9-]"),
)
MORE = (
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}(?:\x20?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?:\x20?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         0.8, mod97, "iban|bank|account|konto|cuenta|compte", quick=r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    Rule("social", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, social_number, "ssn|social security|sozialversicherung|seguro social|sécurité sociale", _NUMBER),
    Rule("short_card", _RUN % "11,12", 0.3, luhn, _CARD, _NUMBER, quick=r"(?:[0-9][\x20-]?+){11}[0-9]"),
    Rule("local_phone", r"(?<![0-9A-Za-z+(.-])(?<!\+[0-9]{1,3}[\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
         0.3, None, _PHONE, _NUMBER, quick=r"[0-9]{3}[\x20.-][0-9]{4}"),
    Rule("ipv6", r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", 0.8, words="ip|address|host"),
    Rule("birth_date", r"(?<![0-9/.-])(?:[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[/.](?:0?[1-9]|[12][0-9]|3[01])[/.][0-9]{4})(?![0-9/.-])",
         0.3, None, "born|birth|birthday|dob|geboren|geburtstag|nacido|nacida|nacimiento|né|née|naissance", "version|release", quick="[0-9]{4}-[0-9]{2}-|[/.][0-9]{4}"),
)
RULES = BASE + MORE


def _says(near: Column, words: str) -> Column:
    return near.rlike(rf"(?<!\p{{L}})(?:{words})(?!\p{{L}})") if words else F.lit(False)


def spans_of(text: Column, rule: Rule, kind: int, base: bool) -> Column:
    """Array of (start, kind, stop, score) of the matches that pass the rule's check and, unless ``base``, reach ``LEAST``."""
    def score(near: Column) -> Column:
        told = rule.start + F.when(_says(near, rule.words), rule.more).otherwise(0.0) - F.when(_says(near, rule.against), rule.more).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), told))

    held = matches(text, rule.pattern, NEAR)
    if rule.check:
        held = F.filter(held, lambda x: rule.check(x["match"]))
    scored = F.transform(held, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["stop"].alias("stop"), score(x["near"]).alias("score")))
    if not base:
        scored = F.filter(scored, lambda x: x["score"] >= LEAST)
    return F.when(text.rlike(rule.quick or rule.pattern), scored).otherwise(F.array().cast(FOUND))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, text_column: str = "text") -> DataFrame:
    """``docs`` with ``found``: array of (start, kind, stop, score) in code points, sorted; kind is the rule's place in ``rules``.

    Spans of different rules may overlap.  A column of the name ``found`` is replaced, all others stay.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    each = [F.coalesce(spans_of(text, r, k, r in base), F.array().cast(FOUND)) for k, r in enumerate(rules)]
    return docs.withColumn("found", F.array_sort(F.concat(*each)))
