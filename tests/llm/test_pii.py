import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.conftest import ODD, SF, prose
from upkeep.llm import pii, spans


def luhn(d):
    return sum(v - 9 * (v > 9) for k, x in enumerate(reversed(d)) for v in [int(x) * (1 + k % 2)]) % 10 == 0


# The contract's expressions
CONTRACT = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_base(text):
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(CONTRACT.values()) for m in re.finditer(p, text or "") if ok(m[0]))


def iban(country, bban):
    number = "".join(str(int(c, 36)) for c in f"{bban}{country}00")
    return f"{country}{98 - int(number) % 97:02d}{bban}"


ACCOUNT = iban("GB", "WEST12345698765432")
PLACED = [
    (500, f"My bank account is {ACCOUNT}.", {ACCOUNT: "iban"}),
    (501, "iban " + " ".join(ACCOUNT[k:k + 4] for k in range(0, len(ACCOUNT), 4)) + " BANK OF", {" ".join(ACCOUNT[k:k + 4] for k in range(0, len(ACCOUNT), 4)): "iban"}),
    (502, f"account {ACCOUNT[:-1]}{(int(ACCOUNT[-1]) + 1) % 10}", {}),
    (503, "SSN: 123-45-6789 and 987-65-4321 or 000-12-3456", {"123-45-6789": "social"}),
    (504, "order 123-45-6789", {}), (505, "nothing said 123-45-6789 here", {}),
    (506, "Call (555) 123-4567 now", {"(555) 123-4567": "local_phone"}), (507, "invoice (555) 123-4567, call", {}), (508, "2001 555 123-4567", {}),
    (509, "phone +1 (743) 555-3824", {"+1 (743) 555-3824": "phone"}),
    (510, "born 12/31/1999, then 2001-02-03 " + "x" * 60 + " 1/2/2003", {"12/31/1999": "birth_date"}),
    (511, "host 2001:db8:0:0:1:2:3:4 up", {"2001:db8:0:0:1:2:3:4": "ipv6"}),
    (512, "visa 4222222222222 yes", {"4222222222222": "short_card"}), (513, "4222222222222 alone", {}),
    (514, "né le 14.07.1989 à", {"14.07.1989": "birth_date"}),
]
HARD = [
    (600, "a@b.c+d@e.f.g@h.i..j@k.l @m.n o@.p q@r. s@t-.u-"), (601, "1.2.3.4.5.6.7.8.256.1.1.1 0001.002.3.255 1.2.3.999999999999999999999 1.2.3.4"),
    (602, "4111111111111111 4111-1111 1111-1111 41111111111111111111 4111  1111111111111 11-4111111111111111- 0 0 0 0 0 0 0 0 0 0 0 0 0 0"),
    (603, "+1 (743) 555-3824 +12+345 67 89 01 23 +1234567890123456 ++1 234 567 8901) +49 (0) 30 1234567. +1"), (604, "1" * 60_000), (605, "a" * 60_000), (606, "1-" * 40_000 + "1"),
    (607, "a." * 30_000 + "@b" + ".c" * 30_000), (608, "1." * 40_000), (609, "+1" + "(" * 50_000 + " +1" * 20_000), (610, ("mail x%04d@é.de y@z.org 4111111111111111 " * 400) % tuple(range(400))), (611, "@" * 5000),
    (612, "😀é 10.0.0.1 中 +1 743 555 3824 😀 me@example.org"), (613, "١٢٣.1.1.1 ４１１１ 1.1.1.١"),
]


def test_base_spans_against_the_contract(spark, make_docs):
    rows = [*ODD, *HARD, HARD[0], *((i, t) for i, t, _ in PLACED)]
    for df in (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"), make_docs(rows)):
        got = pii.scan(df).select("text", "found").collect()
        assert len(got) == df.count()
        for r in got:
            assert [tuple(x)[:3] for x in r["found"] if x["kind"] < 4] == brute_base(r["text"]), (r["text"] or "")[:80]
            assert r["found"] == sorted(r["found"])
    assert pii.scan(make_docs([])).count() == 0


ALPHABET = "0123456789019 -+.()@abé"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=40, max_size=40), st.integers(0, 10**6))
def test_base_spans_of_generated_texts(spark, texts, seed):
    r = random.Random(seed)
    for _ in range(40):
        d = "".join(r.choice("0123456789") for _ in range(r.randint(13, 18)))
        d += next(x for x in "0123456789" if luhn(d + x))
        texts.append(r.choice(["", "1", "-", "+", "x "]) + "".join(c + r.choice(["", "", "", " ", "-"]) for c in d) + r.choice(["", " 1", "-2", "."]))
    for x in pii.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), pii.BASE).collect():
        assert [tuple(s)[:3] for s in x["found"]] == brute_base(x["text"]), x["text"]


def test_checks_and_context_of_the_other_kinds(spark, make_docs):
    got = {r["doc_id"]: r for r in pii.scan(make_docs([(i, t) for i, t, _ in PLACED])).collect()}
    for i, text, want in PLACED:
        found = {text[x["start"]:x["stop"]]: pii.RULES[x["kind"]].name for x in got[i]["found"]}
        assert found == want, (i, found)
        assert all(0 <= x["score"] <= 1 for x in got[i]["found"])
    # the same number, with and without context
    a, b = (pii.scan(make_docs([(1, t)])).first()["found"][0]["score"] for t in ("card 4111111111111111", "thing 4111111111111111"))
    assert a > b


def test_clean_documents_are_left_alone(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    for r in pii.scan(docs).collect():
        assert all(x["kind"] < 4 for x in r["found"])


def test_redaction_of_many_spans(spark, make_docs):
    rows = [*HARD, (700, "é" * 5000 + " a@b.cd " * 1200 + "中" * 9000 + "+1 743 555 3824"), (701, "a@b.c"), (702, None), (703, "")]
    got = pii.scan(make_docs(rows)).withColumn("clean", pii.redact(F.col("text"), F.col("found"), "[PII]")).collect()
    for r in got:
        at, out = 0, []
        for x in r["found"]:
            if x["start"] >= at:
                out += [r["text"][at:x["start"]], "[PII]"]
            at = max(at, x["stop"])
        assert r["clean"] == (None if r["text"] is None else "".join(out) + r["text"][at:])


def test_running_folds(spark):
    df = spark.createDataFrame([([],), ([5],), (list(range(1000)),), ([3, -1, 2] * 100,)], "x array<int>")
    got = df.select("x", spans.running(F.col("x"), F.lit(0), lambda s, v: s + v, "int").alias("y")).collect()
    for r in got:
        assert r["y"] == [sum(r["x"][:k + 1]) for k in range(len(r["x"]))]


def test_query_digest(spark):
    from upkeep.llm.queries import op12_personal_data

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    names = list(CONTRACT)
    rows = op12_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r["doc_id"]])
        assert [r[f"n_{n}"] for n in names] == [sum(x[1] == k for x in base) for k in range(4)]
        spelled = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x.split(":")[0] in names] == spelled
    assert prose(1, 2)
