import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import ODD, SF, prose
from upkeep.llm import fill_middle as fim
from upkeep.llm import frames as fr

MORE = [(200, "has <P> inside"), (201, "<S>"), (202, "a<M"), (203, "<" * 40), (204, "é中😀" * 70_000), (205, prose(9, 40_000)), (206, "S><P" * 30), (-5, "negative id"), (207, "<M" + "x" * 70_000 + "<P")]


def brute(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(x in t for x in fim.MARKS) or h3 % 100 >= 90:
        return "plain", None, None, t
    prefix, middle, suffix = t[:a], t[a:b], t[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return form, a, b, f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé中😀<PSM>", max_size=60), st.integers(1, 40), st.data())
def test_frames_against_strings(text, size, data):
    old, fr.FRAME_BYTES = fr.FRAME_BYTES, max(4, size)
    try:
        frames, ends = fr.framed(text.encode())
        assert b"".join(fr.stream(frames)).decode() == text and (ends[-1] if ends else 0) == len(text)
        for k, x in enumerate(frames):  # each frame stands alone
            assert fr.decompress(x).decode() == text[ends[k - 1] if k else 0:ends[k]]
        lo = data.draw(st.integers(0, len(text)))
        hi = data.draw(st.integers(lo, len(text)))
        out = fr.Writer()
        out.text("é".encode())
        fr.copy_units(out, frames, ends, lo, hi)
        out.close()
        assert b"".join(fr.stream(out.frames)).decode() == "é" + text[lo:hi] and out.ends[-1] == 1 + hi - lo
        if not any(x in text for x in fim.MARKS):
            for form, order in (("psm", "PSM"), ("spm", "SPM")):
                part = {"P": text[:lo], "M": text[lo:hi], "S": text[hi:]}
                made, _ = fr.framed("".join(f"<{k}>{part[k]}" for k in order).encode())
                assert b"".join(fim.restored(made, form)).decode() == text
    finally:
        fr.FRAME_BYTES = old


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = prose(3, 100_000).encode()
    frames, ends = fr.framed(text)
    assert len(frames) > 8
    opened = []
    monkeypatch.setattr(fr, "decompress", lambda x, f=fr.decompress: opened.append(1) or f(x))
    out = fr.Writer()
    for lo, hi in ((0, 200_000), (300_000, len(text)), (200_000, 300_000)):
        fr.copy_units(out, frames, ends, lo, hi)
    out.close()
    assert len(opened) <= 4
    assert b"".join(fr.stream(out.frames)) == text[:200_000] + text[300_000:] + text[200_000:300_000]


def test_rows_against_brute_force(spark, make_docs):
    rows = [*ODD, *MORE, MORE[0], *((300 + k, prose(k, 5 + k)) for k in range(200))]
    done = fim.transform(fim.frame(make_docs(rows)))
    got = sorted((str(r["doc_id"]), r["n"], r["form"], r["cut"], r["until"], r["output_sha256"], r["restored_sha256"]) for r in fim.digests(done).collect())
    want = sorted((str(i), len(t or ""), *(b := brute(i, t))[:3], sha(b[3]), sha(t or "")) for i, t in rows)
    assert got == want
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    texts = sorted((str(r["doc_id"]), r["form"], r["output"]) for r in fim.output_texts(done).collect())
    assert texts == sorted((str(i), brute(i, t)[0], brute(i, t)[3]) for i, t in rows)
    assert fim.digests(fim.transform(fim.frame(make_docs([])))).count() == 0


def test_query_over_documents(spark):
    from upkeep.llm.queries import op11_fill_middle

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_fill_middle(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        form, a, b, out = brute(r["doc_id"], texts[r["doc_id"]])
        assert (r["form"], r["prefix_chars"], r["middle_chars"]) == (form, a, None if a is None else b - a)
        assert r["output_sha256"] == sha(out) and r["restored_sha256"] == sha(texts[r["doc_id"]] or "")


def test_ambiguous_marks_are_refused(spark, make_docs):
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aba", "x", "y"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim.checked_marks(bad)
    other = ("[pre]", "[suf]", "[mid]")
    docs = make_docs([(k, prose(k, 50) + "<P>") for k in range(30)])
    got = fim.digests(fim.transform(fim.frame(docs, marks=other), marks=other), marks=other).collect()
    assert all(r["restored_sha256"] == sha(prose(r["doc_id"], 50) + "<P>") for r in got) and {r["form"] for r in got} > {"psm"}


def test_workers_get_small_batches(spark, make_docs):
    """What a worker of any step receives at once; a batch may pass the limit by its last row."""
    import random

    import pyarrow as pa

    def sizes(batches):
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.num_rows]), pa.array([x.nbytes])], ["n", "size"])

    r = random.Random(11)
    docs = make_docs([(k, "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(3000))) for k in range(900)]).select("doc_id", "text").coalesce(1)
    framed = fim.frame(docs)
    for step, given in (("frame", docs), ("transform", framed), ("digests", fim.transform(framed))):
        got = given.mapInArrow(sizes, "n long, size long").collect()
        assert sum(x["n"] for x in got) == 900 and sum(x["size"] for x in got) > 4 << 20, step
        assert max(x["size"] for x in got) < fim.BATCH_BYTES + (256 << 10), step
