"""Fill-in-middle: cuts, forms and outputs against plain Python; exact restoring."""

import hashlib
import random

import numpy as np
import pytest

from hourcast.llm import fill_in_middle as M

SCHEMA = "doc_id long, text string, n string, `OUTPUT` int, source_text int"


def brute(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if h4 % 100 < 20:
        return n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(5)
    letters = "ab <>PSM\n\0é€𝄞"
    out = [(i, "".join(rng.choices(letters, k=rng.randrange(0, 40)))) for i in range(400)]
    out += [(None, "no id"), (None, None), (900, ""), (901, None), (902, "<P>kept"), (903, "x" * 300_000),
            (904, "é𝄞" * 200_000), (905, "<"), (905, "<"), (906, "a<P<S<M")]
    return out


def test_outputs_and_restored_texts(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, "old", 7, 3) for i, t in data], SCHEMA).repartition(3)
    got = M.transform(spark, docs, restored=True)
    assert got.columns == ["doc_id", "text", "source_text", "n", "form", "prefix_chars", "middle_chars", "output",
                           "restored"]
    got = got.collect()
    key = lambda r: (str(r[0]), r[1] or "", r[1] is None)
    want = sorted(((i, t, *brute(i, t)) for i, t in data), key=key)
    have = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key)
    assert have == want
    assert all(r.restored == (r.text or "") and r.source_text == 3 for r in got)


def test_restore_needs_outputs_and_forms_only(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    out = M.transform(spark, docs).select("doc_id", "form", "output", "text")
    back = M.restore(spark, out.drop("text")).select("doc_id", "restored")
    assert sorted((str(r[0]), r[1]) for r in back.collect()) == \
        sorted((str(r[0]), r[3] or "") for r in out.collect())


def test_empty_table(spark):
    out = M.transform(spark, spark.createDataFrame([], "doc_id long, text string"), restored=True)
    assert out.collect() == [] and "restored" in out.columns
    assert M.restore(spark, out).collect() == []


@pytest.mark.parametrize("cut,spm,forms", [(0, 20, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_percentages(spark, cut, spm, forms):
    docs = spark.createDataFrame([(i, "some text") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in M.transform(spark, docs, cut_percent=cut, spm_percent=spm).collect()} == forms


def test_displacement_of_parts_without_bytes():
    moved = M.displacement(4, np.array([0, 0, 2, 2, 4]), np.array([9, 3, 5, -1, 8]))
    assert moved.tolist() == [3, 3, -1, -1]
