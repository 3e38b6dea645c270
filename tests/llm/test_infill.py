"""Fill-in-the-middle: containers against plain sets, the rewriting against a loop over code points."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z9.é漢😀\n<"), max_size=60))
def test_boundaries_are_unit_ends(text):
    ends, at = [0], 0
    for u in UNIT.findall(text):
        at += len(u.encode())
        ends.append(at)
    found = infill.BoundarySet(np.frombuffer(text.encode(), np.uint8))
    assert [found.select(k) for k in range(len(found))] == ends


def test_every_kind_of_container_over_many_blocks():
    rng = np.random.default_rng(3)
    words = " ".join("x" * int(k) for k in rng.integers(1, 9, 60_000))  # bitmaps
    text = "a" * 100_000 + "...." * 40_000 + words + ("long" * 500 + " ") * 200 + "é漢" * 50_000
    data = np.frombuffer(text.encode(), np.uint8)
    found = infill.BoundarySet(data)
    assert {type(c) for c in found.containers} == {infill.ArrayContainer, infill.BitmapContainer, infill.RunContainer}
    ends = np.cumsum([0, *(len(u.encode()) for u in UNIT.findall(text))])
    assert len(found) == len(ends)
    for k in [0, len(ends) - 1, *rng.integers(0, len(ends), 500).tolist()]:
        assert found.select(k) == ends[k]


def test_rewriting_matches_a_loop_and_gives_the_text_back(spark):
    rng = np.random.default_rng(5)
    bits = ["word", " ", "a", "Zz", "9", "\n", "é", "漢", "😀", "<", "<P", ">", ".", "<S", "M>"]
    rows = [(i, "".join(rng.choice(bits, int(rng.integers(0, 40))))) for i in range(400)]
    rows += [(7, "same row"), (7, "same row"), (None, "no id here"), (500, None), (501, ""), (502, "holds <M> in it"), (503, "b c" * 400_000), (504, "x" * 200_000)]
    docs = spark.createDataFrame([(a, b, 1, "clash") for a, b in rows], "doc_id long, text string, n int, output string")
    got = infill.fill_in_middle(docs).withColumn("back", infill.restored()).collect()
    seen = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr)
    assert seen == sorted(((i, *expected(i, t)) for i, t in rows), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)


def test_no_rows(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_draws_are_the_leading_groups_of_the_digest(spark):
    row = spark.createDataFrame([(12345,)], "doc_id long").select(*infill.draws(F.col("doc_id"))).first()
    d = hashlib.sha256(b"1:12345").hexdigest()
    assert list(row) == [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
