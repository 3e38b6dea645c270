"""The FM-index and the contamination digest against direct word-by-word search."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tessella.llm import decontaminate
from tessella.llm.fm_index import FMIndex
from tessella.llm.queries import QUERIES

FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, window=13):
    rows = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, passage in items:
            p = words(passage)
            for k in range(max(1, len(p) - window + 1)) if p else ():
                q = p[k:k + window]
                for i in range(len(w) - len(q) + 1):
                    if w[i] == q[0] and w[i:i + len(q)] == q:
                        hit.update(range(i, i + len(q)))
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((doc, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return rows


@given(st.lists(st.lists(st.integers(1, 4), max_size=25), max_size=6), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_index_finds_every_occurrence(runs, queries):
    text = np.array([x for r in runs for x in [*r, 0]] or [0], np.int64)
    index = FMIndex(text, 4)
    lengths = np.array([len(q) for q in queries])
    grid = np.array([q + [0] * (4 - len(q)) for q in queries])
    lo, hi = index.search(grid, lengths)
    for q, a, b in zip(queries, lo, hi, strict=True):
        want = [i for i in range(len(text) - len(q) + 1) if text[i:i + len(q)].tolist() == q]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op3_decontamination"](spark, sf).orderBy("doc_id").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    want = brute(docs, items)
    assert [tuple(r) for r in got] == want and any(r[5] for r in want)


@pytest.mark.parametrize("passes", [1, 3])
def test_odd_rows(spark, monkeypatch, passes):
    docs = [(1, None), (2, ""), (3, "the cat sat"), (3, "the cat sat"), (None, "The CAT, sat on the mat " * 2000), (5, "x"), (6, "x y x y x y")]
    items = [(1, "the cat"), (2, "cat sat on"), (3, None), (4, "!!"), (None, "the mat"), (6, "x y x"), (7, "x y x"),
             (8, " ".join("the cat sat on".split() * 5))]
    d = spark.createDataFrame([(*r, 1, "s", []) for r in docs], "doc_id long, text string, n_words int, items string, spans array<int>").withColumn("extra", F.lit(1))
    b = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, n_hit int")
    if passes > 1:
        monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 40)
    rows = decontaminate.contamination(d, b).collect()
    want = brute(docs, [i for i in items if i[0] is not None])
    anonymous = brute(docs, items)
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, len(r["items"])) for r in rows)
    assert got == sorted((x[0] or 0, x[1], y[2], x[3]) for x, y in zip(want, anonymous, strict=True))
    for r in rows:
        raw = (r.text or "").encode()
        assert sum(len(words(raw[s.byte_start:s.byte_end].decode())) for s in r.spans) == r.n_hit
    assert decontaminate.contamination(d.where("false"), b).count() == 0
    assert decontaminate.contamination(d, b.where("false")).where("n_hit > 0").count() == 0
