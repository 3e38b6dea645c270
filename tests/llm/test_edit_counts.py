"""Edit-aware counts against encoding the edited text from scratch."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import edit_counts
from tessella.llm.queries import QUERIES
from tessella.llm.tokens import BYTE_BPE, WORD_BPE, encoder

PIECES = ["a", "The", " ", "  ", "\n", ".", "'s", "don't", "é", "ü", "12", "!!", "漢字", "$$$", "word", " and", "\t"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=25).map("".join)


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
@given(TEXT, st.lists(st.tuples(st.floats(0, 1), st.integers(0, 6), TEXT), max_size=6))
@settings(max_examples=200, deadline=None)
def test_tree_equals_full_encoding(name, text, edits):
    enc = encoder(name)
    tree = next(edit_counts.trees(pa.array([text]), enc))
    now = text
    for at, n, new in edits:
        i = int(at * len(now))
        a, b = len(now[:i].encode()), len(now[:i + n].encode())
        tree.edit(a, b, new.encode())
        now = now[:i] + new + now[i + n:]
        assert tree.text().decode() == now
        assert tree.n_tokens == len(enc.tok.encode(now, add_special_tokens=False).ids)
        assert tree.n_bytes == len(now.encode())


def test_query(spark, sf):
    tok = encoder(BYTE_BPE).tok
    rows = {r.doc_id: r for r in QUERIES["op6_edit_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        raw = (d.text or "").encode()
        edits = edit_counts.redaction_edits(raw)
        for a, b, new in edits:
            raw = raw[:a] + new.encode() + raw[b:]
        r = rows[d.doc_id]
        assert r.n_edits == len(edits) and r.n_bytes == len(raw)
        assert r.n_before == len(tok.encode(d.text or "", add_special_tokens=False).ids)
        assert r.n_tokens == len(tok.encode(raw.decode(), add_special_tokens=False).ids)
    assert sum(r.n_edits for r in rows.values()) > 0
    assert sum(r.encoded_bytes for r in rows.values()) < 0.2 * sum(r.n_bytes for r in rows.values())


def test_odd_rows(spark):
    rows = [(1, None, [(0, 0, "new")]), (2, "", None), (None, "a <|endoftext|> b 12", [(0, 1, "x")]), (4, "ab", [(0, 99, None)]), (4, "ab", [(0, 99, None)]),
            (5, "w " * 20000, [(10, 12, "<|endoftext|>")]), (6, "one two", [None, (3, 4, "")])]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows],
                                 "doc_id long, text string, edits array<struct<start:long,stop:long,replacement:string>>, n_tokens int, n_before string")
    tok = encoder(BYTE_BPE).tok
    for r in edit_counts.count_edited(docs).collect():
        assert r.n_tokens == len(tok.encode(r.text, add_special_tokens=False).ids), r
    assert edit_counts.count_edited(docs.where("false")).count() == 0
    assert np.array([r.n_tokens for r in edit_counts.count_edited(docs).where("doc_id = 4").collect()]).sum() == 0
