"""Encoding, token files and packing against whole-text encoding and plain bookkeeping."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import packing, token_files
from tessella.llm.queries import QUERIES
from tessella.llm.tokens import BYTE_BPE, WORD_BPE, encoder

PIECES = ["a", "The", " ", "  ", "\n", "\t", "\r\n", ".", "'s", "don't", "é", "ü", "ß", " ", "　", "<|endoftext|>", "<|", "12", "!!", "漢字",
          "é", "Σ", "x" * 50, "$$$", "-", "\x00", "🙂"]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_encode_like_whole_texts(name, texts):
    enc = encoder(name)
    ids, counts = enc.encode(pa.array([*texts, None], pa.string()))
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts] + [[]]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=300), max_size=5), st.sampled_from([4, 128]))
@settings(max_examples=80, deadline=None)
def test_segment_round_trip(docs, block):
    flat = np.array([i for d in docs for i in d], np.uint32)
    keys = [None if k == 1 else k * 7 - 3 for k in range(len(docs))]
    payload = token_files.encode_segment(keys, np.array([len(d) for d in docs], np.int64), flat, block)
    got_keys, lens, ids = token_files.decode_segment(payload)
    assert got_keys == keys and lens.tolist() == [len(d) for d in docs] and ids.tolist() == flat.tolist()
    a, b = len(flat) // 3, len(flat) // 2 + 1
    assert token_files.read_ids(payload, a, b).tolist() == flat[a:b].tolist()


def whole(spark, sf, name):
    tok = encoder(name).tok
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    return {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 0] for r in rows}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_query(spark, sf):
    want, at = [], 0
    for doc, ids in whole(spark, sf, BYTE_BPE).items():
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    got = QUERIES["op9_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_packing_query(spark, sf):
    want = whole(spark, sf, WORD_BPE)
    rows = QUERIES["op5_best_fit_packing"](spark, sf).collect()
    check_places(rows)
    seen = {}
    for r in rows:
        assert r.start == 2048 * r.piece
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length and crc(ids) == r.ids_crc32
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {d: len(i) for d, i in want.items()}
    total = sum(seen.values())
    assert len({r.sequence_id for r in rows}) <= -(-total // 2048) + 1


def check_places(rows, capacity=2048):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@given(st.dictionaries(st.integers(1, 20), st.integers(1, 9), max_size=8))
@settings(max_examples=150, deadline=None)
def test_fullest_matches_enumeration(counts):
    reach = {0}
    for k, c in counts.items():
        reach |= {s + k * q for s in reach for q in range(1, c + 1) if s + k * q <= 20}
    combo = packing.fullest(counts, 20)
    assert sum(k * q for k, q in combo) == max(reach)
    assert all(q <= counts[k] for k, q in combo)
    plan = packing.plan_bins(counts, 20)
    used = {}
    for times, c in plan:
        assert sum(k * q for k, q in c) <= 20
        for k, q in c:
            used[k] = used.get(k, 0) + times * q
    assert used == counts


SHAPES = [(1, None), (1, "a b"), (1, "a b"), (None, "x"), (None, None), (5, ""), (6, "word " * 9000), (7, "w" * 50000)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0, 1, "p", 2.0) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, part int, nth int, ids string, length double")


def test_odd_rows(spark):
    docs = frame(spark, SHAPES)
    tok = encoder(WORD_BPE).tok
    lens = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in SHAPES)
    packed = packing.pack_documents(docs)
    check_places(packed.collect())
    assert packed.agg(F.sum("length")).first()[0] == sum(lens)
    filled = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in filled)
    back = token_files.write_and_read(docs).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, None, 1, 1, 1, 5, 6, 7]
    assert [r.start for r in back] == list(np.cumsum([0] + [r.n_tokens for r in back[:-1]]))


def test_empty(spark):
    docs = frame(spark, SHAPES).where("false")
    assert packing.pack_documents(docs).count() == 0
    assert token_files.write_and_read(docs).count() == 0


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_white_space_before_words_and_at_row_ends(name):
    texts = ["\n\na", "a\n\nb", "a \n\n b", "a  ", "b", "x\n\n", "y", " \n", "", "z", "a\t\t.", "\r\n\r\nq"]
    enc = encoder(name)
    ids, n = enc.encode(pa.array(texts))
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
