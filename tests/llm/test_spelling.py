"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessella.llm import spelling as S


def counted(rows):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words):
    near = {w: [] for w in words}
    names = sorted(words)
    for i, a in enumerate(names):
        for b in names[:i]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in names:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in names:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, words[w], form[w], words[form[w]] if form[w] else None, len(near[w]), root))
    return out


def got(frame):
    return sorted(tuple(r) for r in frame.select("word", "n", "form", "form_n", "n_near", "root").collect())


def random_words(seed, n, letters, size):
    """Words that crowd together: copies of earlier words with none to two edits."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        w = list(rng.choice(list(letters), int(rng.integers(5, size))))
        if out and rng.random() < 0.7:
            w = list(out[rng.integers(len(out))])
            for _ in range(rng.integers(0, 3)):
                k, c = int(rng.integers(len(w) + 1)), rng.choice(list(letters))
                w[k:k + int(rng.integers(2))] = [c] if rng.random() < 0.7 else []
        if len(w) >= 5:
            out.append("".join(w))
    return {w: int(rng.integers(3, 60)) for w in out}


@pytest.mark.parametrize(("letters", "size", "crowded"), [("abcdé", 8, 24), ("ab", 9, 24), ("ab", 9, 2), ("aÿ", 30, 0), ("abcdefghij", 7, 4)])
def test_all_near_pairs_and_roots(spark, monkeypatch, letters, size, crowded):
    monkeypatch.setattr(S, "CROWDED", crowded)
    words = random_words(len(letters) + size, 300, letters, size)
    words |= {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 20, "a" * 40: 5, "a" * 41: 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(S.variants(frame)) == expected(words)


def test_words_of_documents(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 50)
    monkeypatch.setattr(S, "STRETCH", 40)
    rng = np.random.default_rng(8)
    pool = list(random_words(1, 60, "abcÀé", 8)) + ["X", "don't", "1234", "naïveté", "×÷×÷×", "ÉCOLE"]
    rows = [(int(rng.integers(10**9)), " ".join(rng.choice(pool, int(rng.integers(0, 80))))) for _ in range(300)]
    rows += [(None, "naïveté naïveté naïveté"), (1, None), (2, ""), rows[0], rows[0], (3, "verylongtext " * 50_000), (4, "y" * 3000)]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    words = counted(rows)
    assert {r.word: r.n for r in S.count_words(frame).collect()} == words
    assert got(S.spelling_variants(frame)) == expected(words)


def test_no_words(spark):
    assert S.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert S.spelling_variants(spark.createDataFrame([(1, "one two")], "doc_id long, text string")).count() == 0


def test_pivots_are_the_rarest_disjoint_bigrams():
    rng = np.random.default_rng(2)
    for _ in range(300):
        word = "".join(rng.choice(list("abcd"), int(rng.integers(5, 12))))
        count = {a + b: int(rng.integers(1, 9)) for a in "abcd" for b in "abcd"}
        rank = {g: k for k, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
        starts, indexed, last = S.prefix_grams(word, rank)
        assert len(starts) == 3 and set(starts) <= set(indexed) and all(rank[word[i:i + 2]] <= last for i in indexed)
        p, q = S.pivots(word, starts, count)
        cost = {(i, j): count[word[i:i + 2]] + count[word[j:j + 2]] for i in starts for j in starts if j >= i + 2}
        assert cost[p, q] == min(cost.values())


def test_damage_takes_the_code_point_the_checksum_names():
    seed, word = next((s, w) for s in range(10**6) for w in ["déjàvu"] if zlib.crc32(w.encode(), s) % 97 == 0)
    assert len(S.damaged(word, seed)) == 5 and S.damaged(word, seed + 1) in (word, S.damaged(word, seed + 1))


def test_postings_are_never_broadcast(spark, monkeypatch):
    """Before: postings were sized as the words they come from, and 1.2 GB of them were broadcast on 0.5 GB of documents."""
    plans = []

    def seen(write):
        def run(df, *args, **metrics):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return write(df, *args, **metrics)
        return run
    monkeypatch.setattr(S, "materialize", seen(S.materialize))
    monkeypatch.setattr(S, "Table", seen(S.Table))
    monkeypatch.setattr(S, "CROWDED", 4)
    words = random_words(5, 200, "abcdé", 8)
    out = S.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert got(out) == expected(words)
    assert sum(p.count("SortMergeJoin") for p in plans) >= 5
    assert not any("Broadcast" in p for p in plans)
