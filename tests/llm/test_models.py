"""Similarity search, near duplicates, language, quality, LM scores, chats and the pipeline on small tables."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import language, lm_score, near_duplicates, nearest, quality, transcripts
from tessella.llm.queries import QUERIES, table

FOLD = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def test_ngram_join_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()]
    got = QUERIES["op8_ngram_join"](spark, sf).orderBy("doc_id").select("doc_id", "n_shingles", "component_id").collect()
    assert [tuple(r) for r in got] == components(docs)


def test_ngram_join_chains_and_odd_rows(spark):
    base = [f"w{i}" for i in range(60)]
    chain = [(10 + k, " ".join(base[3 * k:] + [f"new{i}" for i in range(3 * k)])) for k in range(8)]
    docs = [*chain, (1, None), (2, ""), (3, "x y"), (4, "X  y"), (5, "x"), (5, "x"), (None, "x y"), (None, "lonely text without any other like it"), (40, "long " * 20000)]
    df = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, n int, node string")
    got = near_duplicates.near_duplicates(df).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got)) == sorted(map(key, components(docs)))
    assert near_duplicates.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 3, 2), (3, 2, 1, 0)])
def test_ngram_join_of_several_texts_under_one_id(spark, order):
    w, v = " ".join(f"w{i}" for i in range(80)), " ".join(f"v{i}" for i in range(80))
    docs = [(1, w), (1, v), (2, w + " more"), (3, v + " else")]
    df = spark.createDataFrame([docs[k] for k in order], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_nearest_query_and_odd_rows(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    got = {}
    for r in QUERIES["op2_nearest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]]
        mine = sorted(got[ids[q]])
        assert [m[0] for m in mine] == list(range(1, 21))
        hits, total = hits + len(set(want) & {m[1] for m in mine}), total + 20
        assert all(abs(m[2] - s[np.flatnonzero(ids == m[1])[0]]) < 1e-9 for m in mine)
    assert hits >= 0.9 * total
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.5, 0.5]), (None, [1.0, 1.0]), (20, [1.0, 0.0]),
           (7, [1.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    out = nearest.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in out] == [(0, 1), (0, 20), (0, 6), (20, 0), (20, 1), (20, 6)]
    assert nearest.nearest(df.where("false"), F.lit(True)).count() == 0


def test_nearest_in_many_cells(spark, monkeypatch):
    """100 small cells of vectors without clusters, against brute force."""
    monkeypatch.setattr(nearest, "CELL_ROWS", 25)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x, hits = x.astype(float), 0
    for q in range(0, 2500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & got[q])
    assert hits >= 0.9 * 20 * 125


def test_nearest_leaves_out_only_cells_below_the_floor():
    import pyarrow as pa
    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((4000, 8)).astype(np.float32).astype(float), rng.standard_normal((30, 8)).astype(np.float32)
    centre = nearest.fit_cells(x, 160)
    cell = nearest.nearest_cell(x, centre)
    radius = np.full(160, -np.inf)
    np.maximum.at(radius, cell, np.linalg.norm(x - centre[cell], axis=1))
    score = q.astype(float) @ x.T
    floor = np.sort(score, axis=1)[:, -20]
    rows = pa.RecordBatch.from_pydict({"query": np.arange(30), "embedding": pa.array(q.tolist(), pa.list_(pa.float32())), "floor": floor})

    class Shared:
        value = (centre, None)
    visited = {(r["query"], r["cell"]) for b in nearest._probe(Shared)([rows]) for r in b.to_pylist()}
    Shared.value = (centre, radius)
    visited |= {(r["query"], r["cell"]) for b in nearest._probe(Shared)([rows]) for r in b.to_pylist()}
    assert {(i, int(cell[j])) for i, j in zip(*np.nonzero(score >= floor[:, None]), strict=True)} <= visited
    assert len(visited) < 30 * 160


def test_one_bit_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((20, 64))
    centre, turn = x.mean(0), nearest.rotation(64)
    value, bound = nearest.Codes(x, centre, turn).estimate(q, centre, turn)
    assert (np.abs(value - q @ x.T) <= bound).mean() > 0.95


def test_language_held_out(spark):
    got = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97 and got.where("score < 0 OR score > 1").count() == 0


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(f"the {i} and of is that", "en") for i in range(40)] + [(f"der {i} und die das ist", "de") for i in range(40)] + [(None, "en"), ("x", None)],
                                  "text string, lang string")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the and of"), (None, "und die das"), (6, "é"), (7, "der und " * 20000)], "doc_id long, text string").withColumn("score", F.lit("s"))
    got = language.identify(odd, language.train(train)).collect()
    assert [r.lang_pred for r in got[:5]] == ["und", "und", "und", "en", "de"] and got[5].lang_pred != "und" and got[6].lang_pred == "de"
    assert {r.lang_pred for r in language.identify(odd, language.train(train.where("false"))).collect()} == {"und"}
    assert language.identify(odd.where("false"), None).count() == 0


def test_language_features_do_not_depend_on_stretches(monkeypatch):
    texts = ["Ünï cödé " * 300, "", None, "ab", "x", "the quick brown fox " * 50, "1 2 3", "zz" * 4000]
    whole = language.features(pa.array(texts, pa.string()))
    for size in (7, 64, 1000):
        monkeypatch.setattr(language, "STRETCH", size)
        cut = language.features(pa.array(texts, pa.string()))
        assert all(np.array_equal(getattr(whole, k), getattr(cut, k)) for k in ("at", "col", "val"))


def test_quality_catches_labelled_cases(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op4_quality"](spark, sf).join(table(spark, sf, "labels").withColumnsRenamed({"quality": "q", "toxic": "t"}), "doc_id")
    r = got.agg(F.avg(F.when((F.col("q") == 1) & (F.col("t") == 0), F.col("keep").cast("int"))).alias("kept"),
                F.avg(F.when((F.col("q") == 0) | (F.col("t") == 1), F.col("keep").cast("int"))).alias("missed")).first()
    assert r.kept > 0.98 and r.missed < 0.1
    odd = spark.createDataFrame([(1, None, None, None, None, "a"), (None, "", "xx", "s", 0, "b"), (3, "w " * 50000, "en", None, -5, "c")],
                                "doc_id long, text string, lang string, source string, n_chars long, keep string")
    model = quality.train(table(spark, sf, "documents"), table(spark, sf, "labels"), rounds=0)
    assert quality.score(odd, model).where("quality BETWEEN 0 AND 1").count() == 3
    assert quality.score(odd, None).where("keep").count() == 3 and quality.score(odd.where("false"), model).count() == 0
    assert quality.train(odd, table(spark, sf, "labels").where("false")) is None


def test_quality_hands_over_each_text_once(spark, sf):
    """Copies over 64 tasks are one pseudo-label; the answer is that of all documents at once, however they are cut."""
    docs = table(spark, sf, "documents")
    one = docs.where("length(text) > 200").orderBy("doc_id").limit(1)
    many = docs.unionByName(one.withColumn("doc_id", F.explode(F.sequence(F.lit(100000), F.lit(100300)))).select(docs.columns))
    models = {t: [np.ones(n) for n in (quality.TEXT_DIMENSIONS, quality.META_DIMENSIONS)] for t in quality.TARGETS}
    for most in (5, 10_000):
        limits = {t: [(60.0, 60.0), (-np.inf, -np.inf)] for t in quality.TARGETS}  # margins are counts of features here
        cut = [quality.pseudo_labels(quality._base(d).repartition(n), models, limits, most) for d, n in ((docs, 1), (many, 64))]
        for key, want in cut[0].items():
            assert cut[1][key].equals(want) and len(set(want["hash"].to_pylist())) == want.num_rows <= most
        texts = {r.text for r in docs.collect()}
        assert cut[0]["toxic", 1, 1].num_rows == min(most, len(texts))
        assert cut[0]["toxic", 0, 0].num_rows + cut[0]["toxic", 0, 1].num_rows >= min(most, len(texts)) and not cut[0]["toxic", 1, 0].num_rows
    assert quality._limits((0.0, 1.0), 0.9) == (-np.inf, np.inf)
    low, high = quality._limits((2.0, 1.0), 0.9)
    assert 1 / (1 + np.exp(-(2 * high + 1))) == pytest.approx(0.9) and 1 / (1 + np.exp(-(2 * low + 1))) == pytest.approx(0.1)


def test_lm_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocabulary, weights = lm_score.train(docs)
    net, plain = lm_score.Network(len(vocabulary), weights), lm_score.Network(len(vocabulary))
    # the network's own sum over classes and words is 1, and a direct forward pass gives the same numbers
    context = np.random.default_rng(2).integers(0, len(vocabulary), (5, 6))
    p = net.class_log_probs(net.tables(), context)
    emb, place, bias, out, out_bias = net.parts
    for row, want in zip(context, p, strict=True):
        z = np.tanh(sum(emb[w] @ place[k] for k, w in enumerate(row)) + bias) @ out + out_bias
        assert np.allclose(want, z - np.log(np.exp(z).sum()), atol=1e-4)
    mass = np.exp(vocabulary.log_share[1:])
    assert np.allclose(np.bincount(vocabulary.cls[1:], mass, lm_score.CLASSES)[np.unique(vocabulary.cls[1:])], 1)
    import pyarrow as pa
    h, rows = lm_score._words(pa.array([r.text for r in docs.limit(30).collect()]))
    trained, untrained = (lm_score.log_probs(vocabulary, m, m.tables(), h, rows).mean() for m in (net, plain))
    assert trained > untrained
    odd = spark.createDataFrame([(1, None), (2, "!!"), (None, "a"), (4, "word " * 30000), (4, "word word")], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = lm_score.pseudo_likelihood(odd, 1).collect()
    assert [r.n_tokens for r in got] == [0, 0, 1, 30000, 2] and got[0].mean_log_prob is None and got[0].log_likelihood == 0
    assert lm_score.pseudo_likelihood(odd.where("false"), 1).count() == 0


def test_lm_rare_words_have_their_own_share(spark, monkeypatch):
    """Two words of one bucket differ by the log of their counts."""
    monkeypatch.setattr(lm_score, "WORDS", 1)
    monkeypatch.setattr(lm_score, "GROWTH", 0)
    monkeypatch.setattr(lm_score, "BUCKETS", 1)
    words = ["kept"] * 40 + ["often"] * 8 + ["once"] + ["twice"] * 2
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    got = {r.text: r.mean_log_prob for r in lm_score.pseudo_likelihood(docs, 1).join(docs, "doc_id").collect()}
    assert got["often"] - got["once"] == pytest.approx(np.log(8)) and got["twice"] - got["once"] == pytest.approx(np.log(2))


def test_lm_context_tells_words_of_one_class(spark):
    """Equally frequent words, each of which always follows one other word; a wrong one is told by its neighbours only."""
    rng = np.random.default_rng(5)
    pairs = [(f"left{i}", f"right{i}") for i in range(200)]
    docs = spark.createDataFrame([(d, " ".join(w for i in rng.permutation(200)[:100] for w in pairs[i])) for d in range(400)], "doc_id long, text string").repartition(2)
    vocabulary, weights = lm_score.train(docs, 6)
    net = lm_score.Network(len(vocabulary), weights)
    import pyarrow as pa

    def scored(text):
        return lm_score.log_probs(vocabulary, net, net.tables(), *lm_score._words(pa.array([text])))[3]

    ids = vocabulary.ids(lm_score._words(pa.array([" ".join(b for _, b in pairs)]))[0])
    cls, inside = vocabulary.cls[ids], []
    for i in range(200):
        other = next((j for j in range(200) if j != i and cls[j] == cls[i]), None)
        if other is not None:
            around = f"{pairs[(i + 7) % 200][0]} {pairs[(i + 7) % 200][1]} {pairs[i][0]} %s {pairs[(i + 9) % 200][0]} {pairs[(i + 9) % 200][1]}"
            share = vocabulary.log_share[ids[i]] - vocabulary.log_share[ids[other]]
            inside.append(scored(around % pairs[i][1]) - scored(around % pairs[other][1]) - share)
    assert len(inside) > 50 and np.mean(inside) > 0.5
    # all words together have probability 1
    every = np.arange(1, len(vocabulary))
    hidden = np.repeat(net.hidden(net.tables(), np.array([[1, 2, 3, 4, 5, 6]])), len(every), 0)
    p = np.exp(net.classes(hidden[:1])[0][vocabulary.cls[every]] + net.word_log_probs(vocabulary, hidden, every))
    assert p.sum() == pytest.approx(np.exp(net.classes(hidden[:1])[0][np.unique(vocabulary.cls[every])]).sum(), abs=1e-4)


@pytest.mark.parametrize("rounds", [1, 2, 6])
def test_lm_rounds_predict_every_word_once(rounds):
    import pyarrow as pa
    h, rows = lm_score._words(pa.array(["one", "a b c d e f g h", None, "x y", *[f"w{i} short text" for i in range(50)]]))
    got = [lm_score._targets(h, rows, r, rounds) for r in range(rounds)]
    assert sorted(np.concatenate(got).tolist()) == list(range(len(h)))


def test_lm_vocabulary_grows(spark):
    docs = spark.createDataFrame([(i, " ".join(f"x{i}y{j}" for j in range(1000))) for i in range(400)], "doc_id long, text string")
    assert len(lm_score.corpus_vocabulary(docs).hashes) == int(16 * 400_000 ** 0.5)


@pytest.mark.parametrize("block", [2048, 3])
def test_blocks_do_not_change_the_path(spark, sf, monkeypatch, block):
    monkeypatch.setattr(transcripts, "BLOCK", block)
    turns = table(spark, sf, "conversations").withColumn("conv_id", F.col("conv_id") % 3)
    rows = transcripts.format_chats(turns).collect()
    lines = sorted(transcripts.ordered(turns).collect(), key=lambda r: (r.conv_id, r._rank))
    model = transcripts.train(transcripts.ordered(turns))
    want, last = {}, None
    for conv in {r.conv_id for r in lines}:
        mine = [r for r in lines if r.conv_id == conv]
        features = {k: np.array([r[k] for r in mine]) for k in transcripts._FEATURES}
        for r, s in zip(mine, model.decode(model.emissions(features), model.moves(features), model.entry()), strict=True):
            if (conv, r._row, s) != last:
                want[conv, r._rank] = model.roles[s]
            last = conv, r._row, s
    assert {(r.conv_id, r.line): r.role_pred for r in rows} == want and len(rows) == len(want)


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    for _ in range(20):
        model = transcripts.Model(["assistant", "system", "user"], rng.integers(0, 9, (2, 4, 3)), {k: rng.integers(0, 9, (3, n)) for k, n in transcripts._SIZES.items()})
        f = {k: rng.integers(0, n, 6) for k, n in transcripts._SIZES.items()}
        emit, moves = model.emissions(f), model.moves(f)

        def total(path):
            return sum(model.steps[k, b, s] + e[s] for e, k, b, s in zip(emit, moves, (3, *path), path))
        got = model.decode(emit, moves, model.entry())
        assert total(got) == pytest.approx(max(map(total, itertools.product(range(3), repeat=6))))


def test_transcript_in_one_row(spark, sf):
    """Lines of one row are given to their speakers, with labelled rows that hold no marker at all."""
    turns = table(spark, sf, "conversations")
    one = [(900001, 0, None, "Human: hi there\nAI: yes indeed\n\nand more\nHuman: ok then"), (900002, 0, None, "[INSTRUCTION] be brief\nQ: what is it?\nA: a thing  "),
           (900003, 0, None, "plain words\nof one speaker")]
    found = transcripts.format_chats(turns.unionByName(spark.createDataFrame(one, "conv_id long, turn int, role string, text string").select(
        *[F.col(c).cast(t).alias(c) for c, t in turns.select("conv_id", "turn", "role", "text").dtypes])))
    got = sorted((r.conv_id, r.line, r.role_pred, r.rendered, r.text) for r in found.where("conv_id > 900000").collect())
    assert [g[:4] for g in got[:6]] == [
        (900001, 1, "user", "<|user|>\nhi there\n"), (900001, 2, "assistant", "<|assistant|>\nyes indeed\n\nand more\n"), (900001, 5, "user", "<|user|>\nok then\n"),
        (900002, 1, "system", "<|system|>\nbe brief\n"), (900002, 2, "user", "<|user|>\nwhat is it?\n"), (900002, 3, "assistant", "<|assistant|>\na thing\n")]
    assert len(got) == 7 and got[6][4] == one[2][3]
    for conv, _, _, text in one:
        assert "\n".join(g[4] for g in got if g[0] == conv) == text


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "Human: hi  "), (1, 1, "assistant", "AI: yes"), (1, 1, "assistant", "AI: yes"), (1, None, None, None), (None, 5, "user", "q: what?"), (None, None, None, ""),
            (2, 0, "system", "be nice " * 20000), (2, 1, "user", "line\n" * 20000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("line", F.lit("x")).withColumn("_row", F.lit("mine")).withColumn("marker", F.col("turn"))
    got = transcripts.format_chats(df).collect()
    assert len(got) >= len(rows) and any(r.rendered == "<|user|>\nhi\n" for r in got) and {r["_row"] for r in got} == {"mine"}
    assert sorted((r.conv_id or 0, r.turn or 0) for r in got if r.marker == r.turn) == sorted((r.conv_id or 0, r.turn or 0) for r in got)
    assert "\n".join(r.text for r in sorted(got, key=lambda r: r.line) if (r.conv_id, r.turn) == (2, 1)) == rows[-1][3]
    assert transcripts.format_chats(df.withColumn("role", F.lit(None).cast("string"))).where("role_pred IS NULL").count() == len(rows)
    assert transcripts.format_chats(df.where("false")).count() == 0


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents").limit(150).collect()
    extra = [(9001, docs[0].text, "fr", "x", 5), (9002, None, None, None, None), (9003, "12 34", "en", "x", 5), (None, "only here and nowhere else in all these pages", "en", "x", 5)]
    df = spark.createDataFrame([tuple(d) for d in docs] + extra, table(spark, sf, "documents").schema)
    known = corpus_pipeline.known_language(spark, df, sf)
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in known.collect()} >= {9002, 9003}
    one = corpus_pipeline.one_of_each_group(spark, known, sf)
    rows = [(r.doc_id, r.text) for r in known.collect()]
    keep = {d for d, _, c in components([r for r in rows if r[0] is not None]) if d == c}
    assert {r.doc_id for r in one.collect()} == keep | {None}
    clean = corpus_pipeline.uncontaminated(spark, one, sf)
    bad = {r.doc_id for r in QUERIES["op3_decontamination"](spark, sf).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == (keep | {None}) - bad and clean.columns == df.columns
    assert corpus_pipeline.packed(spark, clean, sf).select("doc_id").distinct().count() == clean.count()


def test_pipeline_keeps_user_columns_repeats_and_other_texts(spark, sf):
    docs = table(spark, sf, "documents").limit(120)
    names = ("lang_pred", "score", "quality", "toxic", "keep", "n_words", "n_hit", "spans", "items", "_id", "_row", "node", "part")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names])
    one = wide.where(F.length("text") > 300).orderBy("doc_id").limit(1)
    text = F.lit("quite another text under the same name that stands in no other document of this table at all")
    wide = wide.unionByName(one).unionByName(one.withColumn("text", text)).cache()
    ids = {r.doc_id for r in one.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, wide, sf).cache()
        assert got.columns == wide.columns and got.schema.simpleString() == wide.schema.simpleString()
        assert got.exceptAll(wide).count() == 0
        assert stage(spark, wide.where("false"), sf).count() == 0
    kept = corpus_pipeline.one_of_each_group(spark, wide, sf).where(F.col("doc_id").isin(*ids)).select("text").collect()
    assert len(kept) == len({r.text for r in kept}) == 2


def _plain_step(net, vocabulary, context, target, rate=0.08):
    """The training step with every softmax written out."""
    emb, place, bias, out, out_bias = net.parts
    n, hidden_width = len(target), len(bias)
    x = emb[context].reshape(n, -1)
    hidden = np.tanh(x @ place.reshape(-1, hidden_width) + bias)

    def softmax(z):
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    p = softmax(hidden @ out + out_bias)
    p[np.arange(n), vocabulary.cls[target]] -= 1
    p /= n
    d_hidden, d_words = p @ out.T, np.zeros_like(net.words)
    for c in np.unique(vocabulary.cls[target]):
        some, lo, hi = np.flatnonzero(vocabulary.cls[target] == c), vocabulary.bounds[c], vocabulary.bounds[c + 1]
        z = softmax(hidden[some] @ net.words[lo:hi].T + vocabulary.offset[lo:hi])
        z[np.arange(len(some)), vocabulary.slot[target[some]] - lo] -= 1
        d_hidden[some] += z @ net.words[lo:hi] / n
        d_words[lo:hi] = z.T @ hidden[some] / len(some)
    d_hidden *= 1 - hidden * hidden
    d_emb = np.zeros_like(emb)
    np.add.at(d_emb, context.reshape(-1), (d_hidden @ place.reshape(-1, hidden_width).T).reshape(-1, emb.shape[1]))
    grad = np.concatenate([g.reshape(-1) for g in (d_emb, x.T @ d_hidden, d_hidden.sum(0), hidden.T @ p, p.sum(0), d_words)])
    net.squares += grad * grad
    net.flat -= rate * grad / np.sqrt(net.squares)


def _zipf(words):
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 60, words)).astype(np.uint64)
    vocabulary = lm_score.Vocabulary(h, (1e6 / np.arange(1, len(h) + 1)).astype(np.int64) + 1, rng.integers(50, 3000, lm_score.BUCKETS))
    share = vocabulary.count / vocabulary.count.sum()
    return vocabulary, lambda n: (rng.choice(len(share), (n, 2 * lm_score.SIDE), p=share), rng.choice(len(share), n, p=share))


@pytest.mark.parametrize("scale", [1, 60])
def test_lm_step_is_the_plain_one(scale):
    """Also with weights so large that exp needs rows shifted by their maximum."""
    vocabulary, batch = _zipf(3000)
    nets = [lm_score.Network(len(vocabulary)) for _ in range(2)]
    for net in nets:
        net.words += np.random.default_rng(1).standard_normal(net.words.shape).astype(np.float32) * 0.1 * scale
        net.parts[3][:] *= scale
    for _ in range(3):
        context, target = batch(2000)
        nets[0].step(vocabulary, context, target)
        _plain_step(nets[1], vocabulary, context, target)
    assert np.isfinite(nets[0].flat).all() and np.allclose(nets[0].flat, nets[1].flat, atol=2e-3 * scale)
    hidden, cls = nets[0].hidden(nets[0].tables(), context), vocabulary.cls[target]
    assert np.allclose(nets[0].class_log_prob(hidden, cls), nets[0].classes(hidden)[np.arange(len(cls)), cls], atol=1e-3)
    at = vocabulary.slot[target[:50]]
    lo, hi = vocabulary.bounds[cls[:50]], vocabulary.bounds[cls[:50] + 1]
    want = []
    for k in range(50):
        z = nets[0].words[lo[k]:hi[k]].astype(np.float64) @ hidden[k] + vocabulary.offset[lo[k]:hi[k]]
        want.append(z[at[k] - lo[k]] - z.max() - np.log(np.exp(z - z.max()).sum()))
    assert np.allclose(nets[0].word_log_probs(vocabulary, hidden[:50], target[:50]), want, atol=1e-3)


def test_lm_scores_pass_over_all_pairs_once():
    """Scoring words took as long as every softmax written out."""
    import time
    vocabulary, batch = _zipf(19000)
    net = lm_score.Network(len(vocabulary))
    context, target = batch(1 << 15)
    hidden = net.hidden(net.tables(), context)
    cls = vocabulary.cls[target]

    def plain():
        net.classes(hidden)[np.arange(len(cls)), cls]
        for c in range(lm_score.CLASSES):
            some, lo, hi = np.flatnonzero(cls == c), vocabulary.bounds[c], vocabulary.bounds[c + 1]
            z = hidden[some] @ net.words[lo:hi].T + vocabulary.offset[lo:hi]
            z -= z.max(1, keepdims=True)
            z[np.arange(len(some)), vocabulary.slot[target[some]] - lo] - np.log(np.exp(z, out=z).sum(1))

    def now():
        net.class_log_prob(hidden, cls)
        net.word_log_probs(vocabulary, hidden, target)

    took = {plain: [], now: []}
    for _ in range(9):
        for f in took:
            start = time.process_time()
            f()
            took[f].append(time.process_time() - start)
    assert min(took[now]) < 0.8 * min(took[plain])
