"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document is its set of distinct five-word shingles, as 64-bit hashes. Texts with one set are one class, and
only classes are joined. Two sets with Jaccard similarity of at least 3/4 must share a token among the first
``n - ceil(3n/4) + 1`` tokens of both under *any* global order of tokens. The first order (tokens that recur
often come last) is indexed and gives candidates; the other orders (two independent hash orders) must agree
before a candidate is verified on its whole sets.

What is asked for is components, so a pair inside a component that is already known need not be looked at:

1. every class is compared with one hub of each prefix token it shares (linear in the postings),
2. the links found are contracted, and
3. only prefix tokens whose classes still lie in different components give all remaining pairs between these.

Every candidate pair of step 3 is thus verified or already joined; no link between different texts is lost,
and a group of near copies costs its size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_roots
from ..session import Table, materialize
from .text import LOWER, NON_SPACE, chunks, combine, flat, hash_spans, mix, row_slices, word_spans
from .workers import lean

WORDS = 5
FREQUENT_LIMIT = 1 << 18  # tokens whose order is by count; it steers speed, not results
GROUP = 2000  # members of one token that a task or a row pair is dealt at a time
_NULL_ID = 1 << 62  # nodes of rows without doc_id start here; doc_ids are below
_ORDERS = (np.uint64(0), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def shingle_sets(col: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text; a shorter text is one shingle, none without words."""
    buf, off = flat(col)
    buf = LOWER[buf]
    starts, ends, rows = word_spans(buf, off, NON_SPACE)
    h = hash_spans(buf, starts, ends)
    at = row_slices(rows, len(off) - 1)
    grams = combine([h[k:len(h) - words + 1 + k] for k in range(words)]) if len(h) >= words else h[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            out.append(combine([h[i:i + 1] for i in range(a, b)]) ^ np.uint64(b - a))
        else:
            out.append(h[:0])
    return out


def _signature(s: np.ndarray) -> tuple[int, int]:
    a = mix(s ^ _ORDERS[1]).sum(dtype=np.uint64) + np.uint64(len(s))
    b = np.bitwise_xor.reduce(mix(s ^ _ORDERS[2])) if len(s) else np.uint64(0)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _profile(words: int):
    """Per document its set's size and signature; per task and slice, tokens that recur in different sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def recurring():
            tok, n = np.unique(np.concatenate(held), return_counts=True)
            tok, n = tok[n > 1], n[n > 1]
            k = len(tok)
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.nulls(k, pa.int64()), "n": pa.array(n, pa.int64()), "h1": pa.array(tok.view(np.int64)),
                "h2": pa.nulls(k, pa.int64()), "is_doc": pa.array(np.zeros(k, bool))})

        for chunk in chunks(batches):
            sets = shingle_sets(chunk.column("text"), words)
            sig = [_signature(s) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": chunk.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "h1": pa.array([a for a, _ in sig], pa.int64()), "h2": pa.array([b for _, b in sig], pa.int64()),
                "is_doc": pa.array([True] * len(sets), pa.bool_())})
            for s, key in zip(sets, sig, strict=True):
                if key not in seen:
                    seen.add(key)
                    held.append(s)
                    size += len(s)
            if size > 1 << 21:
                yield recurring()
                held, size = [], 0
        if held:
            yield recurring()
    return run


def prefix_size(n, t_num: int, t_den: int):
    """Tokens of a set of size ``n`` of which one at least is shared with any set at the threshold."""
    return n - (t_num * n + t_den - 1) // t_den + 1


def _ordered(s: np.ndarray, order: int, frequent=None) -> np.ndarray:
    """The tokens of a set in a global order."""
    if order:
        return s[np.argsort(mix(s ^ _ORDERS[order]))]
    tok, n = frequent
    count = np.zeros(len(s), np.int64)
    if len(tok):
        at = np.minimum(np.searchsorted(tok, s), len(tok) - 1)
        count = np.where(tok[at] == s, n[at], 0)
    return s[np.lexsort((s, count))]


def _postings(words: int, t_num: int, t_den: int, frequent):
    """Every first-order prefix token, once per set and task, with the set's node and size and the token's place in
    it. The sets of a frequent token are dealt over as many parts as its count asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, cnt = frequent.value
        seen = set()
        for chunk in chunks(batches):
            nodes = chunk.column("node").to_numpy(zero_copy_only=False)
            toks, pos, node, size = [], [], [], []
            for s, d in zip(shingle_sets(chunk.column("text"), words), nodes, strict=True):
                if not len(s) or (key := _signature(s)) in seen:
                    continue
                seen.add(key)
                p = _ordered(s, 0, (tok, cnt))[:prefix_size(len(s), t_num, t_den)]
                toks.append(p)
                pos.append(np.arange(len(p), dtype=np.int32))
                node.append(np.full(len(p), d, np.int64))
                size.append(np.full(len(p), len(s), np.int32))
            if not toks:
                continue
            t, node = np.concatenate(toks), np.concatenate(node)
            part = np.zeros(len(t), np.int32)
            if len(tok):
                at = np.minimum(np.searchsorted(tok, t), len(tok) - 1)
                parts = np.where(tok[at] == t, 2 * cnt[at] // GROUP + 1, 1)
                part = (mix(node.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int32)
                part[parts > 1] += 1  # 0: not split, so a token alone in its part has no partner
            yield pa.RecordBatch.from_pydict({"token": pa.array(t.view(np.int64)), "part": pa.array(part), "node": pa.array(node),
                                              "n": pa.array(np.concatenate(size)), "pos": pa.array(np.concatenate(pos))})
    return run


def _verify(words: int, t_num: int, t_den: int):
    """Candidates that pass every other order's prefix filter and then the similarity itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, np.ndarray] = {}
        for batch in batches:
            for b in chunks(chunks([batch], "text_a"), "text_b"):
                sides = []
                for side in "ab":
                    ids = b.column(side).to_pylist()
                    new, rows = [], []
                    for i, d in enumerate(ids):
                        if d not in cache:
                            cache[d] = None
                            new.append(d)
                            rows.append(i)
                    if new:
                        cache.update(zip(new, shingle_sets(b.column(f"text_{side}").take(pa.array(rows)), words), strict=True))
                    sides.append([cache[d] for d in ids])
                keep = [_similar(x, y, t_num, t_den) for x, y in zip(*sides, strict=True)]
                if sum(map(len, cache.values())) > 1 << 21:
                    cache.clear()
                out = b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
                if out.num_rows:
                    yield out
    return run


def _similar(x: np.ndarray, y: np.ndarray, t_num: int, t_den: int) -> bool:
    if t_den * min(len(x), len(y)) < t_num * max(len(x), len(y)):
        return False
    for order in (1, 2):
        px, py = (_ordered(s, order)[:prefix_size(len(s), t_num, t_den)] for s in (x, y))
        if not np.isin(px, py).any():
            return False
    both = np.intersect1d(x, y, assume_unique=True).size
    return t_den * both >= t_num * (len(x) + len(y) - both)


def _possible(t_num: int, t_den: int) -> str:
    """The sizes allow the threshold, and the shared token lies in both prefixes that the two sizes ask for."""
    least = f"({t_num} * (n_a + n_b) + {t_num + t_den - 1}) DIV {t_num + t_den}"
    return (f"{t_den} * least(n_a, n_b) >= {t_num} * greatest(n_a, n_b) AND pos_a <= n_a - {least} AND pos_b <= n_b - {least}")


def _links(pairs: DataFrame, texts: DataFrame, words: int, t_num: int, t_den: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar."""
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))
    return both.mapInArrow(lean(_verify(words, t_num, t_den)), "a long, b long")


def _roots(links: DataFrame) -> DataFrame:
    return connected_roots(links.select(F.lit(0).alias("_k"), "a", "b"), "_k").select("node", "root")


def several_texts(docs: DataFrame) -> DataFrame:
    """The doc_ids of ``docs`` (doc_id, text) that stand at different texts. Mostly there are none; texts are hashed, not moved."""
    h = F.coalesce(F.xxhash64("text"), F.lit(0))
    ids = docs.where("doc_id IS NOT NULL").select("doc_id", h.alias("h")).groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    return materialize(ids.where("lo < hi").select("doc_id"))


def row_ids(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``docs`` with _id: the doc_id, or a hash of doc_id and text (beyond all doc_ids) where the doc_id is null or one of ``several``."""
    own = F.lit(1 << 61) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 3)
    marked = docs.join(several.withColumn("_several", F.lit(True)), "doc_id", "left")
    return marked.withColumn("_id", F.when(F.col("doc_id").isNull() | F.col("_several").isNotNull(), own).otherwise(F.col("doc_id")))


def near_duplicates(docs: DataFrame, words: int = WORDS, t_num: int = 3, t_den: int = 4) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): doc_id, n_shingles, component_id.

    ASCII letters are lower-cased; words are runs of anything but ASCII white space. Sets are linked when their
    Jaccard similarity is at least ``t_num / t_den``. component_id is the smallest doc_id that links reach.
    Null or wordless texts have no shingles and no links. Rows with one doc_id are one document with several
    texts: what any of them is linked with belongs together. A null doc_id takes part in links but names no component:
    it is null where a component has no other. Other columns are ignored; an empty table gives no rows. Hashes of 64
    bits stand for shingles.
    """
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    several = several_texts(base)
    if not several.limit(1).count():
        return _one_text_each(base, words, t_num, t_den)
    # every text is a document first; then those of one doc_id are brought together
    named = materialize(row_ids(base, several))
    found = materialize(_one_text_each(named.select(F.col("_id").alias("doc_id"), "text"), words, t_num, t_den).distinct()
                        .select(F.col("doc_id").alias("_id"), "n_shingles", F.col("component_id").alias("comp")))
    rows = named.select("doc_id", "_several", "_id").join(found, "_id")
    parts = rows.where("_several").select("doc_id", "comp").distinct()
    same = parts.join(parts.groupBy("doc_id").agg(F.min("comp").alias("low")), "doc_id").select(F.col("comp").alias("a"), F.col("low").alias("b"))
    rooted = rows.join(_roots(same).withColumnRenamed("node", "comp"), "comp", "left").withColumn("root", F.coalesce("root", "comp"))
    return (rooted.join(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root")
            .select("doc_id", "n_shingles", "component_id"))


def _one_text_each(docs: DataFrame, words: int, t_num: int, t_den: int) -> DataFrame:
    """``near_duplicates`` where no doc_id stands at different texts."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialize(base.mapInArrow(lean(_profile(words)), "doc_id long, n long, h1 long, h2 long, is_doc boolean"))
    sets = rows.where("is_doc").drop("is_doc")
    top = (rows.where("NOT is_doc").groupBy(F.col("h1").alias("token")).agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(FREQUENT_LIMIT).toArrow())
    tok = top.column("token").to_numpy().view(np.uint64)
    by = np.argsort(tok)
    frequent = spark.sparkContext.broadcast((tok[by], top.column("n").to_numpy()[by]))

    own = F.coalesce("doc_id", F.lit(_NULL_ID) + F.shiftrightunsigned("h1", 3))
    classes = materialize(sets.where("n > 0").groupBy("h1", "h2").agg(F.min(own).alias("node"), F.max("n").alias("n")))
    # the class is found again from the text, so that no text has to be shuffled for it
    texts = base.withColumn("node", F.col("doc_id"))
    if sets.where("doc_id IS NULL AND n > 0").limit(1).count():
        lost = base.where("doc_id IS NULL").mapInArrow(lean(_with_node(words)), "doc_id long, text string, node long")
        texts = base.where("doc_id IS NOT NULL").withColumn("node", F.col("doc_id")).unionByName(lost)
    texts = texts.select("node", "text")

    posts = texts.mapInArrow(lean(_postings(words, t_num, t_den, frequent)), "token long, part int, node long, n int, pos int")
    posts = posts.withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy("token", "part"))).where("_m > 1 OR part > 0").drop("_m")
    own_class = sets.where("n > 0").select(own.alias("doc"), "h1", "h2").join(classes.select("h1", "h2", "node"), ["h1", "h2"])
    moved = materialize(own_class.where("doc != node").select(F.col("doc").alias("a"), F.col("node").alias("b")).distinct())
    # copies of a class fall to its node
    shared = materialize(posts.select("token", "node", "n", "pos").join(moved.withColumnRenamed("a", "node"), "node", "left")
                         .select("token", F.coalesce("b", "node").alias("node"), "n", "pos").distinct())

    possible = _possible(t_num, t_den)
    hub = shared.groupBy("token").agg(F.min(F.struct("node", "n", "pos")).alias("hub"), F.max("node").alias("last")).where("hub.node != last")
    first = (shared.join(hub, "token").select(F.col("node").alias("a"), F.col("hub.node").alias("b"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"),
                                              F.col("hub.n").alias("n_b"), F.col("hub.pos").alias("pos_b"))
             .where("a != b").where(possible).select("a", "b").distinct())
    known = materialize(first)
    # the texts that any pair can ask for: classes that share a prefix token with another
    asked = shared.join(hub.select("token"), "token", "left_semi").select("node").distinct()
    texts = materialize(texts.join(asked, "node", "left_semi"))
    links = materialize(_links(known, texts, words, t_num, t_den).union(moved))
    comp = materialize(_roots(links))

    at = (shared.join(comp.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    open_ = at.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    left = materialize(at.join(open_, "token", "left_semi").distinct())
    per = left.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
    big = per.groupBy("token").agg(F.max_by("comp", F.struct("m", "comp")).alias("big"), F.sum("m").alias("members"))
    left = left.join(big, "token").withColumn("parts", F.expr(f"cast(members DIV {GROUP} AS int) + 1"))
    # a hot token is dealt in blocks: each probe goes to every block, each member to its own
    probe = (left.where("comp != big").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("token", "block", F.col("node").alias("x"), F.col("comp").alias("c_x"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a")))
    member = left.select("token", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("block"), F.col("node").alias("y"),
                         F.col("comp").alias("c_y"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"))
    rest = (probe.join(member, ["token", "block"]).where("c_x != c_y").where(possible)
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    rest = Table(rest.join(known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), n=F.count(F.lit(1)))
    if rest.metrics["n"]:
        more = Table(_links(rest.df, texts, words, t_num, t_den), n=F.count(F.lit(1)))
        if more.metrics["n"]:
            comp = materialize(_roots(links.union(more.df)))

    named = sets.withColumn("node", F.when(F.col("n") > 0, own)).join(comp, "node", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"),
                        F.coalesce(F.when(F.col("root") < _NULL_ID, F.col("root")), F.when(F.col("root").isNull(), F.col("doc_id"))).alias("component_id"))


def _with_node(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            h = [_signature(s)[0] for s in shingle_sets(chunk.column("text"), words)]
            node = _NULL_ID + (np.array(h, np.int64).view(np.uint64) >> np.uint64(3)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": chunk.column("doc_id"), "text": chunk.column("text"), "node": pa.array(node)})
    return run
