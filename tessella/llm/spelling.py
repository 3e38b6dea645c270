"""Groups of spelling variants: words one edit apart, found by pivotal bigrams.

All bigrams have one global order, rare ones first, equal ones from left to right. The prefix of a word are its three
first bigrams in that order. Two bigrams of the prefix that share no character are its pivots: a dynamic programme takes
the pair that is rarest in sum. One edit spoils one pivot at most, so of two words one edit apart the one whose prefix
ends first has a pivot in the prefix of the other. An edit makes or spoils two bigrams at most, so a pivot, one of the
three first of its kind, is one of the five first there: the prefix that is indexed holds these too.

Pivots stand where they stood: if the edit lies right of the left pivot, both words begin alike up to its end, and
if it lies left of the right pivot, they end alike from its start. A posting is therefore kept under that whole
beginning or ending, which is a tighter position limit than an offset. Where many words share one, its postings are
dealt on by what is left of them after each possible deletion. Words that meet are verified.

Joins are hinted as merge joins: Spark sizes postings as the words they come from, exploded rows as one row and a written
table by its compressed files, each far too low, and would broadcast what does not fit into the driver.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Table, materialize
from .text import chunks

LEAST_LENGTH, LEAST_COUNT = 5, 3
DAMAGE = 97  # one word of so many loses a code point
CROWDED = 24  # postings of one beginning or ending that are still paired directly
STRETCH = 1 << 20  # code points of a text that are cut into words at a time
HELD = 1 << 17  # distinct words a task holds before it hands them on
#: The letters of a word: ASCII in lower case after folding, and U+00C0 to U+00FF as they are.
_WORD = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_OTHER = re.compile("[^a-zÀ-ÿ]")


def _fold(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes fold A-Z only


def words_of(text: str) -> Iterator[str]:
    """The folded runs of letters of at least ``LEAST_LENGTH`` code points."""
    text, at = _fold(text), 0
    while at < len(text):
        cut = _OTHER.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield from _WORD.findall(text, at, end)
        at = end


def damaged(word: str, seed: int) -> str:
    """The word as it is counted: its checksum, continued from that of the document, may cost it one code point."""
    h = zlib.crc32(word.encode(), seed)
    if h % DAMAGE:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def out():
        return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            if not text:
                continue
            name = ids[i].as_py()
            seed = zlib.crc32(f"{'' if name is None else name}:".encode())
            for word, n in Counter(words_of(text)).items():
                kept = damaged(word, seed)
                if len(kept) >= LEAST_LENGTH:
                    total[kept] += n
            if len(total) > HELD:
                yield out()
                total.clear()
    if total:
        yield out()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n of every word with at least ``LEAST_COUNT`` occurrences in ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for w in batch.column("word").to_pylist():
            seen.update(map("".join, zip(w, w[1:], strict=False)))
    yield pa.RecordBatch.from_pydict({"gram": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """Occurrences of every bigram in the distinct words. Words have 90 letters, so there are at most 8100 bigrams."""
    rows = words.select("word").mapInArrow(_bigrams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in rows.collect()}


def prefix_grams(word: str, rank: dict[str, int]) -> tuple[list[int], list[int], int]:
    """Starts of the three bigrams of the prefix and of those that are indexed, both ascending, and the last one's rank."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    first = heapq.nsmallest(3, range(len(ranks)), key=lambda i: (ranks[i], i))
    last = ranks[first[2]]
    same = islice((i for i, r in enumerate(ranks) if r == last), 5)
    return sorted(first), sorted({*first, *same}), last


def pivots(word: str, starts: list[int], count: dict[str, int]) -> tuple[int, int]:
    """Starts of the two disjoint bigrams of the prefix with the least sum of counts; the first of equal ones.

    ``best`` is the least (count, start) of a bigram that ends before the present one: one pass is the whole table.
    """
    best = pair = None
    waiting: list[tuple[int, int]] = []
    for i in starts:
        while waiting and waiting[0][1] + 2 <= i:
            first = waiting.pop(0)
            best = first if best is None else min(best, first)
        cost = count[word[i:i + 2]]
        if best is not None and (pair is None or best[0] + cost < pair[0]):
            pair = (best[0] + cost, best[1], i)
        waiting.append((cost, i))
    return pair[1], pair[2]


def _postings(shared):
    """Per word its two pivots and its prefix, each under the beginning or ending that the two words must share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        rank = {g: k for k, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
        for batch in batches:
            for b in chunks([batch], "word", 1 << 18):
                at, part, left, pivot, last = [], [], [], [], []
                for row, w in enumerate(b.column("word").to_pylist()):
                    starts, indexed, end = prefix_grams(w, rank)
                    p, q = pivots(w, starts, count)
                    found = [(True, True, p), (True, False, q)] + [(False, side, i) for i in indexed for side in (True, False)]
                    for is_pivot, begins, i in found:
                        at.append(row)
                        part.append(w[:i + 2] if begins else w[i:])
                        left.append(begins)
                        pivot.append(is_pivot)
                        last.append(end)
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "word": b.column("word").take(rows), "n": b.column("n").take(rows), "part": pa.array(part, pa.string()),
                    "begins": pa.array(left, pa.bool_()), "is_pivot": pa.array(pivot, pa.bool_()), "last": pa.array(last, pa.int32())})
    return run


def _meet(posts: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs one edit apart among pivots and prefixes under one key, smaller word first; a pair may come more than once."""
    pivot = posts.where("is_pivot").select(*keys, F.col("word").alias("x"), F.col("n").alias("n_x"), F.col("last").alias("last_x"))
    prefix = posts.where("NOT is_pivot").select(*keys, F.col("word").alias("y"), F.col("n").alias("n_y"), F.col("last").alias("last_y"))
    close = "last_x <= last_y AND abs(length(x) - length(y)) <= 1 AND levenshtein(x, y, 1) = 1"
    first = F.col("x") < F.col("y")
    return (pivot.join(prefix.hint("merge"), keys).where("x != y").where(close)
            .select(*[F.when(first, F.col(f"{a}x")).otherwise(F.col(f"{a}y")).alias(f"{a}a") for a in ("", "n_")],
                    *[F.when(first, F.col(f"{a}y")).otherwise(F.col(f"{a}x")).alias(f"{a}b") for a in ("", "n_")]))


def near_words(words: DataFrame) -> DataFrame:
    """a, b, n_a, n_b of every pair of ``words`` (word, n; distinct) that is one edit apart, once, with a < b."""
    shared = words.sparkSession.sparkContext.broadcast(bigram_counts(words))
    posts = words.select("word", "n").mapInArrow(_postings(shared), "word string, n long, part string, begins boolean, is_pivot boolean, last int")
    posts = posts.withColumn("key", F.xxhash64("part", "begins"))
    size = posts.groupBy("key").agg(F.count_if("is_pivot").alias("asks"), F.count_if(~F.col("is_pivot")).alias("size")).where("asks > 0 AND size > 1").drop("asks")
    posts = materialize(posts.join(size.hint("merge"), "key").withColumn("crowded", F.col("size") > CROWDED).drop("size"))
    few = _meet(posts.where("NOT crowded").drop("part", "begins"), ["key"])
    # what follows the shared part, whole and with each code point left out: one edit apart, two words share one of these
    rest = F.when(F.col("begins"), F.expr("substr(word, length(part) + 1)")).otherwise(F.expr("substr(word, 1, length(word) - length(part))"))
    # position length + 1 leaves the rest whole
    cuts = F.expr("array_distinct(transform(sequence(1, length(rest) + 1), i -> xxhash64(key, concat(substr(rest, 1, i - 1), substr(rest, i + 1)))))")
    many = posts.where("crowded").withColumn("rest", rest).withColumn("cut", F.explode(cuts)).drop("part", "begins", "rest", "key")
    return few.unionByName(_meet(many, ["cut"])).distinct()


def variants(words: DataFrame) -> DataFrame:
    """word, n, form, form_n, n_near and root of every row of ``words`` (word, n; distinct).

    The form is the near word of largest n (of equals the smallest in code-point order) if that is at least twice the
    word's own; the root is where forms lead, the word itself without one. Each step at least doubles n, so a chain is no
    longer than the binary logarithm of the largest n, and following it in doubled steps takes the logarithm of that.
    """
    pairs = near_words(words)
    each = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n_near")))
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("m"), "near")).alias("best"))
    bigger = -F.col("best.m") >= 2 * F.col("n")
    rows = materialize(words.select("word", "n").join(best.hint("merge"), "word", "left").select(
        "word", "n", F.when(bigger, F.col("best.near")).alias("form"), F.when(bigger, -F.col("best.m")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near")))
    step = Table(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), n=F.count(F.lit(1)))
    moved = step.metrics["n"]
    while moved:
        ahead = step.df.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = Table(step.df.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      moved=F.count_if("moved"))
        step.drop()
        step, moved = after, after.metrics["moved"]
    return rows.join(step.df.select("word", "root").hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, form, form_n, n_near and root of every word of ``docs`` (doc_id, text).

    Words are runs of ASCII letters and U+00C0 to U+00FF, of which only A-Z is folded; where the checksum of doc_id,
    colon and run is a multiple of ``DAMAGE``, the run loses a code point first. Null and empty texts have no words, a
    null doc_id is written as nothing, repeated rows count as often as they stand there. Other columns are ignored; no
    rows give no rows. 64-bit hashes bring words together, whole words decide.
    """
    return variants(materialize(count_words(docs)))
