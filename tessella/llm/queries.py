"""The registered queries over the given tables; ORACLES holds the SQL that must give the same rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, edit_counts, embedding_dups, infill, language, lm_score, near_duplicates, nearest, packing, quality, spelling, token_files, transcripts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column of little-endian ids by its unsigned crc32."""
    for b in batches:
        crc = pa.array([zlib.crc32(x.as_buffer()) for x in b.column("ids")], pa.int64())
        keep = [c for c in b.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), crc], [*keep, "ids_crc32"])


@query("op3_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(items, 256).alias("items_sha256"),
                        decontaminate.is_contaminated().alias("contaminated"))


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    digest = "doc_id long, piece int, start long, length long, part int, nth long, ids_crc32 long"
    return packing.pack_documents(table(spark, sf_dir, "documents"), carry=lambda p: p.mapInArrow(crc_of_ids, digest))


@query("op8_ngram_join")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its near-duplicate component."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_token_files")
def token_file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    return token_files.write_and_read(table(spark, sf_dir, "documents"), then=crc_of_ids, schema="ids_crc32 long")


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language.held_out().alias("held_out"))
    model = language.train(docs.where("NOT held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query("op4_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"))).select("doc_id", "quality", "toxic", "keep")


@query("op2_nearest")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector, among all."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op1_pseudo_likelihood")
def pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked pseudo-likelihood of every document under a network trained on all of them."""
    return lm_score.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query("op6_edit_counts")
def edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after personal data in it are replaced."""
    return edit_counts.count_edited(edit_counts.with_redactions(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


@query("op7_chat_format")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its recovered role and its canonical rendering; a quarter of the conversations teaches nothing."""
    fold = language.held_out("conv_id")
    found = transcripts.format_chats(table(spark, sf_dir, "conversations"), ~fold)
    return found.select("conv_id", "turn", "line", language.held_out("conv_id").alias("held_out"), "role_pred", (F.col("role") == F.col("role_pred")).alias("right"), "rendered")


# The checksum goes byte by byte through the 256 remainders of its polynomial, which a list comprehension works out.
_SPELLING = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY 1, 2),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(bytes)), lambda i: ('0x' || substr(hexed, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295::BIGINT) AS h
  FROM (SELECT run, n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hexed FROM runs
        WHERE length(run) >= 5), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS cut
  FROM words, unnest(range(1, length(word) + 2)) u(k)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS n_other FROM cuts a JOIN cuts b USING (cut)
  WHERE a.word <> b.word AND (a.k = b.k AND length(a.word) = length(b.word) OR a.cut = b.word OR b.cut = a.word)),
best AS (SELECT word, count(*) AS n_near, min(ROW(-n_other, encode(other), other)) AS top FROM near GROUP BY 1),
formed AS (
  SELECT word, n, CASE WHEN -top[1] >= 2 * n THEN top[3] END AS form, CASE WHEN -top[1] >= 2 * n THEN -top[1] END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words LEFT JOIN best USING (word)),
led AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT l.word, f.word, f.form FROM led l JOIN formed f ON l.next = f.word)
SELECT f.word, f.n, f.form, f.form_n::BIGINT AS form_n, f.n_near, l.root FROM formed f JOIN led l ON l.word = f.word WHERE l.next IS NULL
"""


@query("op11_spelling_variants", _SPELLING)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its near words, its form and its root."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


_INFILL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS d FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || d[9:16])::BIGINT % (len(u) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || d[17:24])::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || d[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
cut AS (
  SELECT *, array_to_string(u[:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM cut
"""


@query("op12_fill_in_middle", _INFILL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two unit boundaries and put in another order, and what is restored from that."""
    found = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(infill.restored(), 256).alias("restored_sha256"))


_EMBEDDING = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reached AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
component AS (SELECT x AS vec_id, min(y) AS component_id FROM reached GROUP BY 1)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE x = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component USING (vec_id)
"""


@query("op13_embedding_dups", _EMBEDDING)
def embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links inside its label and its component."""
    return embedding_dups.near_vectors(table(spark, sf_dir, "embeddings"))
