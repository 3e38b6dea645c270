"""From raw documents to packed training sequences: each stage works on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, language, packing, quality
from tessella.llm.near_duplicates import near_duplicates, row_ids, several_texts
from tessella.llm.queries import crc_of_ids
from tessella.session import materialize

BATCH_ROWS = 1000  # whole documents that Spark hands to a Python worker at a time; its own default is ten times as many
MIN_LANGUAGE_SCORE = 0.3  # below what any of four equally likely languages would get by a clear margin
ORACLE_SQL = None  # trained models and tokenizers are not SQL; tests hold the stages against brute force


def _apart(docs: DataFrame, needed: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """The columns that stages read, and all others inside one, so that no name of a stage's own meets a user's."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))  # for the session: stages run later than they are declared
    others = [c for c in docs.columns if c not in needed]
    return docs.select(*[c for c in docs.columns if c in needed], F.struct(*(others or [F.lit(0)])).alias("_others"))


def _together(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[c if c in found.columns else F.col(f"_others.{c}").alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose language stays unclear."""
    found = language.identify(_apart(docs), language.train(docs.select("doc_id", "text", "lang")))
    return _together(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).drop("lang_pred", "score"), docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of low quality and toxic ones."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _together(quality.score(_apart(docs), model).where("keep").drop("quality", "toxic", "keep"), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of every near-duplicate group (rows without doc_id stand behind all others).

    Rows are told apart by doc_id and text together: different texts under one doc_id are different documents, and
    of equal rows the smallest stays.
    """
    named = _apart(docs)
    named = row_ids(named, several_texts(named)).drop("_several")
    groups = near_duplicates(named.select(F.col("_id").alias("doc_id"), "text")).distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_id")
    member = named.select("_id", "doc_id").distinct().join(groups.select(F.col("doc_id").alias("_id"), "component_id"), "_id")
    stay = member.groupBy("component_id").agg(F.min_by("_id", order).alias("_id")).select("_id")
    rows = named.join(stay, "_id", "left_semi")
    others = [c for c in rows.columns if c != "_id"]
    return _together(rows.groupBy("_id").agg(F.min(F.struct(*others)).alias("_row")).select("_row.*"), docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is benchmark text; all others stay as they are."""
    found = decontaminate.contamination(_apart(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _together(found.where(~decontaminate.is_contaminated()).drop("n_words", "n_hit", "spans", "items"), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    digest = "doc_id long, piece int, start long, length long, part int, nth long, ids_crc32 long"
    return packing.pack_documents(_apart(docs), carry=lambda p: p.mapInArrow(crc_of_ids, digest), release=True)


STAGES = [("language id", known_language), ("quality classifier", good_quality), ("n-gram Jaccard join", one_of_each_group),
          ("benchmark decontamination", uncontaminated), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
