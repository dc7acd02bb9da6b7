"""From raw documents to token ids: language filter, exact and near deduplication, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the columns of
`docs`. Stages read the columns doc_id, text, lang and source; other columns, of any name, pass through.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import workspace
from daymill.llm import common, exact_dedup, hyperminhash, language_id, mixing, sentencepiece_dropout


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near some language's centroid. Null texts, texts without a letter and texts far from all
    learned languages go. Learned from the documents' own labels; without any label, every document goes."""
    workspace.use_own_root(spark)
    model = language_id.fit(docs.filter(~common.held_out()))
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return language_id.predict(rows, model).filter("not rejected").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, the one with the largest id."""
    workspace.use_own_root(spark)
    return exact_dedup.ExactDedup(docs).kept()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id. Rows of equal id are one document, and
    rows without id belong to no group."""
    workspace.use_own_root(spark)
    name = common.free_name(docs, "kept_id")
    kept = hyperminhash.NearDuplicates(docs).report().filter("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept.distinct(), F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice; those it does not take go."""
    workspace.use_own_root(spark)
    return mixing.mixed_rows(mixing.mix(docs, common.word_count(F.col("text"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row, whole texts."""
    workspace.use_own_root(spark)
    encoded = sentencepiece_dropout.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), at_once=common.SMALL_BYTES)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language identification", identify_language),
    ("exact deduplication", drop_copies),
    ("near deduplication", drop_near_copies),
    ("source mixing", mix_sources),
    ("sentencepiece encoding", encode),
]
# Language models, sketches and piece segmentation have no SQL form; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next."""
    workspace.use_own_root(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
