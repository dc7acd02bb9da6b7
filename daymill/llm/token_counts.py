"""Token counts through a cache of content digests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

import pyarrow as pa

from daymill import workspace
from daymill.llm.chunks import ChunkEncoder
from daymill.llm.common import bound_batches, gathered

CACHE = StructType([StructField("digest", StringType()), StructField("version", StringType()), StructField("n_tokens", LongType())])


def digest(text: Column) -> Column:
    """Digest of a content; the counts depend on every byte, so nothing is normalised but null, which is empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def tokenizer_version(spark, path: str) -> str:
    """Digest of the tokenizer file: a changed file makes other cache entries."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts, one for each digest and version; an absent cache is empty."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, *, blanks_lead: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` ids with n_bytes and n_tokens of the whole text, as the tokenizers library counts without added ids.

    Digests of contents and of the tokenizer file are looked up in the cache at `cache_path`; of each content that
    is missing one row is encoded, and its count is appended (a second run encodes nothing). Only the smallest
    (partition, row) mark of a digest is aggregated, combined in the tasks before the shuffle, and the last join
    carries no text, so a content that fills a third of the rows is split by the adaptive planner like any large
    partition. Null is empty: 0 bytes, 0 tokens. Ids may repeat or be null. Writers of one cache take turns.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    version = tokenizer_version(spark, tokenizer_path)
    known = read_cache(spark, cache_path).filter(F.col("version") == version).select("digest", "n_tokens")
    known = known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    plain = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", digest(F.col("text")))
    keys = workspace.materialize(
        plain.select(id_col, "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests"
    )
    # One row of each content that the cache lacks: texts are dealt out by digest once, and the first of each is kept.
    misses = keys.select("digest").distinct().join(known, "digest", "left_anti")
    chosen = (
        keys.groupBy("digest").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col))).alias("at"))
        .join(misses, "digest", "left_semi").select("digest", F.col(f"at.{id_col}").alias("at"))
    )
    texts = plain.alias("d").join(
        chosen.alias("c"), F.col(f"d.{id_col}").eqNullSafe(F.col("c.at")) & (F.col("d.digest") == F.col("c.digest")), "left_semi"
    )
    encoded = texts.select("digest", "text").mapInArrow(_encoder(tokenizer_path, blanks_lead, version), CACHE)
    encoded.groupBy("digest", "version").agg(F.max("n_tokens").alias("n_tokens")).write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path).filter(F.col("version") == version)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keys.join(counts, "digest").select(id_col, "n_bytes", "n_tokens")


def _encoder(path: str, blanks_lead: bool, version: str):
    def run(batches):
        encoder, met = ChunkEncoder(path, blanks_lead), set()
        for held in gathered(batches):
            # Repeated rows of one id, where they come to one task; those of several are one entry all the same.
            digests = held.column("digest").to_pylist()
            fresh = [i for i, d in enumerate(digests) if d not in met and not met.add(d)]
            held = held.take(fresh)
            counts = encoder.counts(held.column("text"))
            digests = held.column("digest").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [digests, pa.array([version] * len(digests), pa.string()), pa.array(counts, pa.int64())], names=CACHE.names
            )

    return run
