"""Registered queries of the training-data operators: each takes (spark, sf_dir) and covers its whole table."""

import string

import public_tokenizers
from pyspark.sql import functions as F

from daymill import workspace
from daymill.llm import chat, common, embedding_dedup, exact_dedup, hard_negatives, huffman, hyperminhash, language_id, merkle, mixing, packing, sampling, sentencepiece_dropout, token_counts, toxicity

QUERIES, ORACLE = {}, {}


def query(function):
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        workspace.use_own_root(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_projection_collisions(spark, sf):
    return embedding_dedup.near_duplicates(common.table(spark, sf, "embeddings"))


@query
def op2_toxicity(spark, sf):
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    labels = labels.filter(~common.held_out()).filter("toxic in (0, 1)").select("doc_id", "toxic")
    model = toxicity.fit(sampling.with_labels(docs.select("doc_id", "text"), labels))
    tested = docs.select("doc_id", "text", common.held_out().alias("held_out"))
    return toxicity.score(tested, model).select("doc_id", "held_out", "score", "predicted")


@query
def op3_sentencepiece_dropout(spark, sf):
    """Ids of every text under one seed, and whether they give the text back."""
    docs, model = common.table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_dropout.encode(docs, model)
    decoded = sentencepiece_dropout.decode(encoded, model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query
def op4_hyperminhash(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return hyperminhash.NearDuplicates(docs).report()


@query
def op5_language_id(spark, sf):
    docs = common.table(spark, sf, "documents")
    model = language_id.fit(docs.filter(~common.held_out()))
    tested = docs.select("doc_id", "text", common.held_out().alias("held_out"))
    return language_id.predict(tested, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


TOKEN_LIMIT = 512


@query
def op6_token_counts(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    cache = workspace.new_path(spark, "token-cache")
    counts = token_counts.count_tokens(docs, cache, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op7_huffman_ids(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    folder = workspace.new_path(spark, "token-files")
    huffman.write_ids(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return huffman.read_ids(spark, folder)


@query
def op8_exact_dedup(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.ExactDedup(docs).report()


ORACLE["op8_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


@query
def op9_chat_snapshots(spark, sf):
    return chat.format_chats(common.table(spark, sf, "conversations"))


ORACLE["op9_chat_snapshots"] = chat.ORACLE


@query
def op10_source_mix(spark, sf):
    docs = common.table(spark, sf, "documents")
    sized = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("words"))
    return mixing.mix(sized, F.col("words")).select("row.doc_id", "size", "source_size", "target", "taken")


ORACLE["op10_source_mix"] = mixing.oracle()


@query
def op11_merkle_proofs(spark, sf):
    docs = common.table(spark, sf, "documents")
    fields = [F.col(c) for c in merkle.FIELDS[:-1]]
    altered = merkle.leaf_digest(*fields, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    proofs = merkle.Manifest(docs, keep={"tampered": F.when(touched, altered)}).proofs()
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE["op11_merkle_proofs"] = merkle.oracle()


@query
def op12_hard_negatives(spark, sf):
    rows = common.table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = rows.filter(F.col("vec_id") % 100 == 0).select("vec_id")
    return hard_negatives.mine(hard_negatives.Vectors(rows, label=label), anchors)


ORACLE["op12_hard_negatives"] = hard_negatives.ORACLE


@query
def op13_best_fit_packing(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    return packing.Packing(docs, public_tokenizers.path("byte_bpe_50k.json")).placements().drop("at")
