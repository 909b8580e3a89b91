"""Queries of the operators, each over its whole table with the parameters meant for use."""

from pyspark.sql import functions as F

from rateflow.llm import alignment, decontamination, embeddings, jaccard, licenses, manifest, passages, pii, secret_scan, segmentation, shards, suffixes, toxicity
from rateflow.llm.oracle import ORACLE
from rateflow.session import fresh_dir

__all__ = ["ORACLE", "QUERIES"]

# Where the public vocabularies lie; a parameter of the operators.
TOKENIZERS = "/opt/tokenizers"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return pii.detect(documents, pii.train(documents))


def op2_toxicity(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    trained = toxicity.train(documents, table(spark, d, "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return toxicity.score(documents, trained).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op3_sentencepiece(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    encoded = segmentation.encode(documents, PIECES)
    decoded = segmentation.decode(encoded, PIECES)
    return decoded.select(
        "doc_id",
        "sample",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob",
        "inclusion",
        (F.xxhash64("decoded") == F.col("text_hash")).alias("exact"),
    )


def op4_training_order(spark, d):
    return shards.write_shards(table(spark, d, "documents"), fresh_dir(spark, "shards"), RANKS, key=20_240_501)


def op5_embedding_near_dedup(spark, d):
    return embeddings.near_duplicates(table(spark, d, "embeddings"))


def op6_decontamination(spark, d):
    return decontamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op7_license_scan(spark, d):
    return licenses.find_licenses(table(spark, d, "documents").select("doc_id", "text"))


def op8_secret_scan(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return secret_scan.detect(documents, secret_scan.train(documents))


def op9_ngram_jaccard_join(spark, d):
    return jaccard.jaccard_components(table(spark, d, "documents"))


def op10_substring_dedup(spark, d):
    return passages.remove_repeats(table(spark, d, "documents")).drop("kept_text")


def op11_token_alignment(spark, d):
    documents = table(spark, d, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = alignment.align(documents, BYTE_BPE, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


def op12_merkle_manifest(spark, d):
    return manifest.manifest_check(table(spark, d, "documents"))


def op13_suffix_array_dedup(spark, d):
    left = suffixes.remove_repeats(table(spark, d, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_training_order": op4_training_order,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}
