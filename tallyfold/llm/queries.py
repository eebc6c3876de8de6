"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    bpe, hnsw, jaccard, language, lm, merkle, packing, quality, repeats, rules, sharding, urls,
    whitening,
)
from tallyfold.llm.common import lower_ascii, table


def vocabulary_path() -> str:
    """The public byte-level vocabulary that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed values of the contract: verdicts by host and path.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged = urls.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its links at a similarity of 0.9."""
    return jaccard.join(table(spark, sf_dir, "documents"), words=3, p=90, q=100)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Every document as pieces of packed sequences, their ids as checksums."""
    packed = packing.pack(docs, vocabulary_path(), end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of packed sequences."""
    return packed_pieces(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and position, sizes near equal."""
    placed, _ = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and attention-model score of every document."""
    return lm.score(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and verdict of every document, false rejections held under a proven limit."""
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.concat_ws(",", "failed").alias("failed_rules"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of every document's ids and of the text decoded from them."""
    path = vocabulary_path()
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def verified_leaves(docs: DataFrame) -> DataFrame:
    """Every document's proof, with the texts of a fifth of them lower-cased after the build."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    now = F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    checked = merkle.verify(docs, "doc_id", "source", fields, {"text": now})
    return checked.withColumnRenamed("id", "doc_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and folded root of every document."""
    return verified_leaves(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its strings of 400 bytes that occur again."""
    stripped = repeats.strip(table(spark, sf_dir, "documents"), length=400)
    return stripped.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


QUERIES = {
    "op1_url_filter": (op1_url_filter, None),
    "op2_jaccard_join": (op2_jaccard_join, None),
    "op3_packing": (op3_packing, None),
    "op4_language_id": (op4_language_id, None),
    "op5_sharding": (op5_sharding, None),
    "op6_lm_scoring": (op6_lm_scoring, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op8_bpe": (op8_bpe, None),
    "op9_hnsw": (op9_hnsw, None),
    "op10_quality": (op10_quality, None),
    "op11_merkle_manifest": (op11_merkle_manifest, None),
    "op12_embedding_whitening": (op12_embedding_whitening, None),
    "op13_suffix_dedup": (op13_suffix_dedup, None),
}
