"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (ann, decontaminate, encode, langid, merkle, ngram_lm, packing, repair, repeats, secret_ledger, shards,
                         simhash, token_files, toxicity)
from tessera.llm.common import table

BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 2
WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 0


def _path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_encoder(path: str | None = None):
    """A maker of encoders (one per worker) for the byte-level vocabulary."""
    path = path or _path(BYTE_VOCABULARY)
    return lambda: encode.of_worker(("byte", path), lambda: encode.byte_level_encoder(path, special_tokens=True))


def word_encoder(path: str | None = None):
    """A maker of encoders (one per worker) for the lower-case word vocabulary."""
    path = path or _path(WORD_VOCABULARY)
    return lambda: encode.of_worker(("word", path), lambda: encode.lower_word_encoder(path, special_tokens=True))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: fingerprints of 3-word shingles, links at 3 or fewer bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    return shards.shard(table(spark, sf_dir, "documents"))


def op4_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff trigram score of every document, by all counts of all documents; every 20th document also by the counts
    of the others, where its n-grams back off."""
    return ngram_lm.score(table(spark, sf_dir, "documents"), order=3, least=1, held_out=F.col("doc_id") % 20 == 0)


def op5_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest vectors (largest inner product) of every 20th vector."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the toxicity categories of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned once per distinct content."""
    return secret_ledger.digest(table(spark, sf_dir, "documents"))


def op8_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold which benchmark items, up to 6 edits per 100 characters."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to seekable zstandard files and read back."""
    return token_files.token_spans(table(spark, sf_dir, "documents"), byte_encoder(), BYTE_END)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), word_encoder(), WORD_END)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents; every row folded up from its leaf, one in five after tampering."""
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


def op12_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 13 words and more that a document with a smaller doc_id has."""
    return repeats.drop_copied(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return repair.damaged_audit(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_langid, op3_sharding, op4_backoff_lm, op5_multiprobe_ann, op6_toxicity_chain,
                                   op7_secret_ledger, op8_pigeonhole, op9_token_files, op10_best_fit, op11_merkle_manifest,
                                   op12_repeated_spans, op13_conversation_repair)}
ORACLES: dict[str, str] = {}
