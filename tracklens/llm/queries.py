"""The subpackage's queries over the driver's tables; results as their contracts fix them."""

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm import (
    alignment, byte_bpe, forest, huffman, licences, mixing, multi_index, part_codes, quality, secrets, setsketch,
    substrings, toxicity,
)
from tracklens.llm.storage import importable
from tracklens.session import checkpoint_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return function(spark, folder)

    _QUERIES[function.__name__] = run
    return run


def _held_out():
    """Rows that nothing is learnt from; a null doc_id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def statements() -> dict[str, str]:
    """SQL counterparts, where SQL can tell a result whole; tests hold the others against brute force."""
    return {"op11_vector_codes": part_codes.statement()}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op5_minhash_near_dedup(spark, folder):
    return setsketch.near_duplicates(_table(spark, folder, "documents"), shingle=2, percent=80)


@_query
def op6_substring_dedup(spark, folder):
    return substrings.without_repeats(_table(spark, folder, "documents"), length=50).drop("kept_text")


@_query
def op1_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    held_out = _held_out()
    model = toxicity.fit(docs, _table(spark, folder, "labels"), learn=~held_out)
    return toxicity.scored(docs.select("doc_id", "text"), model, score_col="score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op3_embedding_near_dedup(spark, folder):
    return multi_index.near_duplicates(_table(spark, folder, "embeddings"), cosine=0.9)


@_query
def op7_nearest_neighbours(spark, folder):
    rows = _table(spark, folder, "embeddings")
    return forest.search(rows, rows.filter("vec_id % 100 = 0"), k=10)


@_query
def op2_license_scan(spark, folder):
    found = licences.scan(_table(spark, folder, "documents"))
    base = F.transform("phrases", lambda x: x.label)
    every = F.concat(base, F.transform("spans", lambda x: x.label))
    first = F.transform("phrases", lambda x: x.first)

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    covered = F.array_max(F.transform("spans", lambda x: F.least(x.covered, F.lit(1.0))))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        joined(base).alias("base_labels"), joined(every).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(covered, F.lit(0.0))).alias("score"))


@_query
def op4_token_id_output(spark, folder):
    path = f"{checkpoint_folder(spark)}/token-ids-{uuid4().hex}"
    huffman.write_ids(_table(spark, folder, "documents"), path,
                      tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return huffman.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op10_byte_level_bpe(spark, folder):
    found = byte_bpe.tokens(_table(spark, folder, "documents"), decode=True,
                            path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            pattern=public_tokenizers.PATTERN)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op8_secret_scan(spark, folder):
    found = secrets.without_secrets(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("findings").alias("n_candidates"), "n_secrets",
                        F.transform("findings", lambda f: f.score).alias("scores"),
                        F.sha2(F.coalesce("redacted", F.lit("")).cast("binary"), 256).alias("redacted_sha256"))


@_query
def op9_source_mixing(spark, folder):
    docs = _table(spark, folder, "documents")
    return mixing.mixed(docs.select("doc_id", "text", "source"), repetition=1.25).drop("text")


@_query
def op11_vector_codes(spark, folder):
    return part_codes.compressed(_table(spark, folder, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


@_query
def op12_quality(spark, folder):
    docs = _table(spark, folder, "documents")
    held_out = _held_out()
    model = quality.fit(docs, _table(spark, folder, "labels"), metadata=["n_chars"], learn=~held_out)
    return quality.scored(docs, model, metadata=["n_chars"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op13_tokenizer_alignment(spark, folder):
    return alignment.align(_table(spark, folder, "documents"), path_a=public_tokenizers.path("byte_bpe_50k.json"),
                           path_b=public_tokenizers.path("piece_bpe_32k.model"), pattern=public_tokenizers.PATTERN)
