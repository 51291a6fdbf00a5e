"""From raw documents to token ids, in stages that each call one operator.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.
All but the last return the columns of ``docs``; ``run`` writes each result as Parquet and
reads it again for the next. Nulls, empty tables and repeated rows are treated as the
operators define it.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm import byte_bpe, mixing, secrets, setsketch, toxicity
from tracklens.llm.storage import importable, stored

REPETITION = 1.25  # no source is gone through more often; each is at least once


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below a half. Labels of every fifth hash stay unseen."""
    importable(spark)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=~held_out)
    return docs.filter(toxicity.scorer(docs, model)("text") < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8, the one of the smallest doc_id."""
    importable(spark)
    groups = setsketch.near_duplicates(docs, shingle=5, percent=80)
    gone = groups.filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    packed = docs.select("text", F.struct(*docs.columns).alias("row"))
    found = secrets.scan(packed, secrets.train(secrets.labelled_findings(docs)))

    def column(name):
        if name == "text":
            return F.col("redacted").alias(name)
        old = F.col("row").getField(name)
        if name == "n_chars":
            old = F.when(F.col("n_secrets") > 0, F.char_length("redacted")).otherwise(old)
        return old.cast(docs.schema[name].dataType).alias(name)

    return found.select(*map(column, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture has them: small sources are repeated within the limit."""
    return mixing.mixed(docs, repetition=REPETITION).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and digests of them and of what they decode to."""
    importable(spark)
    found = byte_bpe.tokens(docs, decode=True, path=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            pattern=public_tokenizers.PATTERN)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encode", encode),
]

# Trained models decide in two stages; tests/llm/test_queries.py holds the whole run against its stages,
# toxicity, near duplicates and encoding in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
