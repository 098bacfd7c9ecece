"""From raw documents to token ids, in five stages of the corpus operators.

Every stage takes what its predecessor kept, written as Parquet and read again,
and decides on all of it: documents of low quality go, one document of each group
of near duplicates stays, secrets are masked, documents are repeated or left out so
that the languages reach their target weights, and what is left is encoded. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trip_marts.llm import bpe, minhash, mixing, quality, secret_scan
from trip_marts.llm.shared import drop_saved, shared_root, ship, table

#: What the stages keep and return; other columns of the input end here.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more, by a classifier trained on `docs`.

    A null or empty text has the score that the model gives to no features.
    """
    ship(spark)
    docs = docs.select(COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by 0.8 on five words.

    Null and blank texts are in no group and all stay, repeated rows once.
    """
    ship(spark)
    return minhash.without_duplicates(docs.select(COLUMNS), 5, 80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and `n_chars` counted anew there."""
    ship(spark)
    return secret_scan.redact(docs.select(COLUMNS))


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate asks for; texts without tokens stay once."""
    ship(spark)
    return mixing.mixed(docs.select(COLUMNS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `ids` and `n_tokens` of every row; `bpe.decode` gives the texts back."""
    ship(spark)
    return bpe.encode(docs.select(COLUMNS), bpe.default_ranks())


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", near_deduplicated),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed_to_weights),
    ("byte-level BPE encoding and decoding", encoded),
]

#: SQL can't express the trained models and the sketches; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written below the shared folder.

    A stage's result is deleted when the next one is written; the last one stays.
    """
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/stage-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if number:
            drop_saved(docs)
        docs = spark.read.parquet(path)
    return docs
