"""The training-data pipeline: language, near duplicates, contamination, secrets, token pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again as the `docs` of the next. All but the last return the columns
of `documents`. Rows are judged as they are: extra columns stay, names that start with `__` are reserved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.llm import decontamination, language_id, lsh_forest, piece_codec, secret_ledger
from candor.llm.common import table
from candor.llm.queries import vocabulary
from candor.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A language with a lower score counts as not recognised.
LEAST_SCORE = 0.2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised: with a letter, and a score of at least LEAST_SCORE. `lang` stays as given."""
    return language_id.keep_known(docs, language_id.train(docs), LEAST_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group (five words, 0.8), once. Rows without an id all stay."""
    return lsh_forest.keep_first(docs, size=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold the question and the answer of a benchmark item."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the text; `n_chars` follows the text. Texts without one are unchanged."""
    masked = secret_ledger.redact(docs, secret_ledger.scan_unseen(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens` and the token `ids` of every document, with the end id; `n_chars` of what they decode to."""
    texts = docs.select("doc_id", "text")
    return piece_codec.encode(texts, vocabulary("piece_bpe_32k.model")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.length("decoded").cast("long").alias("n_chars"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("pieces", to_pieces),
]

#: The classifier of the first stage can't be stated in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
