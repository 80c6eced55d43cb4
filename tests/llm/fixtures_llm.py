import hashlib

import pytest
from pyspark.sql import SparkSession

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def rows(spark: SparkSession):
    """Small documents with everything awkward: NULLs, empty and long texts, repeated rows and ids, ties, extra columns with names used inside."""
    long_text = " ".join(f"Wort{i % 997}{'.' if i % 13 == 0 else ''}" for i in range(30_000))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "Ein Wort"), (5, "the same text, twice"), (5, "the same text, twice"), (6, "another text for six"),
        (6, "with the id of the one before"), (None, "no id at all"), (None, None), (7, long_text), (8, long_text + " end"), (9, "x" * 20_000), (10, "İ ß \U0001f642 \x00 \x1c ok"),
    ]
    data = [(i, t, "en" if i and i % 2 else None, "src", len(t) if t is not None else None, True, [1], "k", 1.0) for i, t in texts]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, spans array<int>, key string, score double"
    )


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def documents(spark, folder=FOLDER):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
