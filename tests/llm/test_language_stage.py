import corpus_pipeline as cp
from pyspark.sql import functions as F

from wardflow.llm import langid


def test_labelled_documents_stay(spark):
    """Every labelled document with a letter, those of one word included."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lettered = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(langid.LETTER.pattern))
    gone = lettered.join(cp.language_id(spark, docs, ""), "doc_id", "left_anti").select("doc_id", "text")
    assert lettered.where(F.size(F.split("text", " ")) < 8).count() > 50
    assert gone.collect() == []


def test_threshold_follows_the_languages():
    for n in range(1, 100):
        assert cp.least_score(n) <= 0.4 and cp.least_score(n) <= 1.25 / n
        assert n <= 3 or cp.least_score(n) > 1 / n
