"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import langid, line_dedup, mixing, packing, simhash_dedup
from wardflow.llm.common import packed, unpacked
from wardflow.session import checkpoint_dir

#: Documents whose pooled language probability is lower are no text in a known language;
#: with many languages, those that are hardly over even odds.
MIN_LANGUAGE_SCORE = 0.4
OVER_EVEN_ODDS = 1.25


def least_score(n_langs: int) -> float:
    return min(MIN_LANGUAGE_SCORE, OVER_EVEN_ODDS / max(n_langs, 1))


def _columns(docs: DataFrame, *names: str) -> dict[str, str]:
    """The columns that a stage reads, under their own names; all others
    travel as one struct, whatever they are called."""
    return {n: n for n in names if n in docs.columns}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the labelled ones
    teach, go.  Null texts go; repeated rows share their fate; texts of any
    length are read whole; an empty table stays empty; other columns are
    carried along whatever their names."""
    model = langid.learn_from_open(docs.select("doc_id", "text", "lang"))
    own = _columns(docs, "text")
    known = langid.predict(packed(docs, **own), model, "text")
    known = known.where((F.col("__lang_pred") != langid.UNDETERMINED)
                        & (F.col("__score") >= least_score(len(model.langs) if model else 0)))
    return known.select(*unpacked(known, docs.columns, **own))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages go, and documents of which
    nothing else is left.  ``n_chars`` follows the text where there is one.
    Null texts, empty texts and texts of fewer than three lines stay; rows
    that repeat a document lose the same lines; texts of any length are read
    whole; an empty table stays empty; other columns are carried along
    whatever their names."""
    own = _columns(docs, "doc_id", "text", "n_chars")
    left = line_dedup.without_repeated_lines(packed(docs, **own))
    left = left.where((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("__n_removed") == 0, F.col("n_chars"))
                               .otherwise(F.length("text").cast(kind)))
    return left.select(*unpacked(left, docs.columns, **own))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (3-word shingles, 2
    bits): null and empty texts are one group, a repeated row is a member of
    its group like any other; texts of any length are read whole; an empty
    table stays empty; other columns are carried along whatever their names."""
    own = _columns(docs, "doc_id", "text")
    kept = simhash_dedup.keep_one_per_group(packed(docs, **own), n=3, max_bits=2)
    return kept.select(*unpacked(kept, docs.columns, **own))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, to the sources' target weights.  Null
    and empty texts have no words and count for nothing; a null source is a
    source; rows that repeat a document draw each for itself; texts of any length are
    counted whole; an empty table stays empty; other columns are carried along
    whatever their names."""
    own = _columns(docs, "doc_id", "text", "source")
    mix = mixing.mixed(packed(docs, **own))
    return mix.select(*unpacked(mix, docs.columns, **own))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens;
    ``copy_row`` tells the copies of a document apart.  Null texts are empty,
    an empty text is its end token; texts of any length are cut into pieces;
    an empty table gives no pieces; other columns are not looked at."""
    return packing.pack(docs).withColumnRenamed("__row", "copy_row")


STAGES = [("language ID", language_id), ("line dedup", without_repeated_lines), ("SimHash near-dedup", near_dedup),
          ("mixing to target weights", source_mix), ("best-fit packing", best_fit_packing)]

#: Language ID and packing cannot be written in SQL.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of ``sf_dir``.  A stage's
    output is removed once the next one's is written; the last input stays
    for the result, which is lazy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        if i:
            _remove(spark, f"{base}/{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
