"""Corpus pipeline: five stages over ``documents``, each one of the corpus
operators, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.llm.common import stash
from tagsmith.llm.decontam import drop_contaminated
from tagsmith.llm.packing import pack
from tagsmith.llm.quality_qda import keep_quality
from tagsmith.llm.simhash_cover import keep_one
from tagsmith.llm.surrogates import pseudonymise
from tagsmith.llm.tokens import vocabulary_path

PII_KEY = b"corpus pipeline"  # a real run passes a secret of its own


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more).
    Null and empty texts have a score like any other text; repeated rows stay
    or go together; an empty table gives none.  Extra columns are kept."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by at most 4 fingerprint bits.  Texts
    without words (null, empty) are one group; repeated rows stay once; a null
    id stays only if its group has no other.  Extra columns are kept."""
    return keep_one(docs, width=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item.  Null and
    empty texts are clean; an empty benchmark drops nothing.  Extra columns are
    kept, those named like a mark of the operator too."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the new text
    (null for a null one).  Repeated rows get the same replacements."""
    out = pseudonymise(docs, PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed 4096-token sequences.  A null or empty text is
    its end token alone; an empty table gives no pieces."""
    return pack(docs, vocabulary_path(), end_id=2, unit=64).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("surrogates", surrogates), ("packing", packing)]
ORACLE_SQL = None  # the classifier, fingerprints, surrogates and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
