"""A training-data pipeline: each stage's rows are written and read again as the next one's.

Every stage calls one operator of ``cityobs.llm`` on the documents that its predecessor kept. All
but the last return the columns of documents. Null texts count as empty ones throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityobs.llm import bpe, cpsjoin, decontaminate, lines, quality, training
from cityobs.llm.queries import vocabulary
from cityobs.llm.ship import ship
from cityobs.scratch import materialise


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    It learns from the labels whose fold is not held out. A document goes if its score of being
    good is below one half; an empty text is judged like any other.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    samples = training.sample(docs, labels, "quality", training.fold(F.col("doc_id"), 3) != 1)
    scored = quality.score(docs, quality.fit(samples), into="__quality")
    return scored.where(F.col("__quality") >= 0.5).drop("__quality")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines that other documents keep; those left empty by it go."""
    cleaned = lines.remove_boilerplate(docs)
    kept = cleaned.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*docs.columns)


#: Similarity from which the stage takes two documents for near duplicates, in per cent.
NEAR_PERCENT = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near duplicates."""
    ship(spark)
    gone = cpsjoin.near_duplicates(docs, percent=NEAR_PERCENT).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    marked = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where(F.col("n_hit") == 0).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, and whether they decode to its bytes."""
    ship(spark)
    path = vocabulary("byte_bpe_50k.json")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    plain = docs.withColumn("text_sha256", F.sha2(raw, 256))
    encoded = bpe.encode(plain, path, keep=tuple(c for c in plain.columns if c != "text"), offsets=False)
    decoded = bpe.decode(encoded, path)
    return decoded.withColumn("exact", F.sha2("decoded", 256) == F.col("text_sha256")).drop("decoded", "text_sha256")


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminated", decontaminated),
    ("byte_bpe", byte_bpe),
]

#: The first stage fits a model, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
