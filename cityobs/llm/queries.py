"""One query for each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityobs.llm import bpe, cpsjoin, decontaminate, imatch, importance, lattice, lines, packing, pii, quality, ranked, sharding, toxicity, training
from cityobs.llm.oracles import ORACLES
from cityobs.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the bytes that they decode to."""
    path = vocabulary("byte_bpe_50k.json")
    done = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path, offsets=False), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose counts are at most one apart."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def site_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and removed in every document, and the digest of what is left."""
    cleaned = lines.remove_boilerplate(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length("text").cast("long").alias("clean_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("clean_sha256"),
    )


def window_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of base spans, and all spans."""
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [
        F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in pii.KINDS
    ]
    return found.select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_edits(docs, imatch.lexicon(docs))


def lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document; those of remainder 0 are not learned from."""
    remainder = training.fold(F.col("doc_id"), 10)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lattice.score(docs, remainder != 0, vocabulary("piece_bpe_32k.model"))
    return scored.select("doc_id", (remainder == 0).alias("held_out"), *scored.columns[1:])


def chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, at a similarity of 0.85 or more."""
    return cpsjoin.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


def _scores(spark: SparkSession, sf_dir: str, module, label: str, folds: int, left_out: int) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = training.fold(F.col("doc_id"), folds)
    samples = training.sample(docs, _table(spark, sf_dir, "labels"), label, remainder != left_out)
    scored = module.score(docs.select("doc_id", "text"), module.fit(samples), drop_text=True)
    return scored.select(
        "doc_id",
        (remainder == left_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of remainder 1 are never read."""
    return _scores(spark, sf_dir, quality, "quality", 3, 1)


def toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of remainder 0 are never read."""
    return _scores(spark, sf_dir, toxicity, "toxic", 5, 0)


def bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 ids."""
    cut = packing.pieces(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


def importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark, and the place of the 5 % that are drawn."""
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 5)
    return drawn.drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_shards": feistel_shards,
    "op2_imatch_fingerprints": imatch_fingerprints,
    "op3_lattice_likelihood": lattice_likelihood,
    "op4_nb_svm": nb_svm,
    "op5_toxic_segments": toxic_segments,
    "op6_site_spread_lines": site_spread_lines,
    "op7_chosen_path_join": chosen_path_join,
    "op8_byte_bpe": byte_bpe,
    "op9_window_hits": window_hits,
    "op10_bootstrapped_pii": bootstrapped_pii,
    "op11_bin_completion": bin_completion,
    "op12_hybrid_search": hybrid_search,
    "op13_importance_resampling": importance_draw,
}

__all__ = ["ORACLES", "QUERIES"]
