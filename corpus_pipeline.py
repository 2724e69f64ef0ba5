"""From raw documents to packed training sequences: classify, deduplicate, decontaminate, redact, pack.

Every stage takes the documents its predecessor kept and returns documents with the same columns; the last
returns the pieces of the packed sequences. Null and empty texts: the classifier rejects them, the other stages
pass them through. Repeated rows of an id stay until the near-duplicate stage, which keeps one of each group of
near duplicates; different texts of one id are documents of their own there. Rows without an
id are never duplicates of anything. Empty tables give empty results. Further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapgrid.llm import near_dedup, ordinal_quality, secret_crf, window_packing, wu_manber
from snapgrid.llm.frames import fresh_name, sized_join
from snapgrid.session import materialize, ship_package

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than poor or toxic; fitted on the rated ones among them."""
    ship_package(spark)
    model = ordinal_quality.train(docs, ordinal_quality.rated(_table(spark, sf_dir, "labels")))
    return ordinal_quality.kept(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (word shingles of five, similarity of 0.8 or more)."""
    ship_package(spark)
    # Different texts of one id are documents of their own here: each has its own place.
    digest = F.xxhash64("text")
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    mixed = materialize(texts.where("low <> high").select(F.col("doc_id").alias("mixed_id")), "pipeline-mixed")
    columns, place = docs.columns, fresh_name("place", docs.columns)
    placed = docs.withColumn(place, F.col("doc_id").cast("long"))
    if not mixed.isEmpty():
        ids = mixed.select(F.col("mixed_id").alias("doc_id"), F.lit(True).alias(flag := fresh_name("mixed", [*columns, place])))
        own = F.when(F.col(f"`{flag}`"), F.xxhash64("doc_id", "text")).otherwise(F.col(f"`{place}`"))
        placed = sized_join(placed, ids, "doc_id", "left").withColumn(place, own).select(*[f"`{c}`" for c in columns], f"`{place}`")
    found = near_dedup.near_duplicates(placed, near_dedup.Settings(percent=80), doc_id=place)
    found = materialize(found.withColumnRenamed("doc_id", place), "pipeline-components")
    dropped = materialize(found.where("not kept").select(place).distinct(), "pipeline-dropped")
    stays = sized_join(placed, dropped, place, "left_anti")
    repeated = found.where(F.col(place).isNotNull()).groupBy(place).agg(F.count("*").alias("n")).where("n > 1")
    repeated = materialize(repeated.select(place), "pipeline-repeated")
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    one = sized_join(stays, repeated, place, "left_semi")
    one = one.select(F.col(place).alias("place"), "text", row.alias("row")).groupBy("place")
    one = one.agg(F.min_by("row", F.coalesce("text", F.lit(""))).alias("row"))
    unique = sized_join(stays, repeated, place, "left_anti")
    return unique.select(*[F.col(f"`{c}`") for c in columns]).unionAll(one.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    ship_package(spark)
    return wu_manber.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    ship_package(spark)
    clean = secret_crf.redacted(docs, secret_crf.train(docs))
    if "n_chars" in docs.columns:
        length = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars").cast("long"))
        clean = clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    import public_tokenizers

    ship_package(spark)
    return window_packing.packed(docs, window_packing.Settings(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL has no tokenizer, trained model or component search; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    rows = _table(ship_package(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if i + 1 < len(STAGES):
            rows = materialize(rows, f"pipeline-{name}")
    return rows
