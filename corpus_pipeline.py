"""A training-data pipeline over documents: five stages, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, packing, quality, suffix_dedup, toxicity
from tessera.llm.shared import Written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on this table's labels, scores as toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays.

    Documents without a word are linked with nothing and stay, as do documents without an id. Of rows
    that repeat an id and all else, one stays; rows with the same id and other texts are documents of
    their own, told apart by their place among the id's texts.
    """
    written = Written(spark)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    rows = docs.select(row.alias("row")).select("row", F.col(f"row.{at['doc_id']}").alias("doc_id"), F.col(f"row.{at['text']}").alias("text"))
    named = rows.filter("doc_id is not null")
    if named.select("doc_id").distinct().count() != named.count():
        # rows are told apart by their JSON, as columns may hold maps, which cannot be compared
        told = named.withColumn("json", F.to_json("row", {"ignoreNullFields": "false"}))
        several = told.dropDuplicates(["doc_id", "json"])
        place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "json"))
        named = written.save(several.select("row", F.struct("doc_id", place.alias("place")).alias("doc_id"), "text"), "named")
    found = jaccard_join.near_duplicates(named, written=written).filter("component_id <> doc_id")
    gone = written.save(found.select(F.col("doc_id").alias("g_id")), "gone")
    # the ids that go are fewer than the texts are long: only where they are too many for a broadcast the texts are dealt out
    few = gone.count() <= jaccard_join.BROADCAST_ROWS
    kept = named.join(F.broadcast(gone) if few else gone, F.col("doc_id") == F.col("g_id"), "left_anti")
    kept = kept.select("row").unionAll(rows.filter("doc_id is null").select("row"))
    return kept.select(*[F.col(f"row.{at[c]}").alias(c) for c in docs.columns])


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each passage of 50 words or more that repeats, all but the first occurrence are cut out."""
    return suffix_dedup.cut(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), targets=packing.TARGETS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", suffix_stage),
    ("packing", packing_stage),
]

#: Models, sketches and set joins are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    written = Written(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, before = written.save(stage(spark, docs, sf_dir), f"stage-{name}"), docs
        if hasattr(before, "written_at"):
            written.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
