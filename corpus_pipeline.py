"""The corpus pipeline: toxicity, line dedup, near-duplicates, benchmark leaks, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillage.llm.bpe import bpe_encode
from tillage.llm.common import table
from tillage.llm.decontaminate import flag_contaminated
from tillage.llm.line_dedup import line_dedup
from tillage.llm.minhash import near_duplicates
from tillage.llm.queries import tokenizer, toxicity_model
from tillage.llm.toxicity import score_toxicity
from tillage.session import fresh_path, materialize


def free_name(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (a score of 0.3 or more) go."""
    column = free_name(docs, "score")
    scored = score_toxicity(docs, toxicity_model(spark, sf_dir), column)
    return scored.where(F.col(column) < 0.3).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in one of them; n_chars follows the text."""
    return line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, a similarity of 0.8) one row stays: that
    with the smallest doc_id, of equal ids the one with the smallest hash of its text. Rows are told
    apart by doc_id and text, so other texts under the same doc_id stay."""
    key = [free_name(docs, "row_doc"), free_name(docs, "row_text")]
    named = docs.withColumns({key[0]: F.col("doc_id").cast("long"), key[1]: F.xxhash64(F.coalesce("text", F.lit("")))})
    found = materialize(
        near_duplicates(docs, percent=80, shingle=5, rows=True).where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1])).agg(F.first("first").alias("stands"), F.count("*").alias("times"))
        .where("NOT stands OR times > 1"), "pipeline-copies")
    kept = named.join(found.select(*key), key, "left_anti")
    repeated = found.where("stands").select(*key)  # rows that repeat one that stands for its group
    if not repeated.isEmpty():
        kept = kept.unionAll(named.join(repeated, key, "left_semi").dropDuplicates(key).select(*kept.columns))
    return kept.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    flagged = flag_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return flagged.where("NOT contaminated").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text that is left, by digest, and of the text decoded from them."""
    return bpe_encode(docs, tokenizer("word_bpe_49k.json"), digests=True)


BATCH_ROWS = 512  # rows that travel to a Python worker at once, as many as the operators take up at a time


def in_small_batches(stage):
    """``stage`` with small batches between executor and Python worker, for the session from then on: a batch
    of 10,000 whole texts takes more memory on either side than all that is made of it."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:  # 0 and less: no limit
            spark.conf.set(key, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    (name, in_small_batches(stage))
    for name, stage in (
        ("toxicity", drop_toxic),
        ("line dedup", drop_lines),
        ("near-duplicates", drop_near_duplicates),
        ("decontamination", drop_leaks),
        ("bpe", encode),
    )
]
ORACLE_SQL = None  # a trained model, a latent space and BPE are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
