"""Line dedup: hashed normalised lines, documents counted per hash, texts put together again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import BLANKS, LOWEST, ascii_lower


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced to the kept lines, plus n_lines and n_dropped.

    A line's key is the line without blanks at both ends and with A-Z lower-cased. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose their lines except in
    the largest doc_id that holds them.

    A null text is one empty line. Rows that repeat a doc_id count as one document when
    documents are counted; each row keeps its own lines, and rows equal in doc_id and text are
    treated alike. A missing doc_id counts as the smallest. An empty table gives an empty result.
    Other columns pass through; columns called n_lines or n_dropped are replaced.

    Only hashes and positions are shuffled for the counting. The texts move once, when each
    meets the positions that it loses. A frequent line costs one partial count per task.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    base = docs.select(*rest, F.coalesce("text", F.lit("")).alias("text")).withColumns({
        "__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)), "__hash": F.xxhash64("text")})
    key = ascii_lower(F.btrim(F.col("line"), F.lit(BLANKS)))
    lines = (
        base.select("__doc", "__hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .withColumn("key", key).where(F.char_length("key") >= min_chars)
        .select("__doc", "__hash", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")))
    common = (
        lines.groupBy("k1", "k2").agg(F.count_distinct("__doc").alias("n"), F.max("__doc").alias("keeper"))
        .where(F.col("n") >= min_docs).drop("n"))
    lost = (
        lines.join(common, ["k1", "k2"]).where("__doc <> keeper")
        .groupBy("__doc", "__hash").agg(F.collect_set("pos").alias("lost")))
    parts = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("lost"))
    joined = base.join(lost, ["__doc", "__hash"], "left")
    return joined.withColumn("__parts", parts).select(
        *rest,
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("__parts"), i)), "\n")).alias("text"),
        F.size("__parts").cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"))
