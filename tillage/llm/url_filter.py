"""URL filter: reversed-host keys, prefix rules as intervals, one sorted sweep per key range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillage.llm.common import ascii_lower, tasks
from tillage.session import materialize


def parse_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path: after the first ``://`` the host runs up to ``/``, ``?``, ``#`` or the
    end (A-Z lower-cased), then the path up to ``?``, ``#`` or the end. A null url or one without
    ``://`` has both empty. Ports and user names stay part of the host."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.char_length(text))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.char_length(raw) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return df.withColumns({"host": ascii_lower(raw), "path": path})


def _host_key(host):
    """``a.b.net`` gives ``net.b.a.``: a host and its subdomains are the keys with one prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits) and verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains if the path starts with the rule's path; the longest ``host + path`` wins and of
    equal rules the blocking one. Pages without a rule get ``default``.

    The keys of a rule's host and subdomains form one interval in sort order, and such
    intervals nest. Pages are dealt into key ranges (a hot host spreads over several, by page),
    each range gets the rules whose interval meets it, and a sweep in key order keeps, for every
    nesting depth, the rule host opened last: the stack of active rules.

    Null, empty or odd urls keep their row; repeated pages give repeated rows; an empty table
    gives an empty result; other columns of either table are ignored. The rules of one host
    travel as one row, so the rule list is configuration, not a corpus.
    """
    spark = pages.sparkSession
    points = parse_url(pages.select(F.col(id_col).alias("id"), F.col(url).alias("url")), "url").select(
        "id", "host", "path", _host_key(F.col("host")).alias("key"))
    binned = materialize(
        points.repartitionByRange(tasks(spark), "key", F.xxhash64("id")).withColumn("bin", F.spark_partition_id()), "url-ranges")
    bounds = binned.groupBy("bin").agg(F.min("key").alias("low"), F.max("key").alias("high"))

    by_host = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(_host_key(ascii_lower(F.col("host"))).alias("key"), F.struct(
            F.char_length(F.concat("host", "path")).alias("length"), "verdict",
            F.concat(ascii_lower(F.col("host")), F.col("path")).alias("rule"), F.col("path").alias("under")).alias("item"))
        .groupBy("key").agg(F.collect_set("item").alias("items"))
        .withColumn("depth", F.size(F.split("key", r"\.")) - 1))
    depths = sorted(r[0] for r in by_host.select("depth").distinct().collect())  # nesting depths: labels of a host name

    # a row per key range, so the broadcast is bounded by the number of shuffle partitions
    opened = by_host.join(F.broadcast(bounds), (F.col("key") <= F.col("high")) & ((F.col("key") >= F.col("low")) | F.col("low").startswith(F.col("key"))))
    events = opened.select("bin", "key", F.lit(0).alias("kind"), "depth", "items").unionByName(
        binned.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    sweep = Window.partitionBy("bin").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slots = {f"slot{d}": F.last(F.when((F.col("kind") == 0) & (F.col("depth") == d), F.struct("key", "items")), ignorenulls=True).over(sweep) for d in depths}
    swept = events.select("id", "host", "path", "key", "kind", *[c.alias(n) for n, c in slots.items()]).where("kind = 1")
    active = [F.when(F.col("key").startswith(F.col(f"{n}.key")), F.col(f"{n}.items")) for n in slots]
    fitting = F.filter(F.flatten(F.array_compact(F.array(*active))), lambda r: F.col("path").startswith(r["under"])) if active else None
    best = F.array_max(fitting) if active else None
    found = swept.withColumn("best", best) if active else swept.withColumn("best", F.lit(None).cast("struct<verdict:string,rule:string>"))
    return found.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
