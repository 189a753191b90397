"""Near-duplicates by MinHash: coordinates posted in an inverted index, collisions counted."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import hold, slices
from tillage.llm.components import components
from tillage.llm.words import mix, shingle_set
from tillage.session import materialize

_ALL = np.uint64(2**64 - 1)


def match_threshold(similarity: float, coordinates: int, miss: float = 1e-7) -> int:
    """The most equal coordinates to ask for so that a pair just at ``similarity`` has fewer with a
    probability under ``miss``."""
    total = 0.0
    for t in range(coordinates + 1):
        total += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if total > miss:
            return max(1, t)
    return coordinates


def _signed(docs: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """doc_id, text hash, n (distinct shingles), cls (16 bytes that stand for the set) and items
    (one number per coordinate and value)."""
    factors = mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    places = np.arange(coordinates, dtype=np.int64) << 40

    def run(batches):
        hold("minhash")
        for batch in slices(batches):
            n, classes, items = [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingle_set(text.encode(), shingle)
                n.append(len(grams))
                if not len(grams):
                    classes.append(b"")
                    items.append(np.zeros(0, np.int64))
                    continue
                least = np.full(coordinates, _ALL)
                for at in range(0, len(grams), 2048):
                    least = np.minimum(least, (grams[at : at + 2048, None] * factors).min(0))
                items.append(places | (least >> np.uint64(24)).astype(np.int64))
                classes.append(np.array([mix(grams).sum(), mix(grams ^ np.uint64(0xA5A5A5A5)).sum()], np.uint64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(items, pa.list_(pa.int64()))],
                names=["doc_id", "hash", "n", "cls", "items"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, hash long, n long, cls binary, items array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def run(batches):
        hold("minhash")
        for batch in slices(batches):
            keep = []
            for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = pairs.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("left")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("grams").alias("right")), "b")
    return full.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def _within_reach(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that meet under their first common token and can still reach
    the similarity. ``posted``: cls, n, label, token, place (of the token in the set's order), big.

    What comes before a first common token is not shared, so at most ``min(n - place, m - place)``
    tokens are. The smaller set is posted under so few tokens that a partner of its own size
    is possible, once, with its size; the larger one asks for the sizes that its place leaves
    possible. Sizes are in bands of a twentieth, which are part of the key, so sets that only
    have a passage in common do not meet. Two sets of a list's largest component never meet.
    """
    whole = 100 + percent
    band = lambda size: F.floor(F.log(size.cast("double")) / float(np.log(20 / 19))).cast("int")
    small = posted.where(f"(n - place) * {whole} >= 2 * {percent} * n").select(
        "token", band(F.col("n")).alias("band"), F.col("cls").alias("a"), "n", F.col("label").alias("la"), F.col("place").alias("i"), "big")
    least = F.expr(f"({percent} * n + 99) div 100")
    most = F.least(F.col("n"), F.expr(f"((n - place) * {whole}) div {percent} - n"))
    large = posted.where(most >= least).select(
        "token", F.explode(F.sequence(band(least), band(most))).alias("band"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("label").alias("lb"), F.col("place").alias("j"), "big")
    fits = (f"la <> lb AND n <= m AND (n < m OR a < b) AND 100 * n >= {percent} * m"
            f" AND (n - i) * {whole} >= {percent} * (n + m) AND (m - j) * {whole} >= {percent} * (n + m)")

    def across(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.drop("big").join(y.drop("big"), ["token", "band"]).where(fits).select("a", "b")

    return across(small.where("NOT big"), large).unionAll(across(small.where("big"), large.where("NOT big")))


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5, coordinates: int = 64, rows: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable over
    links, itself included) and kept (doc_id = component_id); with ``rows`` also text_hash and
    first, which is true for the one text of a component, by doc_id and hash, that stands for it. Two documents are linked if the
    sets of their distinct ``shingle``-word shingles have a Jaccard similarity of at least
    ``percent`` percent; words are split at ASCII blanks and A-Z is lower-cased.

    Texts with equal sets are one class. A class is posted under each of its coordinate-value
    pairs, but of these only under its rarest ``coordinates - t + 1``: two classes with ``t`` equal
    coordinates share one of them. ``t`` is so low that a pair at the limit is missed once in
    ten million. Every posting list is first merged with its most central member, and the pairs
    with ``t`` collisions are confirmed on the full sets. Only where a list then still holds
    several components, its members outside the largest one meet the others: pairs inside a
    component are skipped, since they cannot change the result. So a group of copies costs about
    one pair per member, and no link between different components is lost.

    A null or empty text, or one without words, has an empty set and is linked with nothing. A
    row without doc_id is linked with nothing, has no component_id and is kept. Rows that repeat
    a doc_id are documents of their own. Other columns are ignored; an empty table gives an
    empty result.
    """
    t = match_threshold(percent / 100, coordinates)
    signed = materialize(_signed(docs, shingle, coordinates), "signatures")
    used = signed.where("doc_id IS NOT NULL AND n > 0")
    classes = materialize(
        used.groupBy("cls").agg(F.min(F.struct("doc_id", "hash")).alias("who"), F.first("n").alias("n"), F.first("items").alias("items")), "classes")
    labels = _labels(docs, classes, t, coordinates, shingle, percent)
    doc_of = classes.select("cls", F.col("who").alias("low")).join(labels.withColumnRenamed("node", "cls"), "cls")
    lowest = doc_of.join(doc_of.groupBy("label").agg(F.min("low").alias("lowest")), "label").select("cls", "lowest")
    alone = classes.select("cls", F.col("who").alias("own"))
    found = alone.join(lowest, "cls", "left").select("cls", F.coalesce("lowest", "own").alias("lowest"))
    joined = signed.select("doc_id", "hash", "n", "cls").join(found, "cls", "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    out = joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("lowest.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("hash").alias("text_hash"), (~linked | F.coalesce(F.col("lowest") == F.struct("doc_id", "hash"), F.lit(False))).alias("first"))
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    return out.select("doc_id", "n_shingles", "component_id", "kept", *(("text_hash", "first") if rows else ()))


def _labels(docs: DataFrame, classes: DataFrame, t: int, coordinates: int, shingle: int, percent: int) -> DataFrame:
    """(node, label) of the classes that are linked with others."""
    items = classes.select("cls", F.explode("items").alias("item"))
    sizes = items.groupBy("item").agg(F.count("*").alias("size")).where("size > 1")
    shared = items.join(sizes, "item").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("size", "item"))).alias("shared"))
    # items of one class alone are its rarest and fill the first places of its prefix
    places = F.lit(coordinates - t + 1) - (F.lit(coordinates) - F.size("shared"))
    chosen = materialize(
        shared.where(places > 0).select(
            "cls", F.slice("shared", F.lit(1), places).alias("prefix"), F.aggregate("shared", F.lit(0.0), lambda s, x: s + F.log2(x["size"])).alias("weight"))
        .join(classes.select("cls", "n", "items", "who"), "cls"), "postings")
    posts = chosen.select("cls", "n", "weight", F.explode("prefix.item").alias("item"))

    # the sets of the posted classes, from one pass over the texts
    def grams(batches):
        hold("minhash")
        for batch in slices(batches):
            sets = [shingle_set(x.encode(), shingle).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(sets, pa.binary())], names=["cls", "grams"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").withColumn("hash", F.xxhash64("text"))
    wanted = chosen.select("cls", F.col("who.doc_id").alias("doc_id"), F.col("who.hash").alias("hash"))
    sets = materialize(texts.join(wanted, ["doc_id", "hash"]).dropDuplicates(["cls"]).select("cls", "text").mapInArrow(grams, "cls binary, grams binary"), "sets")

    def colliding(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow the similarity and that have ``t`` equal coordinates."""
        side = chosen.select("cls", "items")
        both = pairs.distinct().join(side.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a").join(
            side.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
        return both.where(F.size(F.array_intersect("x", "y")) >= t).select("a", "b")

    fits = (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    centre = posts.groupBy("item").agg(F.max(F.struct("weight", "cls", "n")).alias("c")).select("item", F.col("c.cls").alias("b"), F.col("c.n").alias("m"))
    stars = posts.join(centre, "item").where((F.col("cls") != F.col("b")) & fits).select(F.col("cls").alias("a"), "b")
    first = materialize(_verified(colliding(stars), sets, percent), "links")

    labels = components(first)
    told = materialize(
        posts.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("item", "cls", "n", F.coalesce("label", "cls").alias("label")), "labelled")
    # lists that still hold several components: their members get exact prefixes of shingles, the
    # rarest first, of which a pair that reaches the similarity shares one. So those that only
    # have a passage in common, which is not rare, do not meet
    mixed = told.groupBy("item", "label").agg(F.lit(1).alias("one")).groupBy("item").agg(F.count("*").alias("parts")).where("parts > 1")
    open_ = told.join(mixed, "item").select("cls", "n", "label").distinct()

    def unpacked(batches):
        hold("minhash")
        for batch in slices(batches):
            cells = [np.frombuffer(x, np.int64) for x in batch.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cls", "n", "label")), pa.array(cells, pa.list_(pa.int64()))], names=["cls", "n", "label", "grams"])

    grams_of = materialize(open_.join(sets, "cls").select("cls", "n", "label", "grams").mapInArrow(unpacked, "cls binary, n long, label binary, grams array<long>"), "open-classes")
    tokens = grams_of.select("cls", F.explode("grams").alias("token"))
    rare = tokens.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    known = tokens.join(rare, "token").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("size", "token"))).alias("known"))
    # shingles that one class alone has come first and meet nothing
    own = F.col("n") - F.size("known")
    reach = F.expr(f"n - ({percent} * n + 99) div 100 + 1").cast("int") - own
    posted = materialize(
        known.join(grams_of.drop("grams"), "cls").where(reach > 0)
        .select("cls", "n", "label", own.alias("own"), F.posexplode(F.slice("known", F.lit(1), reach).getField("token")).alias("at", "token"))
        .select("cls", "n", "label", "token", (F.col("own") + F.col("at")).cast("long").alias("place")), "prefixes")
    held = posted.groupBy("token", "label").agg(F.count("*").alias("size"))
    parts = held.groupBy("token").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("token", F.col("top.label").alias("top"))
    several = posted.join(parts, "token").withColumn("big", F.col("label") == F.col("top")).drop("top")
    met = _within_reach(several, percent)
    second = materialize(_verified(colliding(met), sets, percent), "links")
    return labels if second.isEmpty() else components(first.unionAll(second))
