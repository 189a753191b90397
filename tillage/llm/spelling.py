"""Spelling variants: PartEnum signatures of letter multisets, equi-joined and verified."""

from __future__ import annotations

import math
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import hold
from tillage.llm.words import mix
from tillage.session import materialize

PARTS = 7  # parts of the dimensions; a signature leaves out as many as a pair may differ in
CROWD = 32  # a bucket with more words meets through its deletion neighbourhoods
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    """CRC registers after one more zero byte, without the inversions at both ends."""
    return (crc >> np.uint32(8)) ^ _CRC[crc & np.uint32(255)]


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & np.uint32(1), (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out


_CRC = _crc_table()


def letter_runs(data: np.ndarray) -> tuple[np.ndarray, pa.StringArray]:
    """Starts of the maximal runs of ``[A-Za-zÀ-ÿ]`` in UTF-8 bytes, and the runs with
    A-Z lower-cased. U+00C0 to U+00FF are C3 80 to C3 BF."""
    small = data | np.uint8(0x20)
    ascii_letter = (small >= 97) & (small <= 122) & (data < 128)
    first = np.r_[(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF), False] if len(data) else np.zeros(0, bool)
    letter = ascii_letter | first
    letter[1:] |= first[:-1]
    edge = np.flatnonzero(np.diff(np.r_[False, letter, False].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    kept = np.where(ascii_letter, small, data)[letter]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    return starts, pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))


def _damaged_counts(ids: list, texts: list[str], every: int, least: int) -> dict[str, int]:
    """Words of at least ``least`` code points and their counts, after the deletions."""
    sizes = [len(t.encode()) if not t.isascii() else len(t) for t in texts]
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    starts, runs = letter_runs(data)
    if not len(starts):
        return {}
    doc = np.searchsorted(np.cumsum(np.asarray(sizes) + 1), starts, "right")
    coded = runs.dictionary_encode()
    which = coded.indices.to_numpy()
    names = coded.dictionary.to_pylist()
    raw = [w.encode() for w in names]
    size = np.array([len(b) for b in raw])
    crc = np.array([zlib.crc32(b) for b in raw], np.uint32)
    head = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids], np.uint32)
    # crc(head + word) is the head's register after as many zero bytes as the word has, xor crc(word)
    found = np.zeros(len(which), np.uint32)
    length = size[which]
    order = np.argsort(length, kind="stable")
    cuts = np.searchsorted(length[order], np.arange(1, min(int(size.max()), 64) + 2))
    for n in range(1, len(cuts)):
        head = _zero_byte(head)
        at = order[cuts[n - 1] : cuts[n]]
        found[at] = head[doc[at]] ^ crc[which[at]]
    for i in order[cuts[-1] :].tolist():  # very long runs
        d = ids[doc[i]]
        found[i] = zlib.crc32(raw[which[i]], zlib.crc32(f"{'' if d is None else d}:".encode()))
    hit = found % np.uint32(every) == 0
    counts = np.bincount(which[~hit], minlength=len(names)).tolist()
    out = {w: n for w, n in zip(names, counts) if n and len(w) >= least}
    for k, h in zip(which[hit].tolist(), found[hit].tolist()):
        w = names[k]
        at = h % len(w)
        w = w[:at] + w[at + 1 :]
        if len(w) >= least:
            out[w] = out.get(w, 0) + 1
    return out


def count_words(docs: DataFrame, every: int = 97, least: int = 5) -> DataFrame:
    """word and n over all documents. A run whose ``crc32("<doc_id>:<run>")`` is divisible by
    ``every`` loses one code point. A batch of documents sends each of its words once."""

    def run(batches):
        hold("spelling")
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(ids):  # about 8 MB at a time; a longer text is one piece
                to, held = at, 0
                while to < len(ids) and (to == at or held + len(texts[to]) < 8 << 20):
                    held += len(texts[to])
                    to += 1
                found = _damaged_counts(ids[at:to], texts[at:to], every, least)
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])
                at = to

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(words: list[str], parts: int = PARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word the signatures under which it meets words that differ by a replacement, by a letter
    more, and by a letter less.

    A multiset is a binary vector with a dimension for each letter and how often it came
    before. A replacement changes two dimensions, an insertion one. The dimensions fall into
    ``parts``; vectors that differ in ``k`` of them agree on all but ``k`` parts, so one of the
    signatures that leave out ``k`` parts is equal. Only equal lengths (or those one apart) meet.
    """
    size = np.array([len(w) for w in words])
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((letters, owner))
    letters = letters[order]  # owners stay as they are
    fresh = np.r_[True, (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])][: len(letters)]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(letters)), 0))
    dimension = mix(letters * np.uint64(1 << 32) + (np.arange(len(letters)) - begin).astype(np.uint64))
    cells = np.zeros((len(words), parts), np.uint64)
    np.add.at(cells, (owner, (dimension % np.uint64(parts)).astype(np.int64)), mix(dimension ^ _STEP))
    whole = cells.sum(1)

    def signed(left_out, length):
        made = [mix(whole - cells[:, list(x)].sum(1)) + np.uint64(int(_STEP) * sum(1 << i for i in x) % 2**64) for x in combinations(range(parts), left_out)]
        return mix(np.stack(made, 1) + length.astype(np.uint64)[:, None] * np.uint64(1 << 40)).astype(np.int64)

    return signed(2, size), signed(1, size), signed(1, size - 1)


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b), once each, of words that differ by exactly one inserted, deleted or replaced
    code point.

    Words meet under equal signatures. A bucket of more than ``crowd`` words is dealt out: a word
    stands there under itself and under what it becomes by losing one code point, and near words
    share one of these, so such a bucket costs no more than its words and their neighbours.
    """

    def sign(batches):
        hold("spelling")
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                if part.num_rows:
                    swap, more, less = signatures(part.column("word").to_pylist())
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())) for x in (swap, more, less)]
                    yield pa.RecordBatch.from_arrays([part.column("word"), *lists], names=["word", "swap", "more", "less"])

    def tagged(name, kind):
        return F.transform(name, lambda key: F.struct(key.alias("key"), F.lit(kind).alias("kind")))

    signed = words.select("word").mapInArrow(sign, "word string, swap array<long>, more array<long>, less array<long>")
    # kind 0 meets kind 0 of its key; kind 1, the shorter word, meets kind 2
    posts = materialize(
        signed.select("word", F.explode(F.concat(tagged("swap", 0), tagged("more", 1), tagged("less", 2))).alias("p")).select("p.key", "p.kind", "word"),
        "spelling-posts")
    met = posts.groupBy("key").agg(
        F.count(F.when(F.col("kind") == 0, 1)).alias("swaps"), F.count(F.when(F.col("kind") == 1, 1)).alias("shorts"), F.count(F.when(F.col("kind") == 2, 1)).alias("longs"))
    used = met.where("swaps > 1 OR (shorts > 0 AND longs > 0)").select("key", (F.greatest("swaps", F.col("shorts") + F.col("longs")) > crowd).alias("crowded"))
    told = materialize(posts.join(used, "key"), "spelling-buckets")
    few, many = told.where("NOT crowded"), told.where("crowded")

    def pairs(left: DataFrame, right: DataFrame, on: list[str], same: bool) -> DataFrame:
        a, b = left.withColumnRenamed("word", "a"), right.withColumnRenamed("word", "b")
        met = a.join(b, on)
        return met.where("a < b" if same else "a <> b").select("a", "b")

    def kind(df, i):
        return df.where(F.col("kind") == i).select("key", "word")

    close = pairs(kind(few, 0), kind(few, 0), ["key"], True).unionAll(pairs(kind(few, 1), kind(few, 2), ["key"], False))

    def spread(batches):
        hold("spelling")
        for batch in batches:
            for w in batch.column("word").to_pylist():
                step = max(1, (4 << 20) // len(w))
                for at in range(0, len(w), step):
                    cut = [w[:i] + w[i + 1 :] for i in range(at, min(len(w), at + step)) if i == 0 or w[i] != w[i - 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([w] * len(cut), pa.string()), pa.array(cut, pa.string())], names=["word", "shape"])

    crowd_words = many.select("word").distinct()
    shapes = crowd_words.mapInArrow(spread, "word string, shape string").select("word", F.xxhash64("shape").alias("s1"), F.xxhash64(F.lit(1), "shape").alias("s2"))
    shapes = materialize(shapes, "spelling-shapes")
    own = crowd_words.select("word", F.xxhash64("word").alias("s1"), F.xxhash64(F.lit(1), "word").alias("s2"))
    wide = pairs(shapes, shapes, ["s1", "s2"], True).unionAll(pairs(own, shapes, ["s1", "s2"], False))
    ordered = close.unionAll(wide).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.where(F.levenshtein("a", "b", 1) == 1).distinct()


def spelling_variants(docs: DataFrame, every: int = 97, least: int = 5, min_count: int = 3, ratio: int = 2, crowd: int = CROWD) -> DataFrame:
    """One row per word: word, form, root, n, n_near and form_n.

    Words are the maximal runs of letters of the texts (A-Z lower-cased; see ``count_words`` for
    the deletions) with at least ``least`` code points and ``min_count`` occurrences. Near words
    differ by exactly one inserted, deleted or replaced code point. A word's form is its near
    word of largest n (ties: the smallest in code-point order) if that is at least ``ratio``
    times its own n; the root is where the forms lead to, the word itself if it has none.

    Null and empty texts have no words; a null doc_id counts as an empty one in the deletions;
    repeated rows count each; a run of any length is one word; other columns are ignored; an
    empty table gives an empty result. ``ratio`` must be over 1, so that forms never lead in circles.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    words = materialize(
        count_words(docs, every, least).where(F.col("n") >= min_count), "spelling-words")
    pairs = materialize(near_words(words, crowd), "spelling-pairs")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ranked = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = ranked.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best"))
    judged = words.join(best, "word", "left")
    takes = F.coalesce(-F.col("best.m") >= ratio * F.col("n"), F.lit(False))
    told = materialize(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.b")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")), "spelling-forms")
    # n grows by the ratio with every step, so a chain has a known longest length and each round halves it
    most = told.agg(F.max("n")).first()[0] or 1
    steps = math.floor(math.log(most / min_count, ratio)) + 1 if most > min_count else 1
    way = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(steps + 1)))):
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = materialize(way.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return told.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
