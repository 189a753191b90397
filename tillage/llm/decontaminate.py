"""Benchmark decontamination: latent semantic retrieval, then common subsequences and answers."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import hold, release, slices, tasks
from tillage.llm.words import word_hashes
from tillage.session import materialize

BLOCK_ITEMS = 1000  # items that a task holds at once; a larger benchmark takes several passes
HELD = 0.95  # of a passage's length: what the latent space has to hold of it to stand for it
LENGTHS = (4, 8, 12, 16, 24)  # of the windows for passages shorter than the whole size
_MARKS = bytes(b for b in range(128) if not chr(b).isalnum())
_TO_BLANK = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, lower-cased and without ASCII marks, and where each text's begin."""
    raw = [t.lower().encode().translate(_TO_BLANK) for t in texts]
    edges = np.r_[0, np.cumsum([len(r) + 1 for r in raw])]
    hashes, starts, _ = word_hashes(b" ".join(raw))
    return hashes, np.searchsorted(starts, edges)


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one big integer as a row of bits."""
    where: dict = defaultdict(int)
    for i, x in enumerate(a):
        where[x] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each of ``terms`` (sorted hashes) occurs, and how many there are."""

    def count(batches):
        hold("decontamination")
        seen, n = np.zeros(len(terms), np.int64), 0
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            n += len(texts)
            for first in range(0, len(texts), 256):
                some = texts[first : first + 256]
                hashes, edges = _words(some)
                at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                doc = np.repeat(np.arange(len(some)), np.diff(edges))
                hit = terms[at] == hashes
                pairs = np.unique(doc[hit] * len(terms) + at[hit])
                seen += np.bincount(pairs % len(terms), minlength=len(terms))
        keep = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, keep], pa.int64()), pa.array(np.r_[n, seen[keep]], pa.int64())], names=["term", "n"])

    # a sum per term of the benchmark block, whatever the size of the corpus
    got = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(len(terms), np.int64), 0
    for r in got:
        if r["term"] < 0:
            total = r["n"]
        else:
            out[r["term"]] = r["n"]
    return out, total


def randomized_svd(passages: DataFrame, width: int, rank: int, rounds: int = 2, seed: int = 3) -> np.ndarray:
    """The leading right singular vectors (``width`` x rank) of the sparse matrix in ``passages``, whose
    rows have ``terms`` and ``weights``: a random range finder with power rounds. Each round is one
    job that sums A' (A X) over the rows; the sums have the size of the vocabulary."""

    def product(x: np.ndarray) -> np.ndarray:
        size = x.shape[1]

        def part(batches):
            hold("decontamination")
            total = np.zeros((width, size))
            for pdf in batches:
                for t, w in zip(pdf["terms"], pdf["weights"]):
                    total[t] += np.outer(w, w @ x[t])
            yield pd.DataFrame({"one": [0], "total": [total.tobytes()]})

        def add(pdf):
            hold("decontamination")
            return pd.DataFrame({"one": [0], "total": [sum(np.frombuffer(b) for b in pdf["total"]).tobytes()]})

        # sums of sums: first by groups of tasks, then one
        parts = passages.mapInPandas(part, "one long, total binary").withColumn("group", F.spark_partition_id() % 4)
        sums = parts.groupBy("group").applyInPandas(lambda pdf: add(pdf), "one long, total binary")
        return sum(np.frombuffer(r["total"]).reshape(width, size) for r in sums.collect())

    rank = min(rank, width)
    x = np.random.default_rng(seed).standard_normal((width, min(width, rank + 8)))
    for _ in range(rounds):
        x, _ = np.linalg.qr(product(x))
    inner = x.T @ product(x)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    top = np.argsort(-values)[:rank]
    return (x @ vectors[:, top[values[top] > 1e-9 * max(values.max(), 1e-300)]]).astype(np.float32)


class _Block:
    """What a task needs to search one block of items."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        self.size, self.step = size, size // 2
        hashes, edges = _words([t for _, t in items])
        self.ids = [i for i, _ in items]
        self.items = [hashes[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]
        # the answer of an item: its last sentence, if it has several and this one has 4 words at least
        parts = [_SENTENCE.split(t.strip()) for _, t in items]
        tails, cut = _words([p[-1] if len(p) > 1 else "" for p in parts])
        self.answers = [tails[a:b].tolist() if b - a >= 4 else [] for a, b in zip(cut[:-1], cut[1:])]
        self.terms = np.unique(hashes)
        self.passages = []  # item and its words
        for k, words in enumerate(self.items):
            for at in range(0, max(1, len(words) - self.step), self.step):
                if words:
                    self.passages.append((k, words[at : at + size]))

    def weigh(self, frequencies: np.ndarray, documents: int) -> None:
        self.idf = np.log((documents + 1) / (frequencies + 1)).astype(np.float32) + 0.05

    def rows(self) -> pd.DataFrame:
        out = []
        for _, words in self.passages:
            terms, counts = np.unique(np.searchsorted(self.terms, np.array(words, np.uint64)), return_counts=True)
            weights = counts * self.idf[terms].astype(float)
            out.append((terms.tolist(), (weights / np.sqrt((weights**2).sum())).tolist()))
        return pd.DataFrame(out, columns=["terms", "weights"])

    def fit(self, vectors: np.ndarray) -> None:
        """Takes the latent space. Passages of which it holds less than HELD are searched by their own words."""
        self.vectors, self.tables = vectors.astype(np.float32), None
        self.owner = np.array([k for k, _ in self.passages])
        # a passage is searched with windows of about its own length
        lengths = np.array([n for n in LENGTHS if n < self.size] + [self.size])
        self.length = lengths[np.searchsorted(lengths, [len(w) for _, w in self.passages])]

    def _tables(self) -> list[tuple]:
        """Per window length: what a word adds to a window's vector, the held passages' targets in its
        first columns, and the passages in the order of the cosines. Built in the worker: it is larger than the block."""
        rows, out = self.rows(), []
        held = np.stack([np.array(w) @ self.vectors[t] for t, w in zip(rows["terms"], rows["weights"])]).astype(np.float32)
        share = np.linalg.norm(held, axis=1)
        for length in np.unique(self.length):
            near, own = (np.flatnonzero((self.length == length) & x) for x in (share >= HELD, share < HELD))
            latent = self.vectors if len(near) else self.vectors[:, :0]
            words = np.zeros((len(self.terms), latent.shape[1] + len(own)), np.float32)
            words[:, : latent.shape[1]] = latent
            for column, p in enumerate(own, latent.shape[1]):
                words[rows["terms"][p], column] = rows["weights"][p]
            targets = (held[near] / share[near, None]).T if len(near) else None
            out.append((int(length), words * self.idf[:, None], targets, latent.shape[1], np.r_[near, own]))
        return out

    def search(self, texts: list[str], cosine: float) -> dict[int, set[tuple[int, int, int]]]:
        """Candidates by text: (item, word at which a similar window begins, length of the window)."""
        if self.tables is None:
            self.tables = self._tables()
        hashes, edges = _words(texts)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = self.terms[at] == hashes
        self.hashes, self.edges = hashes, edges
        # words that no item has do not make a window longer: the subsequence decides what they part
        squares = np.where(known, self.idf[at] ** 2, 0)
        total = np.r_[0, np.cumsum(squares, dtype=np.float64)]
        sizes, place, term = np.diff(edges), np.flatnonzero(known), at[known]
        found: dict[int, set] = defaultdict(set)
        for length, words, targets, latent, order in self.tables:
            # windows are two blocks of half their length, so each half is added up once
            step = max(1, length // 2)
            n = -(-sizes // step)
            first = np.cumsum(n) - n
            text = np.repeat(np.arange(len(sizes)), n)
            begin = edges[:-1][text] + step * (np.arange(len(text)) - first[text])
            norm = np.sqrt(total[np.minimum(begin + 2 * step, edges[1:][text])] - total[begin])
            cut = np.r_[np.searchsorted(place, begin), len(place)]  # the known words of each block
            for low in range(0, len(text), 1024):
                high = min(low + 1024, len(text))
                blocks = np.arange(low, min(high + 1, len(text)))
                full = np.flatnonzero(cut[blocks + 1] > cut[blocks])
                if not len(full):
                    continue
                sums = np.zeros((len(blocks) + 1, words.shape[1]), np.float32)
                for part in np.array_split(full, -(-len(full) // 128)):
                    a, b = cut[blocks[part[0]]], cut[blocks[part[-1]] + 1]
                    sums[part] = np.add.reduceat(words[term[a:b]], cut[blocks[part]] - a)
                windows = np.arange(low, high)
                joined = np.flatnonzero(text[np.minimum(windows + 1, len(text) - 1)] == text[windows])
                joined = joined[windows[joined] + 1 < len(text)]
                vectors = sums[: len(windows)]
                vectors[joined] += sums[joined + 1].copy()
                limit = cosine * np.maximum(norm[windows], 1e-9)[:, None]
                if targets is not None:
                    vectors = np.hstack([vectors[:, :latent] @ targets, vectors[:, latent:]])
                for i, p in zip(*np.nonzero(vectors >= limit)):
                    found[int(text[low + i])].add((int(self.owner[order[p]]), int(begin[low + i]), length))
        return found

    def confirm(self, text: int, candidates: set[tuple[int, int, int]], most: float, less: float) -> tuple[int, float] | None:
        """(item, overlap) of the best confirmed candidate of a text."""
        best = None
        for item, begin, length in candidates:
            words = self.items[item]
            a = max(self.edges[text], begin - len(words))
            b = min(self.edges[text + 1], begin + length + len(words))
            region = self.hashes[a:b].tolist()
            overlap = common_subsequence(words, region) / len(words)
            if overlap < less or best and (best[1], -best[0]) >= (overlap, -self.ids[item]):
                continue
            answer = self.answers[item]
            if overlap >= most or answer and common_subsequence(answer, region) >= 0.8 * len(answer):
                best = (self.ids[item], overlap)
        return best


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 32, rank: int = 128, cosine: float = 0.4, most: float = 0.6, less: float = 0.45) -> DataFrame:
    """``docs`` with item_id (the benchmark item found, null if none), overlap (the share of the item's
    words in the common subsequence, 0 if none) and contaminated.

    Items are cut into passages of ``size`` words, every half of it; texts into windows about as long as
    the passage that is looked for, each half overlapping the next. Words weigh by their document frequency
    over all documents; words outside the benchmark do not lessen a cosine. A randomised singular value decomposition of the benchmark's
    TF-IDF passages gives the latent space, in which document passages with a cosine of at least
    ``cosine`` to a benchmark passage are candidates. A passage that the space does not hold (less than
    HELD of its length) is compared by its own TF-IDF vector instead, whatever the rank. Around a candidate, the longest common subsequence with
    the whole item has to hold a share ``most`` of the item's words, or ``less`` and 80 percent of
    its answer (the last sentence). So copies, and paraphrases that drop, add or
    swap words, are found; passages that share only common words are not.

    Every row is kept, repeated ones too. Null and empty texts are clean; null or wordless items
    and an empty benchmark match nothing; of equal overlaps the smaller item_id is named. Columns
    called item_id, overlap or contaminated are replaced. Whole texts are searched, in one pass
    without a shuffle per block of items.
    """
    spark = docs.sparkSession
    out = docs.drop("item_id", "overlap", "contaminated").withColumns({
        "item_id": F.lit(None).cast("long"), "overlap": F.lit(0.0), "contaminated": F.lit(False)})
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    # the stated query set in blocks: only one block is held at a time
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        block = _Block([(r["item_id"], r["text"]) for r in rows], size)
        if not block.passages:
            continue
        block.weigh(*document_frequencies(docs, block.terms))
        table = materialize(spark.createDataFrame(block.rows(), "terms array<int>, weights array<double>").repartition(tasks(spark)), "passages")
        block.fit(randomized_svd(table, len(block.terms), rank))
        release()
        out = _search(out, block, cosine, most, less)
    return out


def _search(docs: DataFrame, block: _Block, cosine: float, most: float, less: float) -> DataFrame:
    names, schema = docs.columns, docs.schema
    shared = docs.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_ITEMS items and their vectors

    def run(batches):
        hold("decontamination")
        b = shared.value
        yield from searched(b, batches)
        b.tables = None  # a worker holds them no longer than its task

    def searched(b, batches):
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, overlaps, bad = (batch.column(c).to_pylist() for c in ("item_id", "overlap", "contaminated"))
            for first in range(0, len(texts), 128):
                for k, candidates in b.search(texts[first : first + 128], cosine).items():
                    best = b.confirm(k, candidates, most, less)
                    if best and best[1] > overlaps[first + k]:
                        ids[first + k], overlaps[first + k], bad[first + k] = best[0], best[1], True
            new = {"item_id": pa.array(ids, pa.int64()), "overlap": pa.array(overlaps, pa.float64()), "contaminated": pa.array(bad, pa.bool_())}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    return docs.mapInArrow(run, schema)
