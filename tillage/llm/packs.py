"""What the two repeat finders share: documents in packs, content-chosen anchors, and the exchange
that brings together the places where a repeat can be.

A window is a run of ``window`` units (bytes or words). Its anchor is the ``gram`` units in it with
the smallest hash, the leftmost of equals. So equal windows have equal anchors at equal offsets,
and only windows whose anchor occurs twice can repeat. Consecutive windows with one anchor form a
context, the text that they cover.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import LOWEST, hold, tasks
from tillage.llm.words import mix, powers
from tillage.session import materialize

PACK_BYTES = 2 << 20
_BLOCK = 1 << 20
_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
#: The contexts of an anchor in more places than this are dealt out in two halves, each by the text
#: that all its windows share.
CROWDED = 1000
BANDS = 2


def write_packs(docs: DataFrame) -> DataFrame:
    """pack, doc_ids, sizes (bytes per document) and data (all texts, compressed), about
    PACK_BYTES to a pack; a long text is one pack. Packs are written once, so later jobs read the
    texts from them, and a row keeps its place whatever its doc_id."""

    def run(batches):
        hold("packs")
        part, made = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0
        names = ["pack", "doc_ids", "sizes", "data"]

        def row():
            body = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([body], pa.binary())], names=names)

        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                t = t.encode() if t else b""
                if ids and (held + len(t) > PACK_BYTES or len(ids) >= 8192):
                    yield row()
                    made, ids, texts, held = made + 1, [], [], 0
                ids.append(d)
                texts.append(t)
                held += len(t)
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(run, "pack long, doc_ids array<long>, sizes array<long>, data binary"), "packs")


class Pack:
    def __init__(self, doc_ids, sizes, data):
        self.doc_ids, self.sizes = doc_ids, np.asarray(sizes, np.int64)
        self.ids = np.array([LOWEST if d is None else d for d in doc_ids], np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(data)
        self.edges = np.r_[0, np.cumsum(self.sizes)]


def find_anchors(units: np.ndarray, edges: np.ndarray, window: int, gram: int):
    """(hash, place, first, last) of each context: its anchor's hash and place and the first
    and last start of its windows, for units of documents that ``edges`` delimits."""
    found = []
    n, spread = len(units), window - gram + 1
    power, inverse = powers(min(n, _BLOCK + window) + 1, _BASE), powers(min(n, _BLOCK + window) + 1, _INVERSE)
    ends = edges[1:]
    for begin in range(0, n, _BLOCK):
        part = units[begin : begin + _BLOCK + window - 1]
        m = len(part) - window + 1
        if m <= 0:
            break
        sums = np.r_[np.uint64(0), np.cumsum(part * power[: len(part)])]
        names = mix((sums[gram:] - sums[:-gram]) * inverse[: len(sums) - gram])
        # the order among anchors, with the place in the lower bits
        low = (names & ~np.uint64((1 << 22) - 1)) | np.arange(len(names), dtype=np.uint64)
        have, size = low, 1
        while size * 2 <= spread:
            have = np.minimum(have[:-size], have[size:])
            size *= 2
        if spread > size:
            have = np.minimum(have[: len(have) - (spread - size)], have[spread - size :])
        place = (have[:m] & np.uint64((1 << 22) - 1)).astype(np.int64)
        at = np.arange(m, dtype=np.int64)
        doc = np.searchsorted(ends, at + begin, "right")
        inside = at + begin + window <= ends[np.minimum(doc, len(ends) - 1)]
        at, place, doc = at[inside], place[inside], doc[inside]
        if not len(at):
            continue
        change = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
        last = np.r_[change[1:], len(at)] - 1
        found.append((names[place[change]], place[change] + begin, at[change] + begin, at[last] + begin))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def buckets_for(packs: DataFrame) -> int:
    """Hash ranges for about 4 MB of text each, at least one per shuffle task: what a shard holds does
    not grow with the corpus."""
    return max(tasks(packs.sparkSession), packs.count() * PACK_BYTES >> 22)


def repeated_anchors(packs: DataFrame, anchors: Callable, buckets: int, by_document: bool, crowded: int = CROWDED) -> DataFrame:
    """pack and known: for each pack those of its anchors that occur twice (in two documents, if
    ``by_document``), with a mark on crowded ones. A pack sends each anchor once, with a count."""

    def send(batches):
        hold("packs")
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row["doc_ids"], row["sizes"], row["data"])
                names, place, edges = anchors(pack)
                if by_document:
                    doc = pack.ids[np.searchsorted(edges[1:], place, "right")]
                    order = np.lexsort((doc, names))
                    names, doc = names[order], doc[order]
                    fresh = np.r_[True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])][: len(names)]
                    names = names[fresh]
                names, counts = np.unique(names, return_counts=True)
                bucket = (names % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                kinds, first = np.unique(bucket[order], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array([row["pack"]] * len(kinds), pa.int64()),
                     pa.array([x.tobytes() for x in np.split(names[order], first[1:])][: len(kinds)], pa.binary()),
                     pa.array([x.astype(np.uint32).tobytes() for x in np.split(counts[order], first[1:])][: len(kinds)], pa.binary())],
                    names=["bucket", "pack", "names", "counts"])

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        hold("packs")
        parts = [np.frombuffer(x, np.uint64) for x in pdf["names"]]
        names = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["counts"]]).astype(np.int64)
        every, which = np.unique(names, return_inverse=True)
        total = np.bincount(which, counts, len(every))[which]
        out, at = [], 0
        for x in parts:
            part, t = x, total[at : at + len(x)]
            at += len(x)
            out.append((part[t > 1].tobytes(), (t[t > 1] > crowded).tobytes()))
        return pd.DataFrame({"pack": pdf["pack"], "names": [a for a, _ in out], "crowded": [b for _, b in out]})

    sent = packs.mapInArrow(send, "bucket int, pack long, names binary, counts binary")
    back = sent.groupBy("bucket").applyInPandas(match, "pack long, names binary, crowded binary")
    return materialize(back.where("length(names) > 0").groupBy("pack").agg(F.collect_list(F.struct("names", "crowded")).alias("known")), "anchors")


def known_set(known) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a pack, sorted, and their marks."""
    if not known:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    names = np.frombuffer(b"".join(k["names"] for k in known), np.uint64)
    crowded = np.frombuffer(b"".join(k["crowded"] for k in known), bool)
    order = np.argsort(names)
    return names[order], crowded[order]


class Contexts:
    """A pack's contexts with repeated anchors; equal ones are sent once.

    ``width`` bytes stand for a unit in ``body``. A crowded context is cut into bands of windows by
    where the anchor stands in them. All windows of a band hold the same stretch of text around
    the anchor, and equal windows lie in bands of equal stretches, so a band goes where its stretch
    says, whole. ``shard`` says where each distinct context goes.
    """

    def __init__(self, body: bytes, width: int, found, known, window: int, gram: int, shards: int, docs: np.ndarray):
        names, place, first, last = found
        have, crowded = known_set(known)
        if len(have):
            at = np.minimum(np.searchsorted(have, names), len(have) - 1)
            hit = have[at] == names
        else:
            at, hit = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        names, place, first, last, loose, docs = (x[hit] for x in (names, place, first, last, crowded[at] if len(have) else hit, docs))
        band = -(-(window - gram + 1) // BANDS)
        if loose.any():
            # a band's windows begin from ``place - band * (b + 1) + 1`` to ``place - band * b``
            low, high = np.where(loose, (place - last) // band, 0), np.where(loose, (place - first) // band, 0)
            again = np.repeat(np.arange(len(low)), high - low + 1)
            b = low[again] + np.arange(len(again)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
            names, place, docs, loose, first, last = (x[again] for x in (names, place, docs, loose, first, last))
            first = np.where(loose, np.maximum(first, place - band * (b + 1) + 1), first)
            last = np.where(loose, np.minimum(last, place - band * b), last)
        self.first, self.last, self.docs = first, last, docs
        index: dict[tuple, int] = {}
        self.which = np.zeros(len(names), np.int64)  # of each context: the distinct one
        self.texts: list[bytes] = []
        rows, where = [], []
        for i, (name, offset, a, b, one) in enumerate(zip(names.tolist(), (place - first).tolist(), first.tolist(), last.tolist(), loose.tolist())):
            text = body[a * width : (b + window) * width]
            key = name, offset, text
            got = index.get(key)
            if got is None:
                got = index[key] = len(rows)
                rows.append((name, offset, b - a + 1))
                self.texts.append(text)
                if one:
                    b = offset // band
                    where.append(_own_hash(body[(a + offset - band * b) * width : (a + offset - band * (b + 1) + 1 + window) * width]) % shards)
                else:
                    where.append(name % shards)
            self.which[i] = got
        self.rows = np.array(rows, np.dtype([("name", np.uint64), ("offset", np.int32), ("windows", np.int32)])) if rows else np.zeros(0, [("name", np.uint64), ("offset", np.int32), ("windows", np.int32)])
        self.shard = np.array(where, np.int64)
        self.order = np.argsort(self.shard, kind="stable")  # distinct contexts as they are sent

    def sent(self, values: np.ndarray):
        """(shard, rows, texts, values) for each shard that gets something."""
        kinds, start = np.unique(self.shard[self.order], return_index=True)
        for kind, some in zip(kinds.tolist(), np.split(self.order, start[1:]) if len(kinds) else []):
            yield kind, self.rows[some].tobytes(), b"".join([self.texts[i] for i in some]), values[some].tobytes()

    def answers(self, flags: dict[int, bytes]) -> np.ndarray:
        """One bit per window of the distinct contexts, in their own order, from what the shards sent back."""
        bits = np.zeros(int(self.rows["windows"].sum()), bool)
        start = np.r_[0, np.cumsum(self.rows["windows"])]
        kinds, begin = np.unique(self.shard[self.order], return_index=True)
        for kind, some in zip(kinds.tolist(), np.split(self.order, begin[1:]) if len(kinds) else []):
            got = np.unpackbits(np.frombuffer(flags[kind], np.uint8)).astype(bool)
            at = 0
            for i in some:
                n = start[i + 1] - start[i]
                bits[start[i] : start[i + 1]] = got[at : at + n]
                at += n
        return bits


def _own_hash(text: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text)


def exchange(packs: DataFrame, known: DataFrame, contexts: Callable, judge: Callable, extra: str) -> DataFrame:
    """Sends every pack's distinct contexts to their shards, lets ``judge`` decide each shard, and
    returns pack and flags, the answers by shard."""

    def send(batches):
        hold("packs")
        for batch in batches:
            for row in batch.to_pylist():
                made, values = contexts(Pack(row["doc_ids"], row["sizes"], row["data"]), row["known"])
                rows = list(made.sent(values))
                if rows:
                    kinds, tops, texts, extras = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kinds, pa.int64()), pa.array([row["pack"]] * len(kinds), pa.int64()), *(pa.array(x, pa.binary()) for x in (tops, texts, extras))],
                        names=["shard", "pack", "rows", "texts", extra])

    sent = packs.join(known, "pack").mapInArrow(send, f"shard long, pack long, rows binary, texts binary, {extra} binary")
    judged = sent.groupBy("shard").applyInPandas(judge, "shard long, pack long, bits binary")
    return materialize(judged.groupBy("pack").agg(F.collect_list(F.struct("shard", "bits")).alias("flags")), "flags")


def cover(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` units a window beginning in ``starts`` covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0
