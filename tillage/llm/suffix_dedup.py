"""Suffix-array dedup of repeated byte strings: suffixes sorted by hash comparisons."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tillage.llm.common import hold
from tillage.llm.packs import CROWDED, Contexts, Pack, buckets_for, cover, exchange, find_anchors, repeated_anchors, write_packs
from tillage.llm.words import mix, powers

_AT_ONCE = 1_000_000  # suffixes that a task sorts at a time
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class HashedText:
    """A text whose substrings are compared by prefix polynomial hashes, modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.data = data
        base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = powers(len(data) + 1, np.uint64(pow(int(base), -1, 2**64)))
        self.sums = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * powers(len(data), base))]

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, up to ``most``: a binary
        search over lengths whose hashes agree."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), most, np.int64)
        sa, sb, ia, ib = self.sums[a], self.sums[b], self.inverse[a], self.inverse[b]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = (self.sums[a + mid] - sa) * ia == (self.sums[b + mid] - sb) * ib
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)

    def less_or_equal(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        n = self.common(a, b, most)
        at = np.minimum(n, most - 1)
        return (n >= most) | (self.data[a + at] <= self.data[b + at])

    def equal(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        """Whether the bytes agree: verifies what the hashes say."""
        out = np.empty(len(a), bool)
        step = np.arange(size)
        for i in range(0, len(a), 4096):
            out[i : i + 4096] = (self.data[a[i : i + 4096, None] + step] == self.data[b[i : i + 4096, None] + step]).all(1)
        return out


def sort_suffixes(text: HashedText, places: np.ndarray, groups: np.ndarray, most: int) -> np.ndarray:
    """Order of ``places`` by group, and in a group by the first ``most`` bytes of the suffix there:
    a bottom-up mergesort that merges the runs of all groups side by side."""
    order = np.argsort(groups, kind="stable")
    sorted_groups = groups[order]
    begin = np.flatnonzero(np.r_[True, sorted_groups[1:] != sorted_groups[:-1]])
    end = np.r_[begin[1:], len(order)]
    width = 1
    while True:
        wide = end - begin > width
        if not wide.any():
            return order
        pairs = np.ceil((end - begin)[wide] / (2 * width)).astype(np.int64)
        left = np.repeat(begin[wide], pairs) + 2 * width * (np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs))
        stop = np.repeat(end[wide], pairs)
        i, i_end = left.copy(), np.minimum(left + width, stop)
        j, j_end = i_end.copy(), np.minimum(left + 2 * width, stop)
        merged, out = order.copy(), left.copy()
        live = np.flatnonzero(j < j_end)
        while len(live):
            a, b = order[i[live]], order[j[live]]
            first = text.less_or_equal(places[a], places[b], most)
            merged[out[live]] = np.where(first, a, b)
            out[live] += 1
            i[live] += first
            j[live] += ~first
            # when one run is used up, the rest of the other one is in order
            done_i, done_j = i[live] >= i_end[live], j[live] >= j_end[live]
            for x in live[done_i & ~done_j]:
                merged[out[x] : out[x] + j_end[x] - j[x]] = order[j[x] : j_end[x]]
            for x in live[done_j & ~done_i]:
                merged[out[x] : out[x] + i_end[x] - i[x]] = order[i[x] : i_end[x]]
            live = live[~done_i & ~done_j]
        order = merged
        width *= 2


def _judge(window: int):
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        hold("packs")
        kind = np.dtype([("name", np.uint64), ("offset", np.int32), ("windows", np.int32)])
        index: dict[tuple, int] = {}
        which, total, texts, tops, sizes = [], [], [], [], []
        for rows, blob, counts in zip(pdf["rows"], pdf["texts"], pdf["counts"]):
            rows, counts, at = np.frombuffer(rows, kind), np.frombuffer(counts, np.int64), 0
            sizes.append(len(rows))
            for (name, offset, windows), count in zip(rows.tolist(), counts.tolist()):
                text = blob[at : at + windows + window - 1]
                at += len(text)
                got = index.setdefault((name, offset, text), len(texts))
                if got == len(texts):
                    texts.append(text)
                    tops.append((name, offset, windows))
                    total.append(0)
                which.append(got)
                total[got] += count
        tops, total, which = np.array(tops, kind), np.array(total), np.array(which)
        own = np.r_[0, np.cumsum(tops["windows"])]
        bits = np.repeat(total > 1, tops["windows"])
        # contexts that share their anchor with another distinct one
        _, group, many = np.unique(tops["name"], return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(many[group] > 1)
        mixed = mixed[np.argsort(group[mixed], kind="stable")]
        # in parts of about a million suffixes, cut between anchors
        part = np.cumsum(tops["windows"][mixed]) // _AT_ONCE
        part = part[np.searchsorted(group[mixed], group[mixed])]
        for some in np.split(mixed, np.flatnonzero(np.diff(part)) + 1) if len(mixed) else []:
            n = tops["windows"][some].astype(np.int64)
            again = np.repeat(np.arange(len(some)), n)
            step = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            text = HashedText(np.frombuffer(b"".join([texts[i] for i in some]), np.uint8))
            places = (np.cumsum(n + window - 1) - (n + window - 1))[again] + step
            groups = group[some][again].astype(np.int64) * 1_000_003 + (tops["offset"][some][again] - step)
            order = sort_suffixes(text, places, groups, window)
            a, b = order[:-1], order[1:]
            near = groups[a] == groups[b]
            a, b = a[near], b[near]
            alike = text.common(places[a], places[b], window) >= window
            a, b = a[alike], b[alike]
            sure = text.equal(places[a], places[b], window)
            for x in (a[sure], b[sure]):
                bits[own[some[again[x]]] + step[x]] = True
        out, at = [], 0
        for n in sizes:
            out.append(np.packbits(np.concatenate([bits[own[c] : own[c + 1]] for c in which[at : at + n]])).tobytes())
            at += n
        return pd.DataFrame({"shard": pdf["shard"], "pack": pdf["pack"], "bits": out})

    return judge


def suffix_dedup(docs: DataFrame, length: int = 400, texts: bool = True, crowded: int = CROWDED) -> DataFrame:
    """Removes every byte that a ``length``-byte string covers which also starts anywhere else, in
    the same document or another; overlaps count and strings are judged on the input.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes) and with ``texts`` the spans (begin, end) and kept, the
    remaining bytes. A null text is empty, an empty or short one loses nothing. Rows that repeat
    a doc_id or a text are separate places, so repeated texts of ``length`` bytes or more are
    removed everywhere. Matches do not cross rows. Other columns are ignored; an empty table
    gives an empty result.

    Only strings whose anchor occurs twice travel, as contexts: one copy per pack of equal ones.
    A shard sorts the suffixes that begin its strings, those with one anchor at one offset side by
    side, and neighbours in that order that agree in ``length`` bytes are repeats. The contexts
    of an anchor in very many places are dealt out in halves, by the text that the strings of a half share.
    """
    gram = max(1, min(64, length // 4))
    packs = write_packs(docs)
    buckets = buckets_for(packs)

    def found(pack: Pack):
        return find_anchors(mix(np.frombuffer(pack.data, np.uint8).astype(np.uint64) + np.uint64(1)), pack.edges, length, gram)

    def anchors(pack: Pack):
        names, place, _, _ = found(pack)
        return names, place, pack.edges

    def contexts(pack: Pack, known):
        all_ = found(pack)
        made = Contexts(pack.data, 1, all_, known, length, gram, buckets, np.zeros(len(all_[0]), np.int64))
        return made, np.bincount(made.which, minlength=len(made.rows)).astype(np.int64)

    known = repeated_anchors(packs, anchors, buckets, by_document=False, crowded=crowded)
    flags = exchange(packs, known, contexts, _judge(length), "counts")

    def finish(batches):
        hold("packs")
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row["doc_ids"], row["sizes"], row["data"])
                gone = np.zeros(len(pack.data), bool)
                if row["flags"]:
                    made, _ = contexts(pack, row["known"])
                    bits = made.answers({f["shard"]: f["bits"] for f in row["flags"]})
                    own = np.r_[0, np.cumsum(made.rows["windows"])]
                    n = made.last - made.first + 1
                    again = np.repeat(np.arange(len(n)), n)
                    step = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
                    hit = bits[own[made.which[again]] + step]
                    gone = cover(len(pack.data), (made.first[again] + step)[hit], length)
                raw = np.frombuffer(pack.data, np.uint8)
                cells = {c: [] for c in names}
                for d, a, b in zip(pack.doc_ids, pack.edges[:-1], pack.edges[1:]):
                    off = gone[a:b]
                    edge = np.flatnonzero(np.diff(np.r_[False, off, False].view(np.int8)))
                    kept = raw[a:b][~off].tobytes() if len(edge) else pack.data[a:b]
                    for c, v in zip(names, (d, b - a, int(off.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), edge.reshape(-1, 2).tolist(), kept)):
                        cells[c].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(cells[c], t) for c, t in zip(names, kinds)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(("spans", "kept") if texts else ())]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<array<long>>, kept binary" if texts else "")
    return packs.join(known, "pack", "left").join(flags, "pack", "left").mapInArrow(finish, schema)
