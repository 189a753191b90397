"""Substring dedup of repeated word runs against earlier documents, by an FM-index per shard."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tillage.llm.common import hold
from tillage.llm.fm_index import FMIndex, RangeMinimum
from tillage.llm.packs import CROWDED, Contexts, Pack, buckets_for, cover, exchange, find_anchors, repeated_anchors, write_packs
from tillage.llm.words import gram_hashes, word_hashes

_WIDTH = 6  # bytes of a word's hash that travel; a repeat has to agree in all words of a window


def _pack_words(pack: Pack):
    """hashes, starts and ends of the words of all documents, and where each document's begin."""
    separated = b"\n".join(pack.data[a:b] for a, b in zip(pack.edges[:-1], pack.edges[1:]))
    hashes, starts, ends = word_hashes(separated)
    edges = np.searchsorted(starts, pack.edges + np.arange(len(pack.edges)))
    return separated, hashes, starts, ends, edges


def _judge(window: int):
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        hold("packs")
        kind = np.dtype([("name", np.uint64), ("offset", np.int32), ("windows", np.int32)])
        index: dict[tuple, int] = {}
        which, least, texts, sizes, windows_of, own = [], [], [], [], [], []
        for rows, blob, docs in zip(pdf["rows"], pdf["texts"], pdf["docs"]):
            rows, docs, at = np.frombuffer(rows, kind), np.frombuffer(docs, np.int64), 0
            sizes.append(len(rows))
            own.append(docs)
            for (_, _, windows), doc in zip(rows.tolist(), docs.tolist()):
                n = (windows + window - 1) * _WIDTH
                text = blob[at : at + n]
                at += n
                got = index.setdefault(text, len(texts))
                if got == len(texts):
                    texts.append(text)
                    windows_of.append(windows)
                    least.append(doc)
                which.append(got)
                least[got] = min(least[got], doc)
        which, least, windows_of, own = np.array(which), np.array(least), np.array(windows_of), np.concatenate(own)
        raw = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, _WIDTH)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :_WIDTH] = raw
        _, symbol = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
        # contexts one after another, each closed by a 0
        length = windows_of + window - 1
        start = np.r_[0, np.cumsum(length + 1)]
        sequence = np.zeros(start[-1], np.int64)
        inside = np.ones(start[-1], bool)
        inside[start[1:] - 1] = False
        sequence[inside] = symbol + 1
        index_ = FMIndex(sequence, window)
        owner = np.repeat(np.arange(len(length)), length + 1)
        smallest = RangeMinimum(least[owner][index_.order])
        first = np.r_[0, np.cumsum(windows_of)]
        again = np.repeat(np.arange(len(length)), windows_of)
        place = start[again] + np.arange(len(again)) - first[again]
        earliest = np.empty(len(place), np.int64)
        step = np.arange(window)
        for at in range(0, len(place), 200_000):
            some = place[at : at + 200_000]
            matched, begin, end = index_.search(sequence[some[:, None] + step])
            # an interval of the full length; each window at least finds itself
            assert (matched == window).all()
            earliest[at : at + 200_000] = smallest.query(begin, end)
        out, at = [], 0
        for n in sizes:
            bits = [earliest[first[c] : first[c + 1]] < doc for c, doc in zip(which[at : at + n].tolist(), own[at : at + n].tolist())]
            out.append(np.packbits(np.concatenate(bits)).tobytes())
            at += n
        return pd.DataFrame({"shard": pdf["shard"], "pack": pdf["pack"], "bits": out})

    return judge


def substring_dedup(docs: DataFrame, window: int = 13, gram: int = 5, texts: bool = True, crowded: int = CROWDED) -> DataFrame:
    """Removes every word that a run of ``window`` words covers which also starts in a document with a
    smaller doc_id; runs are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a
    space) and with ``texts`` the removed intervals of words (begin, end) and kept. A null, empty or
    short text loses nothing. Rows with one doc_id never remove each other's words; a missing
    doc_id counts as the smallest. Other columns are ignored; an empty table gives an empty
    result.

    Only runs whose anchor stands in two documents travel, as contexts: one copy per pack of
    equal ones, with the smallest doc_id there. A shard builds an FM-index of its distinct contexts
    and streams all their windows through it by backward search; the interval of a match gives
    the smallest doc_id that holds it. The contexts of an anchor in very many places are
    dealt out in halves, by the words that the windows of a half share.
    """
    packs = write_packs(docs)
    buckets = buckets_for(packs)

    def found(pack: Pack):
        text, hashes, starts, ends, edges = _pack_words(pack)
        return find_anchors(hashes, edges, window, gram), hashes, edges, (text, starts, ends)

    def anchors(pack: Pack):
        (names, place, _, _), _, edges, _ = found(pack)
        return names, place, edges

    def made(pack: Pack, known):
        all_, hashes, edges, words = found(pack)
        body = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :_WIDTH]).tobytes()
        docs = pack.ids[np.searchsorted(edges[1:], all_[1], "right")] if len(all_[0]) else np.zeros(0, np.int64)
        return Contexts(body, _WIDTH, all_, known, window, gram, buckets, docs), hashes, edges, words

    def contexts(pack: Pack, known):
        c, _, _, _ = made(pack, known)
        least = np.full(len(c.rows), 2**63 - 1, np.int64)
        np.minimum.at(least, c.which, c.docs)
        return c, least

    known = repeated_anchors(packs, anchors, buckets, by_document=True, crowded=crowded)
    flags = exchange(packs, known, contexts, _judge(window), "docs")

    def gone(c: Contexts, flags, hashes: np.ndarray) -> np.ndarray:
        bits = c.answers({f["shard"]: f["bits"] for f in flags})
        own = np.r_[0, np.cumsum(c.rows["windows"])]
        n = c.last - c.first + 1
        again = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
        hit = bits[own[c.which[again]] + step]
        # the shards answer for the smallest doc_id of equal contexts here; among the windows of
        # this pack the later documents are found by the windows' own smallest doc_id
        start, doc = c.first[again] + step, c.docs[again]
        every, which = np.unique(gram_hashes(hashes, window)[start], return_inverse=True)
        least_of = np.full(len(every), 2**63 - 1, np.int64)
        np.minimum.at(least_of, which, doc)
        return cover(len(hashes), start[hit | (least_of[which] < doc)], window)

    def finish(batches):
        hold("packs")
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row["doc_ids"], row["sizes"], row["data"])
                c, hashes, edges, (text, starts, ends) = made(pack, row["known"])
                off = gone(c, row["flags"], hashes) if row["flags"] else np.zeros(len(hashes), bool)
                cells = {x: [] for x in names}
                for d, a, b in zip(pack.doc_ids, edges[:-1], edges[1:]):
                    kept = b" ".join([text[s:e] for s, e in zip(starts[a:b][~off[a:b]].tolist(), ends[a:b][~off[a:b]].tolist())])
                    edge = np.flatnonzero(np.diff(np.r_[False, off[a:b], False].view(np.int8)))
                    for x, v in zip(names, (d, b - a, int(off[a:b].sum()), hashlib.sha256(kept).hexdigest(), edge.reshape(-1, 2).tolist(), kept.decode() if texts else None)):
                        cells[x].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(cells[x], t) for x, t in zip(names, kinds)], names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(("intervals", "kept") if texts else ())]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.string()]
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", intervals array<array<long>>, kept string" if texts else "")
    return packs.join(known, "pack", "left").join(flags, "pack", "left").mapInArrow(finish, schema)
