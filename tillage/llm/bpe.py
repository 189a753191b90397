"""Exact BPE by dynamic programming over prefixes, and decoding, for a tokenizer with word ends."""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import TwoAges, hold, owned, slices

_END = ""  # stands for the word end inside the automaton
_CONTROL = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")
_CACHED = 40 << 20  # bytes of an age of a memo


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


def _newer_letters():
    """Letters and digits that the regex module knows and this interpreter does not. A few code points
    at a time: all of them at once would hold 100 MB in every worker that starts."""
    wanted = regex.compile(r"[\p{L}\p{N}]")
    for begin in range(0, 0x110000, 4096):
        codes = range(max(begin, 0x80), begin + 4096)
        some = "".join([chr(c) for c in codes if not 0xD800 <= c < 0xE000])
        yield from (c for c in wanted.findall(some) if unicodedata.category(c) == "Cn")


class PrefixBPE:
    """Encodes words exactly as merging by rank would, without merging.

    An automaton over the vocabulary, with suffix links, lists all tokens that end at each
    position. The last token of a prefix's encoding is unique: it is the one whose rest is
    encoded with a last token that it is compatible with. Two tokens are compatible if no merge
    across their border comes before the merges that made them.
    """

    def __init__(self, tokenizer_file: str):
        import ahocorasick

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            whole = vocab[a + b]
            self.pair[vocab[a], vocab[b]] = rank
            if whole not in self.split:
                self.split[whole], self.rank[whole] = (vocab[a], vocab[b]), rank
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            made = i in self.split
            end = t.endswith(suffix) and t != suffix
            text = t.removesuffix(suffix) + _END if end else t
            if made or len(text) == 1 + end:
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.chars = _byte_chars()
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        # the pre-tokenizer's pattern comes from the file; letters and digits that this interpreter
        # does not know yet are newer than the tokenizers library's and count as other characters
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.unknown = dict.fromkeys(map(ord, _newer_letters()), "\u0378")  # a code point that no version assigns
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.pieces: dict[str, bytes] = TwoAges(_CACHED, "bpe")
        self.chunks: dict[str, tuple[bytes, str]] = TwoAges(_CACHED, "bpe")

    def compatible(self, left: int, right: int) -> bool:
        """Would BPE leave a border between these two tokens? Undoes their merges, latest first."""
        a, b, limit = left, right, len(self.pair)
        while True:
            merged = self.pair.get((a, b))
            if merged is not None and merged < limit:
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            # the later of the two inner merges is undone; a merge across the border must come no
            # later than it to be chosen, and of equal pairs the left one is merged first
            if ra > rb:
                limit, a = ra, self.split[a][1]
            else:
                limit, b = rb + 1, self.split[b][0]

    def word(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():  # these bytes stand for themselves
            text = piece + _END
        else:
            text = "".join([self.chars[b] for b in piece.encode()]) + _END
        ends: list[list] = [[] for _ in text]
        for at, match in self.automaton.iter(text):  # by end, longest first: along the suffix links
            ends[at].append(match)
        last: list[int | None] = [None] * len(text)  # the unique last token of each prefix, -1 if none
        back = [0] * len(text)
        known, want = self.compatible_pairs, [len(text) - 1]
        while want:  # prefixes are solved as longer ones ask for them
            at = want[-1]
            if last[at] is None:
                for size, token in ends[at]:
                    start = at - size
                    if start >= 0:
                        before = last[start]
                        if before is None:
                            want.append(start)
                            break
                        if before < 0:
                            continue
                        ok = known.get((before, token))
                        if ok is None:
                            if len(known) >= 300_000:
                                known.clear()
                            ok = known[before, token] = self.compatible(before, token)
                        if not ok:
                            continue
                    last[at], back[at] = token, start
                    want.pop()
                    break
                else:
                    last[at] = -1
                    want.pop()
            else:
                want.pop()
        ids, at = [], len(text) - 1
        if last[at] < 0:
            raise ValueError(f"the vocabulary cannot spell {piece!r}")
        while at >= 0:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]

    def piece(self, piece: str) -> list[int]:
        got = self.pieces.get(piece)
        if got is None:
            got = self.pieces.old.get(piece)
            if got is None:
                got = self.word(piece)
            if len(piece) <= 40:
                self.pieces[piece] = got = tuple(got)
        return got

    def chunk(self, text: str) -> list[int]:
        """Ids of a text without white space: normalised, cut by the pre-tokenizer, encoded."""
        if self.specials and "<" in text and (m := self.specials.search(text)):
            return [*self.chunk(text[: m.start()]), self.special[m[0]], *self.chunk(text[m.end() :])]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            ids: list[int] = []
            text = text.lower()
            shape = text.translate(self.unknown)  # as long as the text, so the spans agree
            for found in self.pattern.finditer(shape):
                ids += self.piece(text[found.start() : found.end()])
            return ids
        text = text.lower()
        if text.isalpha():
            return [*self.piece(text)]
        if text[-1:] in (".", ",") and text[:-1].isalpha():
            return [*self.piece(text[:-1]), *self.piece(text[-1])]
        ids = []
        for piece in self.pattern.findall(text):
            ids += self.piece(piece)
        return ids

    def decode(self, ids: list[int]) -> str:
        """As a tokenizer without a decoder does: the tokens' names with spaces between."""
        return " ".join(self.names[i] for i in ids)

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian unsigned 32-bit integers, and the decoded text."""
        words = [w for w in _SPACE.split(text) if w] if _CONTROL.search(text) else text.split()
        cache = self.chunks
        cache.turn()
        self.pieces.turn()
        missing = cache.missing(set(words))
        for w in missing:
            ids = self.chunk(w)
            cache[w] = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        found = [cache[w] for w in words]
        out = b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])
        for w in missing:
            if len(w) > 40:
                del cache[w]
        return out


_ENCODERS: dict[str, PrefixBPE] = owned("bpe")  # one per worker and file: only tables made from the file


def _encoder(tokenizer_file: str) -> PrefixBPE:
    hold("bpe")
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = PrefixBPE(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def bpe_encode(docs: DataFrame, tokenizer_file: str, text: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id`` with the exact ids of each whole text and the text decoded from them.

    Columns: doc_id, n_tokens, then ids (array of int) and decoded, or with ``digests`` their
    SHA-256: ids_sha256 over little-endian unsigned 32-bit integers, decoded_sha256 over UTF-8.
    A null or empty text has no ids. One row per input row, repeated ones too, in one pass
    without a shuffle; texts of any length are encoded whole. Other columns are ignored.
    """

    def encode(batches):
        encoder = _encoder(tokenizer_file)
        for batch in slices(batches):
            counts, first, second = [], [], []
            for t in batch.column("text").to_pylist():
                ids, decoded = encoder.encode(t)
                counts.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digests else np.frombuffer(ids, "<u4").astype(np.int32))
                second.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first, pa.string() if digests else pa.list_(pa.int32())), pa.array(second, pa.string())], names=names)

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    kinds = ["long", "long", *(("string", "string") if digests else ("array<int>", "string"))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(encode, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def bpe_decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id and decoded from a table of doc_id and ids; null ids decode to an empty text."""

    def decode(batches):
        encoder = _encoder(tokenizer_file)
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decode, "doc_id long, decoded string")
