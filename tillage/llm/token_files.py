"""Token ids in Arrow files: fixed-size-list batches of equal-length sequences with masks."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillage.llm.common import TwoAges, hold, owned, tasks
from tillage.session import fresh_path, materialize

_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode's White_Space
_OTHER_RUN = re.compile(f"[{_SPACE}][ \n]")
_PIECES = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_ASCII_RUNS = ("  ", "\n\n", " \n", "\n ", "\x00", "\t", "\r", "\x0b", "\x0c")
_CACHED_CHARS = 40
_CACHED = 128 << 20  # bytes of an age of the memo


class ChunkEncoder:
    """Ids of whole texts by a byte-level tokenizer, chunk by chunk.

    The pre-tokenizer never joins a non-blank with a blank that follows it, so a text may be cut
    before every run of blanks; equal chunks are encoded once while remembered.
    ``dtype`` is the file's id type.
    """

    def __init__(self, tokenizer_file: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.cache = Tokenizer.from_file(tokenizer_file), dtype, TwoAges(_CACHED, "tokens")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    @staticmethod
    def chunks(text: str) -> list[str]:
        # where no blank meets another one, a cut before each blank is a cut before each run
        if any([run in text for run in _ASCII_RUNS]) or not text.isascii() and _OTHER_RUN.search(text):
            return _PIECES.findall(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for first in range(0, len(texts), 500):
            cut = [self.chunks(t) for t in texts[first : first + 500]]
            self.cache.turn()
            names = list(self.cache.missing({c for chunks in cut for c in chunks}))
            for at in range(0, len(names), 20_000):
                part = names[at : at + 20_000]
                # as words of one sequence: each is pre-tokenized by itself
                found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
                raw, size = np.asarray(found.ids, self.dtype).tobytes(), np.dtype(self.dtype).itemsize
                ends = np.searchsorted(np.asarray(found.word_ids, np.int64), np.arange(len(part)), "right") * size
                for c, a, b in zip(part, [0, *ends.tolist()], ends.tolist()):
                    self.cache[c] = raw[a:b]
            out += [b"".join(map(self.cache.__getitem__, chunks)) for chunks in cut]
            for c in names:
                if len(c) > _CACHED_CHARS:
                    del self.cache[c]
        return out


_ENCODERS: dict[tuple, ChunkEncoder] = owned("tokens")  # one per worker, file and type: only what the file implies


def _encoder(tokenizer_file: str, dtype: str) -> ChunkEncoder:
    hold("tokens")
    key = tokenizer_file, dtype
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[key] = ChunkEncoder(tokenizer_file, dtype)
    return _ENCODERS[key]


def _schema(length: int, dtype: str) -> pa.Schema:
    kind = pa.uint16() if dtype == "<u2" else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Packs a stream of ids into rows of ``length`` ids; the last row is padded and masked."""

    def __init__(self, sink, length: int, rows: int, dtype: str):
        self.schema, self.length, self.rows, self.dtype = _schema(length, dtype), length, rows, dtype
        self.file = pa.ipc.new_file(sink, self.schema)
        self.parts, self.held = [], 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.held += len(ids)
        full = self.length * self.rows * np.dtype(self.dtype).itemsize
        if self.held >= full:
            data = b"".join(self.parts)
            for at in range(0, len(data) - full + 1, full):
                self._write(np.frombuffer(data[at : at + full], self.dtype), self.length * self.rows)
            self.parts = [data[len(data) - len(data) % full :]]
            self.held = len(self.parts[0])

    def _write(self, ids: np.ndarray, used: int) -> None:
        mask = np.arange(len(ids)) < used
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (ids, mask)]
        self.file.write_batch(pa.record_batch(arrays, schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.parts), self.dtype)
        if len(rest):
            self._write(np.pad(rest, (0, -len(rest) % self.length)), len(rest))
        self.file.close()


class SequenceReader:
    """Random access to a written file: views on the file's own buffers, no copy where it is local."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.source = pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batches, self.first = {}, None

    def batch(self, k: int) -> np.ndarray:
        if k not in self.batches:
            self.batches = {k: self.file.get_batch(k).column(0).flatten().to_numpy(zero_copy_only=True)}
        return self.batches[k]

    def slices(self, start: int, n: int):
        """The ids [start, start + n) as one view per batch that they touch."""
        if self.first is None:
            self.first = len(self.batch(0)) if self.file.num_record_batches else 1
        while n > 0:
            ids = self.batch(start // self.first)
            part = ids[start % self.first : start % self.first + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.batches = {}
        self.source.close()


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = 0, length: int = 2048, rows: int = 64, vocabulary: int = 50_257) -> DataFrame:
    """Encodes ``text``, appends ``end_id`` to each document and writes the ids in ascending doc_id
    order as one Arrow file per task under ``folder`` (a URI or path that all executors reach).
    Returns the written index: doc_id, shard, path, at (offset in the file) and n_tokens.

    Shards follow each other in doc_id order; a missing doc_id comes first, equal ids follow the
    hash of their text. A null or empty text is the end id alone. An empty table writes no file.
    A file's name has the attempt in it and the index names the files of the attempts that
    counted, so lost executors and repeated tasks leave no mixed data. Other columns are ignored.
    """
    spark = docs.sparkSession
    dtype = "<u2" if vocabulary <= 65_536 else "<u4"

    def write(batches):
        context = TaskContext.get()
        shard, writer, encoder, at = context.partitionId(), None, None, 0
        end = np.asarray([end_id], dtype).tobytes()
        size = np.dtype(dtype).itemsize
        for batch in batches:
            if writer is None:
                encoder = _encoder(tokenizer_file, dtype)
                fs, base = pafs.FileSystem.from_uri(folder)
                fs.create_dir(base, recursive=True)
                name = f"shard-{shard:06d}-{context.taskAttemptId()}.arrow"
                sink = fs.open_output_stream(f"{base}/{name}")
                writer = SequenceWriter(sink, length, rows, dtype)
            ids = encoder.encode(batch.column("text").to_pylist())
            starts, counts = [], []
            for x in ids:
                writer.add(x)
                writer.add(end)
                starts.append(at)
                counts.append(len(x) // size + 1)
                at += counts[-1]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([shard] * n, pa.int32()), pa.array([f"{folder}/{name}"] * n, pa.string()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "shard", "path", "at", "n_tokens"])
        if writer is not None:
            writer.close()
            sink.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(tasks(spark), F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text")))
    return materialize(ordered.mapInArrow(write, "doc_id long, shard int, path string, at long, n_tokens long"), "token-index")


def read_token_files(index: DataFrame) -> DataFrame:
    """Per document, from the files that ``index`` names: doc_id, start (ids of all documents
    before it), n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def read(batches):
        hold("tokens")
        reader, opened = None, None
        for batch in batches:
            crcs = []
            for path, at, n in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "n_tokens"))):
                if path != opened:
                    if reader:
                        reader.close()
                    reader, opened = SequenceReader(path), path
                crc = 0
                for part in reader.slices(at, n):
                    crc = zlib.crc32(part.astype("<u4"), crc)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "shard", "at", "n_tokens")), pa.array(crcs, pa.int64())], names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])
        if reader:
            reader.close()

    # one row per file: a running sum over the files, of which there are as many as write tasks
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = totals.select("shard", (F.sum("held").over(Window.orderBy("shard")) - F.col("held")).alias("before"))
    ids = index.repartition(tasks(index.sparkSession), "shard").sortWithinPartitions("shard", "at").mapInArrow(
        read, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    return ids.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_file: str, folder: str | None = None, **options) -> DataFrame:
    """Writes the files, then reads each document back from them."""
    return read_token_files(write_token_files(docs, tokenizer_file, folder or fresh_path(docs.sparkSession, "tokens"), **options))
