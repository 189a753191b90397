"""Conversation structure repair: the cheapest edits by block tables of cost vectors.

A row is a symbol, the dialogue grammar ``(s?(ua)+)?`` an automaton of four states. From the end of
a conversation to its start, a cost vector holds for each state the cheapest way to finish from
there. Vectors less their minimum are few, so every block of symbols is a table from vectors to
vectors and costs; blocks are looked up. A second walk from the start opens one block at a
time, backward, and takes the first of the cheapest edits.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import hold, tasks
from tillage.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 4  # symbols of a table entry
PIECE_BYTES = 4 << 20  # a longer conversation is several rows
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
NONE, BLANK, DUPLICATE, CUT = range(4)  # faults
GONE, FILLER = 8, 9  # symbols besides class + 4 * truncated: to be deleted; no row
CLASSES = "sua"  # of role initials; 3 is any other
# states: 0 nothing yet, 1 after s, 2 after u, 3 after a
_NEXT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_GIVEN = [2, 2, 3, 2]  # the state after a user or assistant turn, whichever fits
_NAMES = ["", "", "user", "assistant"]  # the role that leads to a state


def _inserts(costs: list[int]) -> list[int]:
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[_GIVEN[q]]) for q, c in enumerate(costs)]
    return costs


def _before(symbol: int, after: tuple) -> list[int]:
    """The costs before a row from those after it."""
    if symbol == FILLER:
        return list(after)
    kind, extra = symbol % 4, TRUNCATED * (symbol // 4 == 1)
    out = []
    for q in range(4):
        ways = [DELETE + after[q]]
        if symbol != GONE:
            ways.append(REROLE + extra + after[_GIVEN[q]])
            if (q, kind) in _NEXT:
                ways.append(KEEP + extra + after[_NEXT[q, kind]])
        out.append(min(ways))
    return _inserts(out)


class Tables:
    """Normalised vectors, and for every symbol and every block where a vector leads and at what cost."""

    def __init__(self):
        far = 1 << 20
        end = tuple(_inserts([0, far, far, 0]))
        self.vectors, index, rows = [end], {end: 0}, []
        for vector in self.vectors:  # grows while it runs; differences are bounded, so it ends
            row = []
            for symbol in range(10):
                made = _before(symbol, vector)
                low = min(made)
                key = tuple(c - low for c in made)
                if key not in index:
                    index[key] = len(self.vectors)
                    self.vectors.append(key)
                row.append((index[key], low))
            rows.append(row)
        one = np.array(rows)
        self.to, self.cost = one[:, :, 0], one[:, :, 1]
        to, cost = self.to, self.cost
        for _ in range(BLOCK - 1):  # a symbol before each block so far
            cost = (self.cost[to].transpose(0, 2, 1) + cost[:, None, :]).reshape(len(rows), -1)
            to = self.to[to].transpose(0, 2, 1).reshape(len(rows), -1)
        self.block_to, self.block_cost = to, cost
        self.step_to, self.step_cost = self.to.tolist(), self.cost.tolist()

    @staticmethod
    def blocks(symbols: bytes) -> np.ndarray:
        """Codes of the blocks, filled up in front."""
        held = np.frombuffer(symbols, np.uint8)
        held = np.concatenate([np.full(-len(held) % BLOCK, FILLER, np.uint8), held]).reshape(-1, BLOCK)
        return held.astype(np.int64) @ 10 ** np.arange(BLOCK - 1, -1, -1)

    def through(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of every vector after the symbols: the vector before them, and the cost."""
        at, paid = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in self.blocks(symbols)[::-1].tolist():
            paid = paid + self.block_cost[at, code]
            at = self.block_to[at, code]
        return at, paid

    def trace(self, symbols: bytes, end: int, state: int, last: bool) -> tuple[str, int, int]:
        """The first in ASCII order of the cheapest edits from ``state``, the state after them, and
        the vector before the symbols. ``last``: nothing follows, so open turns are closed."""
        codes = self.blocks(symbols)
        ends = [end]
        for code in codes[::-1].tolist():
            ends.append(int(self.block_to[ends[-1], code]))
        start = ends.pop()
        filled = bytes([FILLER]) * (-len(symbols) % BLOCK) + symbols
        out = []
        for b in range(len(codes)):
            part = filled[b * BLOCK : (b + 1) * BLOCK]
            inner, low = [ends[len(codes) - 1 - b]], []
            for symbol in part[::-1]:  # the block from its end
                low.append(self.step_cost[inner[-1]][symbol])
                inner.append(self.step_to[inner[-1]][symbol])
            for i, symbol in enumerate(part):
                if symbol == FILLER:
                    continue
                here, after, least = self.vectors[inner[BLOCK - i]], self.vectors[inner[BLOCK - i - 1]], low[BLOCK - 1 - i]
                kind, extra = symbol % 4, TRUNCATED * (symbol // 4 == 1)
                while here[state] + least != DELETE + after[state] and here[state] == INSERT + here[_GIVEN[state]]:
                    out.append("I")
                    state = _GIVEN[state]
                goal = here[state] + least
                if goal == DELETE + after[state]:
                    out.append("D")
                elif symbol != GONE and (state, kind) in _NEXT and goal == KEEP + extra + after[_NEXT[state, kind]]:
                    out.append("K")
                    state = _NEXT[state, kind]
                else:
                    out.append("R")
                    state = _GIVEN[state]
        while last and state not in (0, 3):
            out.append("I")
            state = _GIVEN[state]
        return "".join(out), state, start


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


@lru_cache(maxsize=20_000)
def _short(symbols: bytes) -> str:
    return tables().trace(symbols, 0, 0, True)[0]


def _whole(symbols: bytes) -> str:
    """Edits of a whole conversation; equal short shapes are solved once."""
    return _short(symbols) if len(symbols) <= 64 else tables().trace(symbols, 0, 0, True)[0]


def _cost(symbols: bytes, audit: str) -> int:
    """What the edits cost."""
    total, at = 0, 0
    for e in audit:
        if e == "I":
            total += INSERT
            continue
        symbol = symbols[at]
        at += 1
        total += DELETE if e == "D" else (REROLE if e == "R" else KEEP) + TRUNCATED * (symbol // 4 == 1)
    return total


def fault_of(text: str) -> int:
    bare = text.rstrip(BLANKS)
    return BLANK if not bare else NONE if bare[-1] in ".!?" else CUT


def _symbols(roles: list[str], faults: bytes) -> bytes:
    kinds = [CLASSES.find(r[:1]) if r else 3 for r in roles]
    return bytes(GONE if f in (BLANK, DUPLICATE) else (3 if k < 0 else k) + 4 * (f == CUT) for k, f in zip(kinds, faults))


def _repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The lines that the edits leave."""
    out, at = [], 0
    for e in audit:
        if e == "I":
            state = _GIVEN[state]
            out.append(f"{_NAMES[state]}:")
            continue
        role, text = roles[at], texts[at]
        at += 1
        if e == "K":
            state = _NEXT[state, CLASSES.index(role[0])]
            out.append(f"{role}:{text}")
        elif e == "R":
            state = _GIVEN[state]
            out.append(f"{_NAMES[state]}:{text}")
    return out


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped, with the faults of the contract of operator 13 put in
    by the checksum of ``conv_id:turn``; nulls in role, text and checksum are one space."""
    gap = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), gap), F.lit(":"), F.coalesce(F.col("turn").cast("string"), gap))) % 20
    text, role = F.coalesce("text", gap), F.coalesce("role", gap)
    made = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (code == 0).alias("dropped"), F.when(code == 3, 2).otherwise(1).alias("copies"))
    return made.select("conv_id", "turn", "role", "text", "dropped", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def _pieces(rows: DataFrame) -> DataFrame:
    """The rows in order, packed: conv_id, seq (place among all pieces), turns, roles, texts, faults.
    A conversation is one row unless a range of keys ends in it or it is over PIECE_BYTES."""

    def pack(batches):
        hold("conversations")
        part, made = TaskContext.get().partitionId(), 0
        names = ["conv_id", "seq", "turns", "roles", "texts", "faults"]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary()]
        full, key, held = [], None, 0
        turns, roles, texts, faults, seen = [], [], [], [], set()

        def close():
            nonlocal turns, roles, texts, faults, seen, held, made
            full.append((key[0], (part << 32) + made, turns, roles, texts, bytes(faults)))
            made += 1
            turns, roles, texts, faults, seen, held = [], [], [], [], set(), 0

        def batch_of():
            out = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*full), kinds)], names=names)
            full.clear()
            return out

        size = 0
        for batch in batches:
            for conv, turn, role, text, dropped in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped"))):
                if key is not None and (key[0] != conv or held > PIECE_BYTES):
                    size += held
                    close()
                    if size > PIECE_BYTES or len(full) >= 4096:
                        yield batch_of()
                        size = 0
                key = (conv,)
                if dropped:
                    continue
                fault = fault_of(text)
                mark = hashlib.blake2b(f"{len(role)} {role}{text}".encode(), digest_size=16).digest()
                if fault != BLANK:
                    fault = DUPLICATE if mark in seen else fault
                    seen.add(mark)
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                faults.append(fault)
                held += len(text) + len(role) + 16
        if key is not None:
            close()
            yield batch_of()

    spark = rows.sparkSession
    # equal rows can be anywhere among themselves, so the last key may split them
    order = ["conv_id", "turn", "role", F.xxhash64("text"), "text_key"]
    keyed = rows.withColumn("text_key", F.monotonically_increasing_id() % 1024)
    dealt = keyed.repartitionByRange(tasks(spark), *order).sortWithinPartitions("conv_id", "turn", "role", F.xxhash64("text"), "text")
    packed = dealt.select("conv_id", "turn", "role", "text", "dropped").mapInArrow(
        pack, "conv_id long, seq long, turns array<long>, roles array<string>, texts array<string>, faults binary")
    return materialize(packed, "conversation-pieces")


def _initials(roles: list[str]) -> list[str]:
    return [r[:1] for r in roles]


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


_SUMS = "conv_id long, seq long, n long, low long, high long, first_turn long, last_turn long, different long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, body binary"

_SUM_NAMES = [x.split()[0] for x in _SUMS.split(",")]


def _summed(row: dict, audit: str, state: int) -> tuple:
    """What a piece adds to its conversation."""
    turns, roles, faults = row["turns"], row["roles"], row["faults"]
    real = [t for t in turns if t is not None]  # sorted
    initials = _initials(roles)
    body = "".join(x + "\n" for x in _repaired(audit, state, roles, row["texts"])).encode()
    return (row["conv_id"], row["seq"], len(turns), real[0] if real else None, real[-1] if real else None, real[0] if real else None, real[-1] if real else None,
            len(set(real)), faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), _illegal(initials), initials[0] if initials else None, initials[-1] if initials else None,
            _cost(_symbols(roles, faults), audit), audit, body)


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string, repaired_sha256 string"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.strip().split(" ") for x in schema.split(",")]
    cells = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cells, fields)], names=[n for n, _ in fields])


def _finish(conv, parts, texts: bool) -> tuple:
    """The row of a conversation from its pieces in order."""
    low = high = turn = last = None
    different = blank = duplicate = truncated = illegal = cost = 0
    audit, kept, digest, open_ = [], [], hashlib.sha256(), False
    for p in parts:
        if p["low"] is not None:
            low = p["low"] if low is None else low
            different += p["different"] - (p["first_turn"] == turn)
            high = turn = p["last_turn"]
        if p["n"]:
            illegal += p["illegal"] + (last is not None and last + p["first"] not in ("su", "ua", "au"))
            last = p["last"]
        blank, duplicate, truncated, cost = blank + p["blank"], duplicate + p["duplicate"], truncated + p["truncated"], cost + p["cost"]
        audit.append(p["audit"])
        if p["body"]:
            body = memoryview(p["body"])[:-1]
            if open_:
                digest.update(b"\n")
            digest.update(body)
            if texts:
                kept.append(bytes(body).decode())
            open_ = True
    gaps = 0 if low is None else high - low + 1 - different
    return conv, gaps, blank, duplicate, truncated, illegal, cost, "".join(audit), "\n".join(kept) if texts else None, digest.hexdigest()


def repair_conversations(rows: DataFrame, texts: bool = True) -> DataFrame:
    """One row per conv_id: gaps (missing turns), blank, duplicate, truncated (rows by their first
    fault), illegal (neighbouring role initials other than su, ua, au), cost, audit (K, R, D, I:
    the cheapest edits, of equals the first in ASCII order), repaired (lines ``role:text``; null
    without ``texts``) and repaired_sha256.

    ``rows`` has conv_id, turn, role, text and, if there, dropped: such a row only says that its
    conversation exists. Rows are taken by turn, nulls first; rows of one turn by role, then by
    the hash of their text. A row is blank without a visible character, a duplicate if role and
    text came before, truncated if its last visible character is not one of ``.!?``. Keeping costs
    0, another role 2, deleting 3 (a must for blank and duplicate rows), an inserted empty turn
    2; a truncated row that stays 1 more.

    A null role or text counts as one space; rows without conv_id are one conversation; a
    conversation without rows has zeros and empty strings; repeated rows are duplicates; other
    columns are ignored; an empty table gives an empty result.

    The rows are sorted by range, so a conversation may be spread over any number of tasks: its
    pieces become tables from cost vectors to cost vectors, which are put together, and each
    piece is then traced by itself. Only the digest of a long conversation runs through one
    task, piece by piece, since it hashes a text as a whole.
    """
    gap = F.lit(" ")
    dropped = F.coalesce(F.col("dropped").cast("boolean"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    pieces = _pieces(rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", gap).alias("role"), F.coalesce("text", gap).alias("text"), dropped.alias("dropped")))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    keyed = pieces.withColumn("conv", key)
    # as many as there are key ranges and overlong pieces
    parts = materialize(keyed.groupBy("conv").agg(F.count("*").alias("parts"), F.max("seq").alias("end")).where("parts > 1").select("conv", "end"), "long-conversations")

    def solve(batches):
        hold("conversations")
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                audit = _whole(_symbols(row["roles"], row["faults"]))
                piece = dict(zip(_SUM_NAMES, _summed(row, audit, 0)))
                out.append(_finish(row["conv_id"], [piece], texts))
            yield _table(out, _RESULT)

    whole = keyed.join(parts, "conv", "left_anti").drop("conv").mapInArrow(solve, _RESULT)
    if parts.isEmpty():
        return whole
    return whole.unionAll(_long(keyed.join(parts, "conv"), texts))


def _long(pieces: DataFrame, texts: bool) -> DataFrame:
    """The rows of conversations of several pieces."""
    spark = pieces.sparkSession

    # a row is a duplicate if an earlier piece has its like
    def marks(batches):
        hold("conversations")
        for batch in batches:
            for row in batch.to_pylist():
                found = {}
                for i, (role, text, f) in enumerate(zip(row["roles"], row["texts"], row["faults"])):
                    if f not in (BLANK, DUPLICATE):
                        found[hashlib.blake2b(f"{len(role)} {role}{text}".encode(), digest_size=16).digest()] = i
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([row["conv"]] * n, pa.string()), pa.array([row["seq"]] * n, pa.int64()), pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int32())],
                                                 names=["conv", "seq", "mark", "at"])

    marked = materialize(pieces.mapInArrow(marks, "conv string, seq long, mark binary, at int"), "row-marks")
    first = marked.groupBy("conv", "mark").agg(F.min("seq").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    again = marked.join(first, ["conv", "mark"]).where("seq > first").groupBy("conv", "seq").agg(F.collect_list("at").alias("again"))

    def mend(batches):
        hold("conversations")
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                faults = bytearray(r["faults"])
                for i in r["again"] or ():
                    faults[i] = DUPLICATE
                r["faults"] = bytes(faults)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "conv_id", "seq", "turns", "roles", "texts")), pa.array([r["faults"] for r in rows], pa.binary()), batch.column("end")],
                                             names=["conv", "conv_id", "seq", "turns", "roles", "texts", "faults", "end"])

    shape = "conv string, conv_id long, seq long, turns array<long>, roles array<string>, texts array<string>, faults binary, end long"
    pieces = materialize(
        pieces.join(again, ["conv", "seq"], "left").select("conv", "conv_id", "seq", "turns", "roles", "texts", "faults", "end", "again").mapInArrow(mend, shape), "mended-pieces")

    def through(batches):
        hold("conversations")
        for batch in batches:
            got = [tables().through(_symbols(r["roles"], r["faults"]))[0].astype(np.uint16).tobytes() for r in batch.select(["roles", "faults"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seq"), pa.array(got, pa.binary())], names=["conv", "seq", "table"])

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", ascending=False)
        at, out = 0, []
        for table in pdf["table"]:
            out.append(at)
            at = int(np.frombuffer(table, np.uint16)[at])
        return pd.DataFrame({"conv": pdf["conv"], "seq": pdf["seq"], "vector": out})

    # a row of some hundred bytes per piece: what a group holds does not grow with the texts
    told = pieces.mapInArrow(through, "conv string, seq long, table binary").groupBy("conv").applyInPandas(ends, "conv string, seq long, vector int")
    bounded = materialize(pieces.join(told, ["conv", "seq"]), "bounded-pieces")

    def leads(batches):
        hold("conversations")
        for batch in batches:
            got = []
            for r in batch.select(["roles", "faults", "vector", "seq", "end"]).to_pylist():
                symbols = _symbols(r["roles"], r["faults"])
                got.append([tables().trace(symbols, r["vector"], q, r["seq"] == r["end"])[1] for q in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seq"), pa.array(got, pa.list_(pa.int32()))], names=["conv", "seq", "leads"])

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        state, out = 0, []
        for to in pdf["leads"]:
            out.append(state)
            state = int(to[state])
        return pd.DataFrame({"conv": pdf["conv"], "seq": pdf["seq"], "state": out})

    begun = bounded.mapInArrow(leads, "conv string, seq long, leads array<int>").groupBy("conv").applyInPandas(starts, "conv string, seq long, state int")

    def solve(batches):
        hold("conversations")
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = tables().trace(_symbols(r["roles"], r["faults"]), r["vector"], r["state"], r["seq"] == r["end"])[0]
                out.append(_summed(r, audit, r["state"]))
            yield _table(out, _SUMS)

    solved = materialize(bounded.join(begun, ["conv", "seq"]).mapInArrow(solve, _SUMS), "solved-pieces")

    def gather(batches):
        hold("conversations")

        def rows():
            for batch in batches:
                for at in range(batch.num_rows):  # one piece in memory
                    yield batch.slice(at, 1).to_pylist()[0]

        waiting = rows()
        row = next(waiting, None)
        while row is not None:
            conv, more = row["conv_id"], [row]

            def same():
                while more[0] is not None and more[0]["conv_id"] == conv:
                    yield more[0]
                    more[0] = next(waiting, None)

            done = _finish(conv, same(), texts)
            row = more[0]
            yield _table([done], _RESULT)

    return solved.repartition(tasks(spark), "conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(gather, _RESULT)
