"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
import weakref
from contextlib import suppress
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
LOWEST = -(2**63)  # stands for a missing doc_id, which counts as the smallest


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII takes the engine's own lower()."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_MEMOS: list = []
_OWNED: list = []
_SERVED: list = [None]  # the operator that this worker served last


def owned(owner: str) -> dict:
    """A table that a worker keeps between tasks of one operator, and drops when it serves another one."""
    _OWNED.append((owner, {}))
    return _OWNED[-1][1]


def slices(batches, rows: int = 512):
    """The batches in slices of few rows, so that a task turns only few texts into objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release() -> None:
    """Gives freed memory back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library can do it
        ctypes.CDLL(None).malloc_trim(0)


def _weight(x) -> int:
    return sys.getsizeof(x) + (sum(map(_weight, x)) if isinstance(x, tuple) else 0)


class TwoAges(dict):
    """A memo of bounded size for Python workers: a full memo becomes the old age, from which what
    is used again comes back; it holds at most twice ``most`` bytes, but for what one batch
    adds. It belongs to an operator."""

    def __init__(self, most: int, owner: str):
        super().__init__()
        self.most, self.old, self.owner, self.counted, self.held = most, {}, owner, 0, 0
        _MEMOS[:] = [m for m in _MEMOS if m() is not None] + [weakref.ref(self)]

    def missing(self, keys: set) -> set:
        """The keys that neither age holds; those that the old age holds are taken over."""
        old, none = self.old, set()
        for k in keys:
            if k not in self:
                if k in old:
                    self[k] = old[k]
                else:
                    none.add(k)
        return none

    def turn(self) -> None:
        """Call between batches: starts a new age if this one is full."""
        if len(self) > self.counted:  # new entries stand last
            fresh = len(self) - self.counted
            some = [100 + _weight(k) + _weight(v) for k, v in islice(reversed(self.items()), 0, fresh, 16)]  # every 16th is weighed
            self.held += fresh * sum(some) // len(some)
            self.counted = len(self)
        if self.held >= self.most:
            self.old = dict(self)
            self.clear()

    def clear(self) -> None:
        super().clear()
        self.counted = self.held = 0


def hold(owner: str) -> None:
    """Call at the start of every Python task: a worker that served another operator before drops
    that one's memos and gives the freed memory back to the machine."""
    if _SERVED[0] == owner:
        return
    _SERVED[0] = owner
    for ref in _MEMOS:
        memo = ref()
        if memo is not None and memo.owner != owner:
            memo.clear()
            memo.old = {}
    for other, table_ in _OWNED:
        if other != owner:
            table_.clear()
    release()
