"""A two-level "seen twice" filter: which keys of a large table may occur more
than once, without shuffling the table.

Each key is hashed to a slot; there are ``SPREAD`` slots for every row, so few
different keys share one.  Level one holds the slots that were seen, level two
those seen again.  Both are built per task and cut into ranges of slots; a
range's parts are merged by one task: a slot of level two in any part, or of
level one in two parts, is in level two of the whole.  Only the parts travel
(gap-coded, some 2 to 6 bytes a row); the rows of keys seen once never do.

Bounds: a task holds at most ``FLUSH_ROWS`` slots (8 bytes each) before it emits
its parts; a merged range holds about ``RANGE_ROWS`` slots, whatever the table's
size, since there are as many ranges as that takes.  Slots are hashes, so ranges
fill evenly, and a hot key adds one slot a part.

No key seen twice is missed.  About one in ``SPREAD`` of the other keys shares a
slot and is in level two too; what reads the filter looks at the keys
themselves.  NULL keys share one slot, as they share one group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SPREAD = 64
FLUSH_ROWS = 4_000_000
RANGE_ROWS = 8_000_000


def slot_bits(n_rows: int, spread: int = SPREAD) -> int:
    return min(62, max(10, math.ceil(math.log2(max(1, n_rows) * spread))))


def slot(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def pack(slots: np.ndarray) -> bytes:
    """Sorted distinct slots as their gaps, in as many bytes each as the widest needs."""
    gaps = np.diff(slots, prepend=0)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(gaps) or int(gaps.max()) < 1 << 8 * w)
    return bytes([width]) + gaps.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64))


def levels(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots, and those that occur again."""
    own, count = np.unique(slots, return_counts=True)
    return own, own[count > 1]


def _parts(slots: np.ndarray, shift: int) -> pa.RecordBatch:
    """The filter of these slots, a row for each range; a range's slots are counted from its start."""
    once, twice = levels(slots)
    ranges = np.unique(once >> shift)
    cut = [[a[np.searchsorted(a, r << shift) : np.searchsorted(a, (r + 1) << shift)] - (r << shift) for r in ranges] for a in (once, twice)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int64()), *[pa.array([pack(a) for a in level], pa.binary()) for level in cut]], names=["range", "once", "twice"])


def merge(parts: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Level two of the whole, from the (once, twice) of its parts."""
    _, again = levels(np.concatenate([unpack(once) for once, _ in parts]))
    return np.unique(np.concatenate([again] + [unpack(twice) for _, twice in parts]))


def seen_twice(keys: DataFrame, bits: int, n_rows: int, range_rows: int = RANGE_ROWS, flush_rows: int = FLUSH_ROWS) -> DataFrame:
    """(slot): the slots of the only column of ``keys`` that were hit more than once."""
    range_bits = min(bits, max(0, math.ceil(math.log2(max(1, n_rows) / range_rows))))
    shift = bits - range_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += batch.num_rows
            if rows >= flush_rows:
                yield _parts(np.concatenate(held), shift)
                held, rows = [], 0
        if rows:
            yield _parts(np.concatenate(held), shift)

    def join(parts: pa.Table) -> pa.Table:
        first = parts.column("range")[0].as_py() << shift
        found = merge(list(zip(parts.column("once").to_pylist(), parts.column("twice").to_pylist())))
        return pa.table({"slot": pa.array(found + first, pa.int64())})

    slots = keys.select(slot(F.col(keys.columns[0]), bits).alias("slot"))
    return slots.mapInArrow(build, "range long, once binary, twice binary").groupBy("range").applyInArrow(join, "slot long")


class PossibleRepeats:
    """Splits rows, map-side, into those whose key may occur again and those whose
    key was seen once.  The slots are written once; beyond ``max_rows`` of them
    (``bounded`` is false) they are not to be broadcast."""

    def __init__(self, rows: DataFrame, key: str, max_rows: int, spread: int = SPREAD):
        self._key = key
        n_rows = rows.count()
        self._bits = slot_bits(n_rows, spread)
        self.slots = cut_lineage(seen_twice(rows.select(key), self._bits, n_rows), "seen-twice")
        self.n_slots = self.slots.count()
        self.bounded = self.n_slots <= max_rows

    def _join(self, rows: DataFrame, how: str) -> DataFrame:
        mark = "_slot"
        slots = self.slots.withColumnRenamed("slot", mark)
        if self.bounded:
            slots = F.broadcast(slots)
        return rows.withColumn(mark, slot(F.col(self._key), self._bits)).join(slots, mark, how).drop(mark)

    def possible(self, rows: DataFrame) -> DataFrame:
        return self._join(rows, "left_semi")

    def single(self, rows: DataFrame) -> DataFrame:
        return self._join(rows, "left_anti")
