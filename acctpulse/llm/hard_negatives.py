"""Hard-negative mining by a vertical scan of the dimensions (BOND).

The vectors are stored column by column: a block holds one array per dimension
and each dimension's least and greatest value.  For an anchor, a block's
dimensions are read in descending magnitude of the anchor's components; partial
scores grow, and the least and greatest that the unread dimensions can still add
bound every row's score.  The candidate bitmap loses all rows whose bounds rule
them out: below the k-th best lower bound when positives are sought, outside all
score windows or below a full window's k-th lower bound when negatives are.  What
is left when all dimensions are read has exact scores.

Anchors are the stated query set; chunks of them meet all blocks, each pair of
chunk and block in a task of its own, and only the best rows of each pair leave
it.  Nothing is broadcast and no pair of rows is emitted that is not a result of
its block.

Scores are exact integer inner products of the components ``floor(256 * x)``.
Defined results: rows with a null label, a null vector or any null or non-finite
component take no part; a null id is no anchor, keeps its label and comes last
among equal scores; equal scores are ordered by id; components beyond +-2^25
after scaling count as that bound, so that scores fit a long; of vectors of
different length the missing components count as 0, so an empty vector scores 0;
repeated rows are rows of their own, but of anchors equal in id, label and vector
one is reported, with the others among its positives; very long vectors make
blocks of fewer rows; an empty table gives no rows; other columns are not read,
so their names cannot clash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acctpulse.llm.common import written

SCALE = 256.0
REACH = 1 << 25  # bound on a scaled component
BLOCK_CELLS = 1 << 20  # components in a block
MAX_PARTITIONS = 20_000  # of the shuffle that deals rows to blocks
CHUNK_ANCHORS = 4096  # anchors that meet a block in one task
STEP = 8  # dimensions read between two looks at the bitmap
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
ANCHOR_EVERY, MOVE_EVERY, LABELS = 100, 7, 10

_BLOCK = "block long, ids array<long>, labels array<int>, low array<int>, high array<int>, columns array<binary>"
_FOUND = "key long, score long, id long"
_MINED = "key long, place int, anchor_id long, positive_id long, positive_score long, score long, id long"


# -- rows and blocks


def participants(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v): the rows that take part, relabelled and scaled to integers."""
    x, key, own = F.col(vector), F.col(vec_id), F.col(label)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    moved = F.when(key % MOVE_EVERY == 0, (own + 1) % LABELS).otherwise(own)
    scaled = F.transform(x, lambda v: F.least(F.greatest(F.floor(F.lit(SCALE) * v.cast("double")), F.lit(-REACH)), F.lit(REACH)).cast("int"))
    return rows.filter(own.isNotNull() & x.isNotNull() & finite).select(key.cast("long").alias("id"), moved.cast("int").alias("label"), scaled.alias("v"))


def _matrix(v: pa.Array, dims: int) -> np.ndarray:
    """The lists as rows, short ones filled with zeros."""
    size = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == len(size) * dims:
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int32)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _block(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    v = table.column("v").combine_chunks()
    columns = np.ascontiguousarray(_matrix(v, int(np.diff(v.offsets.to_numpy()).max())).T)
    row = {
        "block": [number], "ids": [table.column("id").to_pylist()], "labels": [table.column("label").to_pylist()],
        "low": [columns.min(axis=1).tolist()], "high": [columns.max(axis=1).tolist()], "columns": [[c.tobytes() for c in columns]],
    }
    types = {"block": pa.int64(), "ids": pa.list_(pa.int64()), "labels": pa.list_(pa.int32()), "low": pa.list_(pa.int32()), "high": pa.list_(pa.int32()), "columns": pa.list_(pa.binary())}
    return pa.RecordBatch.from_arrays([pa.array(row[n], t) for n, t in types.items()], names=list(types))


def column_blocks(rows: DataFrame, block_cells: int = BLOCK_CELLS) -> tuple[DataFrame, int]:
    """The rows in blocks of columns, and how many block numbers there are."""
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    limit = max(256, block_cells // max(dims, 1))
    wanted = max(1, -(-n // limit))
    partitions = min(wanted, MAX_PARTITIONS)
    each = -(-wanted // partitions)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * each
        last, held, size = number + each - 1, [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch if number == last else batch.slice(0, limit - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if number < last and size == limit:
                    yield _block(number, held)
                    number, held, size = number + 1, [], 0
        if size:
            yield _block(number, held)

    return written(rows.repartition(partitions).mapInArrow(pack, _BLOCK), "vector-blocks"), partitions * each


# -- the scan of one block


class Block:
    """A block's columns, and its rows by label."""

    def __init__(self, row: dict):
        self.columns = [np.frombuffer(c, np.int32) for c in row["columns"]]
        self.low, self.high = np.array(row["low"], np.int64), np.array(row["high"], np.int64)
        self.reach = np.maximum(np.abs(self.low), np.abs(self.high))
        self.labels = np.array(row["labels"])
        self.null = np.array([i is None for i in row["ids"]])
        self.ids = np.array([i or 0 for i in row["ids"]], np.int64)
        self._same: dict[int, np.ndarray] = {}
        self._other: dict[int, np.ndarray] = {}

    def of_label(self, label: int) -> np.ndarray:
        if label not in self._same:
            self._same[label] = np.flatnonzero(self.labels == label)
        return self._same[label]

    def of_others(self, label: int) -> np.ndarray:
        if label not in self._other:
            self._other[label] = np.flatnonzero(self.labels != label)
        return self._other[label]

    def scan(self, q: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """The rows that ``keep(partial scores, least rest, greatest rest)`` leaves
        when all dimensions are read, and their exact scores."""
        q = q[: len(self.columns)]
        order = np.argsort(-np.abs(q), kind="stable")[: np.count_nonzero(q)]
        ends = np.stack([q[order] * self.low[order], q[order] * self.high[order]])
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        kind = np.int32 if int(np.abs(q) @ self.reach[: len(q)]) < 1 << 31 else np.int64
        score = np.zeros(len(rows), kind)
        for at in range(0, len(order), STEP):
            for d in order[at : at + STEP]:
                column = self.columns[d]
                score += kind(q[d]) * (column if len(rows) == len(column) else column[rows])
            done = min(at + STEP, len(order))
            bitmap = keep(score, int(least[done]), int(most[done]))
            if not bitmap.all():
                rows, score = rows[bitmap], score[bitmap]
            if not len(rows):
                break
        return rows, score.astype(np.int64)

    def first(self, rows: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int | None]]:
        """(score, id) of the first k, higher scores and smaller ids before."""
        if len(rows) > k:  # only ties of the k-th need the sort
            near = score >= np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[near], score[near]
        order = np.lexsort((self.ids[rows], self.null[rows], -score))[:k]
        return [(int(score[i]), None if self.null[rows[i]] else int(self.ids[rows[i]])) for i in order]


def _kth(score: np.ndarray, k: int) -> int | None:
    return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else None


def best_of_label(block: Block, q: np.ndarray, label: int, k: int) -> list[tuple[int, int | None]]:
    """The block's k best rows of the label."""

    def keep(score, least, most):
        kth = _kth(score, k)
        return np.ones(len(score), bool) if kth is None else score >= kth + least - most

    return block.first(*block.scan(q, block.of_label(label), keep), k)


def best_in_windows(block: Block, q: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int | None]]]:
    """For each score window, the block's k best rows of other labels in it."""

    def keep(score, least, most):
        bitmap = np.zeros(len(score), bool)
        for low, high in windows:
            surely = score[(score >= low - least) & (score <= high - most)]
            kth = _kth(surely, k)
            floor = low if kth is None else max(low, kth + least)
            bitmap |= (score >= floor - most) & (score <= high - least)
        return bitmap

    rows, score = block.scan(q, block.of_others(label), keep)
    out = []
    for low, high in windows:
        inside = (score >= low) & (score <= high)
        out.append(block.first(rows[inside], score[inside], k))
    return out


# -- chunks of anchors against all blocks


def _columns(rows: list[tuple], schema: str) -> pa.Table:
    names, types = zip(*(field.strip().split(" ") for field in schema.split(",")))
    own = {"long": pa.int64(), "int": pa.int32()}
    cells = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, own[t]) for c, t in zip(cells, types)], names=list(names))


def _meet(blocks: DataFrame, n_blocks: int, anchors: DataFrame, n_chunks: int, search, schema: str) -> DataFrame:
    """``search(block, anchor row)`` for every block and anchor, each pair of block and chunk by itself."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            block = Block(left.to_pylist()[0])
            for anchor in right.to_pylist():
                found += search(block, anchor)
        return _columns(found, schema)

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = blocks.withColumn("chunk", every(n_chunks)).groupBy("block", "chunk")
    right = anchors.withColumn("block", every(n_blocks)).groupBy("block", "chunk")
    return left.cogroup(right).applyInArrow(run, schema)


def window(positive_score: int) -> tuple[int, int]:
    """The least and greatest negative score for a positive's score."""
    return -(-LOW_PERCENT * positive_score // 100), HIGH_PERCENT * positive_score // 100


def _score(v: Column) -> Column:
    return F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))


def mine(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", block_cells: int = BLOCK_CELLS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = participants(embeddings, vec_id, vector, label)
    blocks, n_blocks = column_blocks(rows, block_cells)
    asked = rows.filter(F.col("id") % ANCHOR_EVERY == 0).distinct()
    asked = written(asked, "anchors")
    n_chunks = max(1, -(-asked.count() // chunk_anchors))
    asked = asked.repartition(n_chunks).select(F.monotonically_increasing_id().alias("key"), F.spark_partition_id().cast("long").alias("chunk"), "id", "label", "v")
    asked = written(asked, "anchor-chunks")

    def positives(block: Block, anchor: dict) -> list[tuple]:
        best = best_of_label(block, np.array(anchor["v"], np.int64), anchor["label"], POSITIVES + 1)
        return [(anchor["key"], score, own) for score, own in best]

    found = _meet(blocks, n_blocks, asked, n_chunks, positives, _FOUND)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = found.withColumn("place", F.row_number().over(W.partitionBy("key").orderBy(*order))).filter(F.col("place") <= POSITIVES + 1)
    listed = found.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "score", "id"))), lambda p: F.struct(p["score"].alias("score"), p["id"].alias("id"))).alias("best"))
    # the anchor's own row is one of the rows with its id and its own score; equal ones are alike in the result
    joined = asked.join(listed, "key")
    own = F.coalesce(F.array_position("best", F.struct(_score(F.col("v")).alias("score"), F.col("id").alias("id"))), F.lit(0))
    others = F.filter("best", lambda p, i: i + 1 != own)
    asked = written(joined.select("key", "chunk", "id", "label", "v", F.slice(others, 1, POSITIVES).alias("positives")).filter(F.size("positives") > 0), "anchor-positives")

    def negatives(block: Block, anchor: dict) -> list[tuple]:
        held = [(j, p, window(p["score"])) for j, p in enumerate(anchor["positives"]) if p["score"] >= 0]  # below 0 no window is open
        best = best_in_windows(block, np.array(anchor["v"], np.int64), anchor["label"], [w for *_, w in held], NEGATIVES) if held else []
        return [(anchor["key"], j, anchor["id"], p["id"], p["score"], score, own) for (j, p, _), rows in zip(held, best) for score, own in rows]

    mined = _meet(blocks, n_blocks, asked, n_chunks, negatives, _MINED)
    rank = F.row_number().over(W.partitionBy("key", "place").orderBy(*order))
    return (
        mined.withColumn("rank", rank)
        .filter(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, a.label AS anchor_label, b.k AS bk, b.vec_id AS id, b.label AS label,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.k <> b.k
), positives AS (
  SELECT ak, anchor_id, anchor_label, bk, id AS positive_id, score AS positive_score
  FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.ak, p.bk ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.ak = p.ak
WHERE s.label <> p.anchor_label AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.ak, p.bk ORDER BY s.score DESC, s.id) <= 10
"""
