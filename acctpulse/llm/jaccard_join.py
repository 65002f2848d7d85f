"""N-gram Jaccard self-join by chosen paths.

Documents are sets of word shingles (see ``common``); two are linked if their
Jaccard similarity is at least ``threshold``.  Documents with equal sets form a
class, and only one set per class is joined.

Each run starts a path per class and extends it, level by level, by those of
the set's shingles whose hash with the path falls below branching / (threshold
* set size): similar sets keep shared paths, others lose them.  A bucket (the
classes on one path) of at most ``LEAF`` classes is compared by brute force
(deeper levels allow up to ``MAX_LEAF``: few rows get there, and the work stays
in proportion to them); a larger one is split on, unless its mean similarity (estimated from the minhashes
of all its members) is ``DENSE`` or more: then most of it is one group of near
copies, which splitting would carry along for ever.  Such buckets are merged
where they overlap and compared block by block: no size is capped, dropped or
sampled.  Below ``DENSE`` a pair of members shares less than one path of the next
level on average, so that splitting ends, whatever the buckets' sizes; what were
still large at ``MAX_DEPTH`` would be compared block by block too.  ``runs``
follows from the target recall for pairs exactly at the threshold that share
paths at every depth; every found pair is verified on the exact sets.

Before sets are shipped, the members of a small bucket compare their minhashes:
one that agrees with no other in ``AGREE`` of ``SKETCH`` values leaves the bucket
(a pair at the threshold is missed so with a probability below 1e-5).

Within a bucket the comparison emits, for each class, the number of linked
documents and an edge to the smallest member it is connected with, never the
pairs.  A pair that meets in several buckets is counted in the first one only.

Result per document: doc_id, class_id (the smallest doc_id of its connected
group) and n_links (other documents at or above the threshold, exact copies
included).  Defined results: a text without words links to nothing; rows with a
null doc_id are joined and counted like any other, and class_id is null if no row
of the group has an id; rows that repeat a doc_id each count as a document; an empty table gives no rows.

Class keys are 64 bits of a set's digest: expected false merges stay below one
up to about 6e9 distinct texts."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse.llm.common import fresh, list_column, mix, shingle_sets, text_chunks, written

THRESHOLD = 0.8
TARGET_RECALL = 0.995
BRANCHING = 1.5  # expected shared children per level of a pair at the threshold
MAX_DEPTH = 40  # not reached by splitting that halves the pairs; an end for any input
LEAF = 128  # of the first level; twice as many at each further one
MAX_LEAF = 1024
BLOCK_SETS = 2048
BLOCK_SHINGLES = 2_000_000
DENSE = 0.35  # mean similarity from which a large bucket is compared at once; pairs die out below 0.42
SKETCH = 16
SIGNS = 2  # signs of each minhash in the estimate
AGREE = 5
BROADCAST_IDS = 500_000
TASK_ROWS = 20_000  # counted rows that a task of a small table gets at least
LEAST_TASKS = 8
SLICE = 4096


def runs_needed(recall: float = TARGET_RECALL, branching: float = BRANCHING, depth: int = MAX_DEPTH) -> int:
    """Runs until a pair at the threshold meets in a full-depth bucket with
    probability ``recall``: its shared paths are a Poisson branching process."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-branching * alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def _limit(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Largest hash that is chosen, for sets of these sizes."""
    share = np.minimum(1.0, BRANCHING / (threshold * np.maximum(sizes, 1)))
    return np.where(share >= 1, np.uint64(2**64 - 1), (share * 2.0**63).astype(np.uint64) * np.uint64(2))


def _signed(column: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(column).view(np.int64))


def row_key() -> Column:
    """64 bits of id and text: tells rows that repeat a doc_id apart."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def sketches(docs: DataFrame, threshold: float, runs: int) -> DataFrame:
    """doc_id, row key, class key k, set size n, the first level's paths of all runs, and minhashes."""
    seeds, hash_seeds = _seeds(runs, 1), _seeds(SKETCH, 2)

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                sets = shingle_sets(data, offsets)
                size = np.array([len(s) for s in sets])
                start = np.concatenate(([0], np.cumsum(size)))
                flat = np.concatenate(sets)
                limit = np.repeat(_limit(size, threshold), size)
                owner = np.repeat(np.arange(len(sets)), size)
                chosen, whose = [], []
                for seed in seeds:
                    h = mix(flat ^ seed)
                    hit = np.flatnonzero(h <= limit)
                    chosen.append(h[hit])
                    whose.append(owner[hit])
                whose, chosen = np.concatenate(whose), np.concatenate(chosen)
                order = np.argsort(whose, kind="stable")
                cut = np.searchsorted(whose[order], np.arange(len(sets) + 1))
                paths = [chosen[order[a:b]] for a, b in zip(cut[:-1], cut[1:])]
                low = np.zeros((len(sets), SKETCH), np.int64)
                full = np.flatnonzero(size)
                if len(full):
                    for j, seed in enumerate(hash_seeds):
                        low[full, j] = (np.minimum.reduceat(mix(flat ^ seed), start[full]) >> np.uint64(32)).astype(np.int64)
                keys = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), batch.column(2).slice(first, len(sets)), pa.array(keys, pa.int64()), pa.array(size, pa.int64()), list_column(paths), list_column(list(low))],
                    names=["doc_id", "row", "k", "n", "paths", "low"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("row")).mapInArrow(run, "doc_id long, row long, k long, n long, paths array<long>, low array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """k and the sorted shingles of each row's text, from the columns k and text;
    a row whose text has another key is left out."""

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                sets = shingle_sets(data, offsets)
                key = batch.column(0).slice(first, len(sets)).to_numpy(zero_copy_only=False)
                own = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
                at = [i for i, k in enumerate(own) if k == key[i]]
                yield pa.RecordBatch.from_arrays([pa.array(key[at], pa.int64()), list_column([sets[i] for i in at])], names=["k", "shingles"])

    return texts.mapInArrow(run, "k long, shingles array<long>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.to_numpy()[offsets[0] : offsets[-1]]


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """(path, k) of the next level from rows (k, paths, shingles)."""

    def run(batches):
        for batch in batches:
            po, paths = _lists(batch.column(1))
            so, shingles = _lists(batch.column(2))
            shingles, limit = shingles.view(np.uint64), _limit(np.diff(so), threshold)
            keys, out, who = batch.column(0).to_numpy(), [], []
            for i in range(len(keys)):
                own = shingles[so[i] : so[i + 1]]
                for seed in mix(paths[po[i] : po[i + 1]].view(np.uint64)):
                    h = mix(own ^ seed)
                    h = h[h <= limit[i]]
                    out.append(h)
                    who.append(np.full(len(h), keys[i]))
            if out:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(out)), pa.array(np.concatenate(who).astype(np.int64))], names=["path", "k"])

    return rows.select("k", "paths", "shingles").mapInArrow(run, "path long, k long")


def _buckets(members: DataFrame, name: str) -> DataFrame:
    """(path, k, size) of the paths that two or more classes share."""
    members = written(members, f"{name}-members")
    size = written(_packed(members.groupBy("path").agg(F.count(F.lit(1)).alias("size")), members.count()).filter("size > 1"), f"{name}-sizes")
    if size.count() <= BROADCAST_IDS:
        return written(members.join(F.broadcast(size), "path"), name)
    # the sizes of hot paths go to their members; only the others meet by a shuffle
    hot = size.filter(F.col("size") > LEAF)
    n_hot = hot.count()
    if 0 < n_hot <= BROADCAST_IDS:
        hot = F.broadcast(hot)
        rest = members.join(hot.select("path"), "path", "left_anti").join(size.filter(F.col("size") <= LEAF), "path")
        return written(members.join(hot, "path").union(rest), name)
    return written(members.join(size, "path"), name)


def _few(df: DataFrame, rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Broadcast if its rows (counted, or known to be ``rows`` at most) are within the bound."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= (BROADCAST_IDS if bound is None else bound) else df


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows in no more tasks than they are worth; a large table keeps its partitions."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def _marks(low: DataFrame, rows: int) -> DataFrame:
    """The minhashes of ``rows`` classes, broadcast while they are as large as BROADCAST_IDS rows of two values."""
    return _few(low, rows, BROADCAST_IDS // (SKETCH // 2))


def _dense(large: DataFrame, low: DataFrame) -> DataFrame:
    """Paths of the large buckets whose members' mean similarity is DENSE or more.
    Each minhash gives a member SIGNS random signs; the square of their sum over a
    bucket is, in expectation, the number of its pairs (each way, and each member
    with itself) that agree in the minhash.  So one sum a path and sign, taken over
    all members and combined before the shuffle, tells the mean similarity to some
    25 % (it only decides how a bucket is compared)."""
    signs = [f"(shiftright(low[{j}], {b}) & 1) * 2 - 1" for j in range(SKETCH) for b in range(SIGNS)]
    sums = large.join(low, "k").groupBy("path", "size").agg(*[F.expr(f"sum({s}) AS s{i}") for i, s in enumerate(signs)])
    agreeing = " + ".join(f"CAST(s{i} AS double) * s{i}" for i in range(len(signs)))
    return sums.filter(f"({agreeing}) / {len(signs)} - size >= {DENSE}D * size * (size - 1D)").select("path")


def _shared(rows_a: list[np.ndarray], rows_b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b (or of a), by dense
    slices of the incidence matrices over the values that occur more than once."""
    rows = [*rows_a, *(rows_b or [])]
    n_a, n = len(rows_a), len(rows)
    flat = np.concatenate(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    col = np.cumsum(new) - 1
    often = np.bincount(col)[col] > 1 if len(flat) else np.zeros(0, bool)
    row, col = row[often], col[often]
    if len(col):
        col = np.cumsum(np.concatenate(([0], (col[1:] != col[:-1]).astype(np.int64))))
    out = np.zeros((n_a, n_a if rows_b is None else n - n_a), np.float32)
    cuts = np.searchsorted(col, np.arange(0, (col[-1] if len(col) else 0) + SLICE + 1, SLICE))
    for s, (p, q) in enumerate(zip(cuts[:-1], cuts[1:])):
        if p < q:
            m = np.zeros((n, min(SLICE, int(col[q - 1]) - s * SLICE + 1)), np.float32)
            m[row[p:q], col[p:q] - s * SLICE] = 1
            out += m[:n_a] @ (m if rows_b is None else m[n_a:]).T
    return out


def _compare(bucket: int, a: list[tuple], b: list[tuple] | None, threshold: float) -> list[tuple[int, int, int]]:
    """(k, linked documents, smallest connected key) of the rows (k, w, ids, shingles)
    of blocks a and b, or of a with itself.  A pair is counted only in the first of
    the buckets that hold both."""
    if b is None and len(a) < 2 or b is not None and not (a and b):
        return []
    other = a if b is None else b
    size_a, size_b = (np.array([len(r[3]) for r in x], np.float32) for x in (a, other))
    if b is None and len(a) == 2:
        hit = np.isin(a[0][3], a[1][3], assume_unique=True).sum()
        both = np.array([[0, hit], [0, 0]], np.float32)
    else:
        both = _shared([r[3] for r in a], None if b is None else [r[3] for r in b])
    near = both >= threshold * (size_a[:, None] + size_b[None] - both) - 1e-3
    near &= both > 0
    if b is None:
        near = np.triu(near, 1)
    if not near.any():
        return []
    counted = near.copy()
    ids_a, ids_b = ([x[2][x[2] < bucket] for x in rows] for rows in (a, other))
    if any(map(len, ids_a)) and any(map(len, ids_b)):
        counted &= _shared(ids_a, None if b is None else ids_b) == 0
    key_a, key_b = (np.array([r[0] for r in x], np.int64) for x in (a, other))
    w_a, w_b = (np.array([r[1] for r in x], np.float64) for x in (a, other))
    links = {}
    for k, v in [*zip(key_a, counted @ w_b), *zip(key_b, w_a @ counted)]:
        links[int(k)] = links.get(int(k), 0) + int(v)
    least_a, least_b = key_a.copy(), key_b.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(least_a, np.where(near, least_b[None], top).min(axis=1))
        new_b = np.minimum(least_b, np.where(near, new_a[:, None], top).min(axis=0))
        if b is None:
            new_a = new_b = np.minimum(new_a, new_b)
        if (new_a == least_a).all() and (new_b == least_b).all():
            break
        least_a, least_b = new_a, new_b
    roots = dict(zip(key_b.tolist(), least_b.tolist())) | dict(zip(key_a.tolist(), least_a.tolist()))
    linked = {int(k) for k in key_a[near.any(axis=1)]} | {int(k) for k in key_b[near.any(axis=0)]}
    return [(k, links[k], roots[k]) for k in linked]


def _compared(rows: DataFrame, threshold: float, order: list[str]) -> DataFrame:
    """Compares the rows (cell, bucket, side, k, w, ids, shingles) of each cell.
    side 0 and 1 are the two blocks of a cell; a cell with side 2 is one block."""

    def flush(rows: list[tuple]) -> list[tuple[int, int, int]]:
        if not rows:
            return []
        sides = [[r[3:] for r in rows if r[2] == s] for s in (0, 1, 2)]
        return _compare(rows[0][1], sides[2], None, threshold) if sides[2] else _compare(rows[0][1], sides[0], sides[1], threshold)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            out = []
            cell, bucket, side, key, w = (batch.column(i).to_numpy() for i in range(5))
            io, ids = _lists(batch.column(5))
            so, shingles = _lists(batch.column(6))
            for i in range(len(cell)):
                if held and held[0][0] != cell[i]:
                    out += flush(held)
                    held = []
                held.append((cell[i], bucket[i], side[i], key[i], w[i], ids[io[i] : io[i + 1]].copy(), shingles[so[i] : so[i + 1]].copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["k", "links", "root"])
        if out := flush(held):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["k", "links", "root"])

    rows = rows.select("cell", "bucket", "side", "k", "w", "ids", "shingles")
    return rows.repartition("cell").sortWithinPartitions(*order).mapInArrow(run, "k long, links long, root long")


def _plausible(members: DataFrame, low: DataFrame, count: int) -> DataFrame:
    """(bucket, k) of small buckets' members (at most ``count``) that agree with another in AGREE minhashes."""

    def flush(held: list[tuple], out: list[tuple]) -> None:
        if len(held) > 1:
            marks = np.stack([r[2] for r in held])
            near = (marks[:, None] == marks[None]).sum(axis=2) >= AGREE
            np.fill_diagonal(near, False)
            out += [held[i][:2] for i in np.flatnonzero(near.any(axis=1))]

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            bucket, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            marks = _lists(batch.column(2))[1].reshape(-1, SKETCH).copy()
            for i in range(len(bucket)):
                if held and held[0][0] != bucket[i]:
                    flush(held, out)
                    held = []
                held.append((bucket[i], key[i], marks[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["bucket", "k"])
        out = []
        flush(held, out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["bucket", "k"])

    rows = members.join(low, "k").select("bucket", "k", "low")
    return _packed(rows.repartition("bucket"), count).sortWithinPartitions("bucket").mapInArrow(run, "bucket long, k long")


def _small(small: DataFrame, low: DataFrame) -> DataFrame:
    """(bucket, k) of the buckets (path, k) to compare at once; equal buckets count as one."""
    count = small.count()
    lists = _packed(small.groupBy("path").agg(F.sort_array(F.collect_list("k")).alias("ks")), count)
    lists = _packed(lists.groupBy("ks").agg(F.min("path").alias("path")), count)
    members = lists.select(F.col("path").bitwiseAND(F.lit((1 << 62) - 1)).alias("bucket"), F.explode("ks").alias("k"))
    return written(_plausible(members, low, count), "small")


def _merged(giants: DataFrame) -> DataFrame:
    """(bucket, k): large buckets that share half of their members with the first
    bucket of those members become one bucket."""
    count = giants.count()
    first = _packed(giants.groupBy("k").agg(F.min("bucket").alias("least")), count)
    pairs = _packed(giants.join(_few(first, count), "k").groupBy("bucket", "least").agg(F.count(F.lit(1)).alias("c")), count)
    size = _packed(giants.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), count)
    into = pairs.join(_few(size, count), "bucket").filter("least < bucket and 2 * c >= size").select(F.col("bucket").alias("from"), F.col("least").alias("to"))
    into = written(into, "merged")
    hop = into.select(F.col("from").alias("to"), F.col("to").alias("end"))
    into = into.join(_few(hop, count), "to", "left").select("from", F.coalesce("end", "to").alias("to"))
    moved = giants.join(_few(into, count), giants.bucket == into["from"], "left").select(F.coalesce("to", "bucket").alias("bucket"), "k")
    return _packed(moved.distinct(), count)


def connected(edges: DataFrame) -> DataFrame:
    """(k, root): the smallest key of each node's component, by alternating stars;
    each round is written, so that no lineage grows and nothing is gathered."""
    edges = written(_packed(edges.filter("k != root").distinct(), edges.count()), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "root").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            return edges
        state, count = tuple(now), 2 * now[0]  # no step has more rows than the edges both ways
        # every larger neighbour of a node points to the node's least neighbour
        both = edges.select("k", "root").union(edges.select(F.col("root"), F.col("k")))
        least = _packed(both.groupBy("k").agg(F.min("root").alias("m")).select("k", F.least("k", "m").alias("m")), count)
        large = both.join(_few(least, count), "k").filter("root > k").select(F.col("root").alias("k"), F.col("m").alias("root"))
        # a node and its smaller neighbours point to the least of them
        down = large.filter("root < k")
        least = _packed(down.groupBy("k").agg(F.min("root").alias("m")), count)
        small = down.join(_few(least, count), "k").select(F.col("root").alias("k"), F.col("m").alias("root")).union(least.select("k", F.col("m").alias("root")))
        edges = written(_packed(small.filter("k != root").distinct(), count), "edges")


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, leaf: int = LEAF) -> DataFrame:
    """doc_id, class_id and n_links of every document."""
    return grouped(docs, threshold, recall, leaf).select("doc_id", "class_id", "n_links")


def grouped(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, leaf: int = LEAF) -> DataFrame:
    """doc_id, row key, root (the key of the connected group; null for a text
    without words), class_id and n_links of every document."""
    marks = written(sketches(docs, threshold, runs_needed(recall)), "sketches")
    named = marks.filter("n > 0")
    n_docs = marks.count()
    repeats = _repeats(named)
    # a class is read from one of its rows; two rows with one key are told apart by their sets
    classes = written(_packed(named.groupBy("k").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row"), F.count(F.lit(1)).alias("w")), n_docs), "classes")
    n_classes = classes.count()
    # written: every level joins the minhashes
    reps = marks.join(_few(classes.select("k", "row"), n_classes), ["k", "row"])
    reps = reps.dropDuplicates(["k"]) if repeats else reps
    reps = written(reps.select("k", F.array_distinct("paths").alias("paths"), "low"), "representatives")

    low = _marks(reps.select("k", "low"), n_classes)
    level = _buckets(reps.select(F.explode("paths").alias("path"), "k"), "level1")
    small, giants = _small(level.filter(F.col("size") <= leaf), low), None
    large = level.filter(F.col("size") > leaf)

    # the sets of the classes that are still in some bucket
    open_ = _packed(small.select("k").union(large.select("k")).distinct(), n_classes)
    alive = written(classes.join(_few(open_, n_classes), "k", "left_semi").select("k", "row"), "alive")
    texts = docs.select(row_key().alias("row"), "text").join(_few(alive), "row")
    sets = _sets(texts.select("k", "text"))
    sets = written(sets.dropDuplicates(["k"]) if repeats else sets, "sets")

    deeper = []  # the small buckets of the further levels, pruned in one go
    for depth in range(1, MAX_DEPTH + 1):
        n_large = large.count()
        if not n_large:
            break
        dense = _few(written(_packed(_dense(large, low) if depth < MAX_DEPTH else large.select("path").distinct(), n_large), "dense"))
        big = large.join(dense, "path", "left_semi").select("path", "k")
        giants = big if giants is None else giants.union(big)
        if depth < MAX_DEPTH:
            open_paths = _packed(large.join(dense, "path", "left_anti").groupBy("k").agg(F.collect_list("path").alias("paths")), n_large)
            open_paths = _few(open_paths, n_large)  # the sets stay where they are
            level = _buckets(_children(sets.join(open_paths, "k"), threshold), f"level{depth + 1}")
            own = max(leaf, min(leaf << depth, MAX_LEAF))
            deeper.append(level.filter(F.col("size") <= own))
            large = level.filter(F.col("size") > own)

    # bucket ids: large ones are negative, so that they come first
    if deeper:
        small = small.union(_small(reduce(DataFrame.unionByName, deeper), low))
    assigned = small
    if giants is not None:
        big = giants.select((-1 - F.col("path").bitwiseAND(F.lit((1 << 62) - 1))).alias("bucket"), "k").distinct()
        assigned = small.union(_merged(written(big, "giants")))
    assigned = written(assigned, "buckets")
    n_assigned = assigned.count()
    places = _packed(assigned.groupBy("k").agg(F.sort_array(F.collect_set("bucket")).alias("ids")), n_assigned)
    places = written(classes.select("k", "w").join(_few(places, n_assigned), "k"), "places")
    rows = sets.join(_few(places, n_assigned), "k")

    leaves = rows.select(F.explode(F.filter("ids", lambda x: x >= 0)).alias("cell"), "k", "w", "ids", "shingles").select("*", F.col("cell").alias("bucket"), F.lit(2).alias("side"))
    found = _compared(leaves, threshold, ["cell"])
    if giants is not None:
        members = _few(assigned.filter("bucket < 0"), n_assigned)
        size = members.join(sets.select("k", F.size("shingles").alias("n")), "k").groupBy("bucket").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        size = _few(written(_packed(size, n_assigned), "blocks"))
        spread = rows.select(F.explode(F.filter("ids", lambda x: x < 0)).alias("bucket"), "*").join(size, "bucket").withColumn("own", F.pmod(F.xxhash64("k"), "blocks").cast("int"))
        cells = spread.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("far")).select(
            F.xxhash64("bucket", F.least("own", "far"), F.greatest("own", "far")).alias("cell"), "bucket",
            F.when(F.col("own") == F.col("far"), 2).when(F.col("own") < F.col("far"), 0).otherwise(1).alias("side"), "k", "w", "ids", "shingles")
        found = found.union(_compared(cells, threshold, ["cell", "side"]))
    found = written(found, "found")

    n_found = found.count()
    links = _packed(found.groupBy("k").agg(F.sum("links").alias("links")), n_found)
    root = connected(found.select("k", "root"))
    known = classes.join(_few(links, n_found), "k", "left").join(_few(root), "k", "left").select("k", "rep", "w", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "k").alias("root"))
    known = written(known, "known")
    least = _packed(known.groupBy("root").agg(F.min("rep").alias("class_id")), n_classes)
    final = known.join(_few(least, n_classes), "root").select("k", "root", "class_id", (F.col("links") + F.col("w") - 1).alias("n_links"))
    joined = named.select("doc_id", "row", "k").join(_few(final, n_classes, BROADCAST_IDS // 2), "k").select("doc_id", "row", "root", "class_id", "n_links")
    alone = marks.filter("n = 0").select("doc_id", "row", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return joined.union(alone)


def _repeats(named: DataFrame) -> bool:
    """Whether a row key has several rows, so that a class could be read twice."""
    return not named.groupBy("row").count().filter("count > 1").isEmpty()


def keep_first(docs: DataFrame) -> DataFrame:
    """Of each group, the row with the smallest doc_id stays (of several texts under
    that doc_id, the one with the smallest row key; null ids come last).  Of rows
    with equal id and text one stays, the least by the other columns.  A text
    without words is in no group: all rows of it stay."""
    row = fresh("row_key", docs)
    groups = written(grouped(docs.select("doc_id", "text")).filter("root is not null").select("doc_id", "row", "root", "class_id"), "groups")
    first = groups.filter("doc_id <=> class_id").groupBy("root").agg(F.min("row").alias("first"))
    drop = groups.join(first, "root").filter("not doc_id <=> class_id or row != first").select(F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row")).distinct()
    keyed = docs.withColumn(row, row_key())
    kept = keyed.join(drop, (keyed[row] == drop["drop_row"]) & keyed["doc_id"].cast("long").eqNullSafe(drop["drop_id"]), "left_anti")
    again = written(groups.groupBy("row").count().filter("count > 1").select(F.col("row").alias("again")), "repeated-rows")
    if not again.isEmpty():
        again, place = _few(again), fresh("row_place", kept)
        others = [F.col(c).cast("string") if t in ("string", "boolean", "date", "timestamp") or "int" in t else F.to_json(F.struct(c)) for c, t in kept.dtypes if c not in ("text", row)]
        first_row = F.row_number().over(W.partitionBy(row).orderBy(*others))
        same = kept[row] == again["again"]
        one = kept.join(again, same, "left_semi").withColumn(place, first_row).filter(F.col(place) == 1).drop(place)
        kept = kept.join(again, same, "left_anti").union(one)
    return kept.select(*docs.columns)
