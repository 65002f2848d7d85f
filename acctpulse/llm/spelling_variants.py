"""Spelling variant grouping by a dictionary of trie-node pairs.

All words go into a forward trie and all reversed words into a second one, and
the nodes are numbered: a word's forward node i stands for its first i
characters, its reversed node i for those from i on.  Two words with the same
pair (forward node i, reversed node i + 1) differ in the character at i alone;
a word whose pair (forward node i, reversed node i) is another's pair around
its character i lacks just that character.  Joining the integer pairs gives the
exact near words, with nothing to verify.

The tries are never built in one place.  The words are range-partitioned and
sorted; a partition numbers the nodes of its own run of words, each word adding
those beyond its common prefix with the word before.  Only nodes on the paths of
the first and last word of a partition can belong to two partitions; these are
given the earlier partition's number.

A pair's words differ in one character, so a group holds at most one word for
each character of the alphabet and one without it.  Deletions inside a run of
equal characters give the same word, so only a run's first character counts.

A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z
lower-cased.  Where 97 divides the crc32 h of ``<doc_id>:<word>``, the character
h % length is taken out (planted misspellings).  Defined results: null texts and
texts without letters have no words; a null doc_id counts as an empty string;
repeated rows and repeated ids count each time; words of equal count are ordered
by code points; a very long word costs nodes and pairs in proportion to its
length; an empty table gives no words; other columns are not read, so their
names cannot clash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse.llm.common import written
from acctpulse.llm.decontaminate import lower_ascii
from acctpulse.session import broadcast_if_bounded

LETTERS = "[A-Za-zÀ-ÿ]+"
PLANT_EVERY = 97
MIN_LENGTH, MIN_COUNT = 5, 3
FORM_RATIO = 2  # a form occurs at least so many times as often as its variant
BROADCAST_ROWS = 1_000_000  # bound on the shared nodes that are broadcast
_ROOT = -1
_GAP, _SKIP, _SKIP_FIRST = 0, 1, 2


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of at least MIN_LENGTH characters and MIN_COUNT occurrences over all texts."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    runs = docs.select(key.alias("doc"), F.explode(F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(LETTERS), F.lit(0))).alias("run"))
    hashed = runs.filter(F.length("run") >= MIN_LENGTH).select("run", F.crc32(F.concat("doc", F.lit(":"), "run")).alias("h"))
    without = "concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))"
    words = hashed.select(F.expr(f"CASE WHEN h % {PLANT_EVERY} = 0 THEN {without} ELSE run END").alias("word"))
    return words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


# -- trie nodes


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted words of a partition.  A node's number holds the partition and a running
    count; ``id`` numbers the words in their order; ``edge`` marks the partition's first (1) and last
    (2) word (3: both), with ``part``."""
    part = TaskContext.get().partitionId()
    base = part << 40
    path, before, nodes, words = [_ROOT], "", 0, 0
    held: pa.RecordBatch | None = None

    def out(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        nonlocal path, before, nodes, words
        paths, ids, edges = [], [], []
        for word in batch.column(0).to_pylist():
            keep = _common(before, word)
            path = path[: keep + 1] + list(range(base + nodes, base + nodes + len(word) - keep))
            nodes += len(word) - keep
            paths.append(path)
            ids.append(base + words)
            edges.append(0 if words else 1)
            words += 1
            before = word
        edges[-1] |= 2 * last
        made = [pa.array(ids, pa.int64()), pa.array(paths, pa.list_(pa.int64())), pa.array(edges, pa.int32()), pa.array([part] * len(ids), pa.int32())]
        return pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns)] + made, names=[*batch.schema.names, "number", "nodes", "edge", "part"])

    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield out(held, False)
            held = batch
    if held is not None:
        yield out(held, True)


def numbered(words: DataFrame, column: str, name: str) -> tuple[DataFrame, DataFrame | None]:
    """``words`` sorted by ``column`` (its first one) with the trie nodes of that
    column, and the nodes that stand for an earlier partition's: (node, same)."""
    schema = ", ".join(f"{c} {t}" for c, t in words.dtypes) + ", number long, nodes array<long>, edge int, part int"
    table = written(words.repartitionByRange(column).sortWithinPartitions(column).mapInArrow(_number, schema), name)
    same: dict[int, int] = {}
    last: tuple[str, list[int]] | None = None
    # at most two words of each partition
    for row in table.filter("edge > 0").orderBy("number").select(column, "nodes", "edge").collect():
        if row.edge & 1 and last is not None:
            for i in range(1, _common(last[0], row[0]) + 1):
                same[row.nodes[i]] = same.get(last[1][i], last[1][i])
        if row.edge & 2:
            last = (row[0], row.nodes)
    if not same:
        return table, None
    spark = words.sparkSession
    return table, broadcast_if_bounded(spark.createDataFrame(list(same.items()), "node long, same long"), len(same), BROADCAST_ROWS)


def _merged(pairs: DataFrame, node: str, same: DataFrame | None) -> DataFrame:
    if same is None:
        return pairs
    named = same.select(F.col("node").alias(node), "same")
    return pairs.join(named, node, "left").withColumn(node, F.coalesce("same", node)).drop("same")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each word: around each character, and between any two."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        letters = np.frombuffer("".join(batch.column(2).to_pylist()).encode("utf-32-le"), np.uint32)
        f, r = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
        ends = np.cumsum(np.diff(batch.column(3).offsets.to_numpy())) - 1
        size = np.diff(ends, prepend=-1) - 1  # characters; a word has one node more
        last, first = np.zeros(len(f), bool), np.zeros(len(f), bool)
        last[ends] = True
        first[ends - size] = True
        new = np.append(True, letters[1:] != letters[:-1]) | first[~last]
        word = np.repeat(np.arange(len(ids)), size + 1)
        who = np.concatenate([word[~last], word])
        kind = np.concatenate([np.where(new, _SKIP_FIRST, _SKIP), np.full(len(f), _GAP)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (np.concatenate([f[~last], f]), np.concatenate([r[~first], r]), ids[who], n[who], kind)], names=["f", "r", "id", "n", "kind"]
        )


def node_pairs(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) with ids in code-point order, and the pairs (f, r, id, n, kind) of all words."""
    forward, same_forward = numbered(vocabulary.select("word", "n"), "word", "forward-trie")
    forward = forward.select(F.col("number").alias("id"), "word", "n", F.col("nodes").alias("f"))
    backward, same_backward = numbered(forward.select(F.reverse("word").alias("reversed"), "id"), "reversed", "reversed-trie")
    both = forward.join(backward.select("id", F.reverse("nodes").alias("r")), "id")
    pairs = both.select("id", "n", "word", "f", "r").mapInArrow(_pairs, "f long, r long, id long, n long, kind int")
    return forward.select("id", "word", "n"), _merged(_merged(pairs, "f", same_forward), "r", same_backward)


# -- near words, forms and roots


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, form_n, form_id): how many near words, and the most frequent of them."""
    group = pairs.groupBy("f", "r").agg(F.collect_list(F.struct("n", F.expr("-id").alias("before"), "kind")).alias("words")).filter("size(words) > 1")
    partner = f"(w.kind > {_GAP} AND o.kind > {_GAP} AND w.before <> o.before) OR w.kind + o.kind = {_SKIP_FIRST} AND w.kind * o.kind = 0"
    each = group.select(F.explode(F.expr(f"transform(words, w -> struct(-w.before AS id, transform(filter(words, o -> {partner}), o -> struct(o.n AS n, o.before AS before)) AS near))")).alias("e"))
    some = each.filter("size(e.near) > 0").select("e.id", F.size("e.near").alias("k"), F.array_max("e.near").alias("best"))
    return some.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best")).select("id", "n_near", F.col("best.n").alias("form_n"), F.expr("-best.before").alias("form_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of every word with a form: where its chain of forms ends.  Counts at least
    double along a chain, so a chain is short and doubling its steps takes few joins."""
    at = forms.select("id", F.col("form_id").alias("root_id"))
    while True:
        step = at.select(F.col("id").alias("root_id"), F.col("root_id").alias("further"))
        at = written(at.join(step, "root_id", "left").select("id", F.coalesce("further", "root_id").alias("root_id"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    vocabulary = written(word_counts(docs, doc_id, text), "vocabulary")
    words, pairs = node_pairs(vocabulary)
    near = words.join(near_words(pairs), "id", "left")
    form = F.col("form_n") >= FORM_RATIO * F.col("n")
    near = written(near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("form_n")).alias("form_n"), F.when(form, F.col("form_id")).alias("form_id")), "near-words")
    ends = roots(near.filter("form_id IS NOT NULL"))
    named = words.select("id", "word")
    linked = (
        near.filter("form_id IS NOT NULL").join(ends, "id")
        .join(named.withColumnsRenamed({"id": "form_id", "word": "form"}), "form_id")
        .join(named.withColumnsRenamed({"id": "root_id", "word": "root"}), "root_id")
    )
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = near.filter("form_id IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.select(*columns).unionByName(alone)
