"""Quality rules: a decision list learned by sequential covering.

One pass over the whole texts computes per-document statistics.  A bounded
sample of labelled documents (``LABELLED_ROWS``) is split into a growing and a
pruning part; each rule is a conjunction of threshold tests, grown by
information gain, pruned back by the pruning part, and kept only while it is
precise there.  The rules become one ordered Spark conditional expression.

Defined results: a null text has no words; a text without words fails the base
rules; repeated documents are judged alike; an empty table gives no rows.
Without usable labels no rule is learned and only the base rules decide.  A
document with several labels counts as bad if any of them says so; null labels
are ignored."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse.llm.common import LOWER, append_columns, fresh, mix, span_hashes, text_chunks, window_hashes, word_spans, written

LABELLED_ROWS = 20_000  # expected number of labelled ids that are fitted
TEXTS_PER_ID = 4  # of an id with several texts
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_BYTE = np.arange(256)
_NOT_SPACE = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))
_IS_CHAR = (_BYTE & 0xC0) != 0x80  # first byte of a code point
_NO_BREAK = _BYTE != 10
_IS_SYMBOL = np.isin(_BYTE, np.frombuffer(b"#*$%&|<>", np.uint8))
_IS_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_IS_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_IS_MARK = (_BYTE > 32) & (_BYTE < 127) & ~_IS_DIGIT & ~((LOWER >= 97) & (LOWER <= 122))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words"]

#: What the rules may test, as ratios that do not depend on a text's length.
FEATURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "distinct_word_share": ("n_distinct_words", "n_words"),
}


def _chunk_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    out = np.zeros((len(COUNTS), n), np.int64)

    def per_text(table: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, doc = word_spans(data, offsets, _NOT_SPACE)
    words = span_hashes(data, starts, ends)
    out[0] = np.bincount(doc, minlength=n)
    out[1] = per_text(_IS_CHAR & _NOT_SPACE)
    out[2] = per_text(_IS_SYMBOL)

    # \n-split lines that have a word; equal ones of a text share (text, hash)
    line_start, line_end, line_doc = word_spans(data, offsets, _NO_BREAK)
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    key = span_hashes(data, line_start, line_end) ^ mix(line_doc.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    out[5] = np.bincount(line_doc, minlength=n)
    out[3] = out[5] - np.bincount(line_doc[first], minlength=n)

    salt = mix(doc.astype(np.uint64))
    _, first = np.unique(words ^ salt, return_index=True)
    out[9] = np.bincount(doc[first], minlength=n)
    if len(words) >= 3:
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = window_hashes(words, 3)[at] ^ salt[at]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(len(words), bool)
        for j in range(3):
            hit[at[twice] + j] = True
        out[4] = np.bincount(doc[hit], minlength=n)
    out[6], out[7], out[8] = per_text(_IS_UPPER), per_text(_IS_DIGIT), per_text(_IS_MARK)
    return out


def text_counts(column: pa.Array) -> np.ndarray:
    """The COUNTS of each text of an Arrow column, one row per count."""
    parts = [_chunk_counts(data, offsets) for _, data, offsets in text_chunks(column)]
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0), np.int64)


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """``docs`` with the COUNTS of its whole texts as long columns ``names``."""
    fields = [T.StructField(c, T.LongType()) for c in names or COUNTS]
    return append_columns(docs, text, fields, lambda column: [pa.array(row) for row in text_counts(column)], keep)


def features(counts: np.ndarray) -> np.ndarray:
    """One column per feature, from COUNTS rows."""
    by = dict(zip(COUNTS, counts.astype(float)))
    return np.stack([by[a] / np.maximum(by[b], 1) for a, b in FEATURES.values()], axis=1)


Rule = list[tuple[str, str, float]]  # conjunction of (feature, ">=" or "<=", threshold)


def _covers(x: np.ndarray, rule: Rule) -> np.ndarray:
    names = list(FEATURES)
    hit = np.ones(len(x), bool)
    for name, sign, t in rule:
        v = x[:, names.index(name)]
        hit &= (v >= t) if sign == ">=" else (v <= t)
    return hit


def _grow(x: np.ndarray, bad: np.ndarray, max_tests: int) -> Rule:
    """Adds the test of the highest information gain until no good row is covered."""
    rule: Rule = []
    live = np.ones(len(x), bool)
    while len(rule) < max_tests:
        p0, n0 = (live & bad).sum(), (live & ~bad).sum()
        if not p0 or not n0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for j, name in enumerate(FEATURES):
            values = x[live, j]
            for t in np.unique(np.quantile(values, np.linspace(0, 1, 65))):
                for sign, hit in ((">=", values >= t), ("<=", values <= t)):
                    p = (hit & bad[live]).sum()
                    if p and (gain := p * (np.log2(p / hit.sum()) - base)) > best[0]:
                        best = (gain, (name, sign, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= _covers(x, rule[-1:])
    return rule


def learn_rules(x: np.ndarray, bad: np.ndarray, min_precision: float = 0.95, min_cover: int = 5, max_tests: int = 4) -> list[Rule]:
    """Rules that cover bad rows, by sequential covering.  Every third row only
    prunes and measures; a rule below ``min_precision`` there ends the list."""
    order = np.random.default_rng(7).permutation(len(x))
    prune = np.zeros(len(x), bool)
    prune[order[::3]] = True
    left, rules = np.ones(len(x), bool), []
    while True:
        grow_rows, prune_rows = left & ~prune, left & prune
        if (grow_rows & bad).sum() < min_cover:
            return rules
        rule = _grow(x[grow_rows], bad[grow_rows], max_tests)

        def worth(r: Rule) -> tuple[float, int, int]:
            hit = _covers(x[prune_rows], r)
            p = int((hit & bad[prune_rows]).sum())
            n = int(hit.sum()) - p
            return ((p - n) / (p + n) if p + n else -1.0, p, n)

        best = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r)[0], default=[])
        _, p, n = worth(best) if best else (0, 0, 0)
        if not best or p + n == 0 or p / (p + n) < min_precision:
            return rules
        rules.append(best)
        left &= ~_covers(x, best)


def rejected(rules: list[Rule], names: dict[str, str] | None = None) -> Column:
    """The list as one ordered conditional expression over the COUNTS columns."""
    col = lambda c: F.col((names or {}).get(c, c)).cast("double")

    def test(feature: str, sign: str, t: float) -> Column:
        a, b = FEATURES[feature]
        v = col(a) / F.greatest(col(b), F.lit(1.0))
        return v >= F.lit(t) if sign == ">=" else v <= F.lit(t)

    chain = F
    for rule in rules:
        chain = chain.when(reduce(lambda p, q: p & q, [test(*x) for x in rule]), F.lit(True))
    return chain.otherwise(F.lit(False)) if rules else F.lit(False)


def base_failed(names: dict[str, str] | None = None) -> Column:
    col = lambda c: F.col((names or {}).get(c, c))
    return (col("n_words") < MIN_WORDS) | (100 * col("n_repeat_words") > MAX_REPEAT_PERCENT * col("n_words"))


def _n_labels(known: DataFrame) -> int:
    return known.count()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = LABELLED_ROWS) -> list[Rule]:
    """Learns the rules from the labelled documents that pass the base rules.
    The sample takes about ``rows`` labelled ids by a hash of the id and at most
    TEXTS_PER_ID texts of each, and no more than twice ``rows`` in all, so it does
    not grow with the tables and is the same in every run."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    total = _n_labels(known)
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)) / F.lit(float(1 << 53)) < F.lit(rows / total))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("label_quality"))
    known = written(known.orderBy(F.xxhash64("label_id"), "label_id").limit(2 * rows), "label-sample")
    picked = docs.select(F.col(doc_id).alias("label_id"), F.col(text).alias("label_text")).join(F.broadcast(known), "label_id")
    counted = with_counts(picked, "label_text", ["label_id", "label_quality"]).filter(~base_failed()).dropDuplicates()
    order = [F.xxhash64("label_id", *COUNTS), *COUNTS]
    few = counted.withColumn("label_place", F.row_number().over(W.partitionBy("label_id").orderBy(*order))).filter(F.col("label_place") <= TEXTS_PER_ID)
    table = few.orderBy(*order).limit(2 * rows).drop("label_id", "label_place").dropDuplicates().toPandas()
    if not len(table):
        return []
    table = table.sort_values(list(table.columns))
    return learn_rules(features(table[COUNTS].to_numpy().T), table["label_quality"].to_numpy() == 0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts of the contract, base_failed and kept, for each document."""
    rules = fit(docs, labels)
    out = with_counts(docs.select("doc_id", "text"), "text", ["doc_id"])
    return out.select("doc_id", *COUNTS[:5], base_failed().alias("base_failed"), (~base_failed() & ~rejected(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    rules = fit(docs, labels)
    names = {c: fresh(f"count_{c}", docs) for c in COUNTS}
    out = with_counts(docs, "text", names=list(names.values()))
    return out.filter(~base_failed(names) & ~rejected(rules, names)).select(*docs.columns)
