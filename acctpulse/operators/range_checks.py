"""Key checks that look only at what changed: repeated keys (Q2) and keys without
a parent (Q4, R8, R12, R13) by ranges of the keys' hashes.

A range's fingerprint is that of a multiset, whatever its order: the number of
rows, the sums of both halves of a hash and the exclusive or of another.  It is
combined map-side, so a task ships at most one row a range.  All rows of a key lie
in one range, so a range whose fingerprints (the keys' and the parents') are those
of the last run has the figures of the last run; the rows of the others, and only
theirs, are counted key by key.  A first run counts all ranges.

Two multisets of one range have the same fingerprint by chance in about 1 of 2^128
cases.  NULL keys are counted beside the others (``null_rows``): Q2 and Q4 leave
them out, R8 and R12 take them as rows without a parent.  Empty tables have no
ranges and give zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 4096        # rows that any table of fingerprints has at most
FIGURES = ("repeated_keys", "orphan_rows", "orphan_keys", "null_rows")
_PRINT = ("n", "low", "high", "mix")
_LOW = (1 << 32) - 1


def key_range(key: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("range"), F.col(key)), F.lit(ranges)).cast("int")


def fingerprints(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """(range, n, low, high, mix) of a table's keys."""
    hashed = df.select(key_range(key, ranges).alias("range"), F.xxhash64(F.col(key)).alias("h"), F.xxhash64(F.lit("mix"), F.col(key)).alias("m"))
    return hashed.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(F.lit(_LOW))).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.bit_xor("m").alias("mix"))


def _both(child: DataFrame, parent: DataFrame | None, key: str, parent_key: str, ranges: int) -> DataFrame:
    """Each range of the child's keys with the fingerprints of its keys and its parents."""
    own = fingerprints(child, key, ranges)
    if parent is None:
        return own.select("range", *_PRINT, *[F.lit(0).cast("bigint").alias(f"parent_{c}") for c in _PRINT])
    theirs = fingerprints(parent, parent_key, ranges).select("range", *[F.col(c).alias(f"parent_{c}") for c in _PRINT])
    return own.join(theirs, "range", "left").na.fill(0, [f"parent_{c}" for c in _PRINT])


def departed(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """(range) of the ranges whose fingerprints are not those of the last run."""
    if before is None:
        return now.select("range")
    prints = ["range", *_PRINT, *[f"parent_{c}" for c in _PRINT]]
    return now.select(*prints).join(before.select(*prints), prints, "left_anti").select("range")


def rows_to_examine(df: DataFrame, key: str, departing: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The rows of the departing ranges, told apart map-side (at most ``ranges`` rows are broadcast)."""
    return df.select(key_range(key, ranges).alias("range"), F.col(key).alias("key")).join(F.broadcast(departing), "range", "left_semi")


def check_ranges(child: DataFrame, key: str, parent: DataFrame | None = None, parent_key: str | None = None,
                 before: DataFrame | None = None, ranges: int = RANGES) -> DataFrame:
    """One row a range: its fingerprints and figures.  ``before`` is what this gave,
    and the caller kept, the last time; the number of ranges must be the same."""
    parent_key = parent_key or key
    now = _both(child, parent, key, parent_key, ranges)
    departing = departed(now, before)
    counts = rows_to_examine(child, key, departing, ranges).groupBy("range", "key").agg(F.count(F.lit(1)).alias("rows"))
    if parent is None:
        counts = counts.withColumn("known", F.lit(True))
    else:
        known = rows_to_examine(parent, parent_key, departing, ranges).distinct().withColumn("known", F.lit(True))
        counts = counts.join(known, ["range", "key"], "left")
    filled, orphan = F.col("key").isNotNull(), F.col("key").isNotNull() & F.col("known").isNull()
    figures = counts.groupBy("range").agg(
        F.count_if(filled & (F.col("rows") > 1)).alias("repeated_keys"), F.coalesce(F.sum(F.when(orphan, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"), F.coalesce(F.sum(F.when(~filled, F.col("rows"))), F.lit(0)).alias("null_rows"))
    if before is not None:
        figures = figures.unionByName(before.select("range", *FIGURES).join(F.broadcast(departing), "range", "left_anti"))
    return now.join(figures, "range")


def totals(checked: DataFrame) -> DataFrame:
    """The figures of all ranges, one row."""
    return checked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FIGURES])
