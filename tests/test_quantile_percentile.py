"""The split exact median equals Spark's single-reducer percentile; the
histogram peer rank equals the window percent_rank."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from acctpulse.operators.percentile import peer_percentile_histogram, peer_percentile_window
from acctpulse.operators.quantiles import exact_quantile


def _rows(seed=7, n=3000):
    rnd = random.Random(seed)
    groups = [("K12", "A"), ("K12", None), ("Higher Ed", "B"), ("Higher Ed", "C"), ("Solo", "Z")]
    rows = []
    for i in range(n):
        g = groups[0] if i % 3 == 0 else rnd.choice(groups[:4])   # one hot group
        rows.append((g[0], g[1], rnd.randint(0, 40) / rnd.randint(1, 7)))
    rows.append(("Solo", "Z", 2.5))
    rows.append(("Nulls", "N", None))          # a group of only NULL values: NULL quantile
    rows.append(("Solo", "Z", None))
    rows.append(("Pair", "P", 1.0))
    rows.append(("Pair", "P", 4.0))
    return rows


def test_exact_quantile_matches_percentile(spark):
    df = spark.createDataFrame(_rows(), "division string, segment string, v double")
    for parts in (1, 3, 16):
        got = {(r.division, r.segment): r.m for r in
               exact_quantile(df, ["division", "segment"], "v", 0.5, out="m", num_partitions=parts).collect()}
        exp = {(r.division, r.segment): r.m for r in
               df.groupBy("division", "segment").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
        assert got.keys() == exp.keys()
        for k in exp:
            assert got[k] == exp[k], (parts, k, got[k], exp[k])
    assert got[("Pair", "P")] == 2.5 and got[("Solo", "Z")] == 2.5 and got[("Nulls", "N")] is None


def test_exact_quantile_other_q(spark):
    df = spark.createDataFrame(_rows(3, 500), "division string, segment string, v double")
    for q in (0.0, 0.25, 0.9, 1.0):
        got = {(r.division, r.segment): r.m for r in
               exact_quantile(df, ["division", "segment"], "v", q, out="m", num_partitions=5).collect()}
        exp = {(r.division, r.segment): r.m for r in
               df.groupBy("division", "segment").agg(F.percentile("v", F.lit(q)).alias("m")).collect()}
        for k in exp:
            assert got[k] == exp[k], (q, k, got[k], exp[k])


def test_histogram_rank_equals_window(spark):
    rnd = random.Random(11)
    vals = [Decimal(x) / 10 for x in range(0, 1001, 5)]
    rows = [(i, rnd.choice(["K12", "Higher Ed"]), rnd.choice(["A", "B", None]), rnd.choice(vals[:40]))
            for i in range(4000)]
    rows.append((99999, "Solo", "Z", Decimal("12.5")))
    rows += [(100000 + i, "K12", "A", None) for i in range(3)]   # NULL scores rank first
    df = spark.createDataFrame(rows, "id long, division string, segment string, composite_health_score decimal(5,1)")
    h = {r.id: r.peer_percentile_rank for r in peer_percentile_histogram(df, row_bound=100).collect()}
    w = {r.id: r.peer_percentile_rank for r in peer_percentile_window(df).collect()}
    assert h == w
    assert h[99999] == 0.0


try:
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
except ImportError:  # pragma: no cover
    given = None

if given is not None:
    @settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(values=st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                                     st.integers(min_value=0, max_value=30),
                                     st.integers(min_value=1, max_value=6)), min_size=1, max_size=300),
           parts=st.integers(min_value=1, max_value=9),
           q=st.sampled_from([0.5, 0.1, 0.75]))
    def test_exact_quantile_property(spark, values, parts, q):
        rows = [(g, n / d) for g, n, d in values] + [("hot", float(i % 7)) for i in range(len(values))]
        df = spark.createDataFrame(rows, "g string, v double")
        got = {r.g: r.m for r in exact_quantile(df, ["g"], "v", q, out="m", num_partitions=parts).collect()}
        exp = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(q)).alias("m")).collect()}
        assert got == exp


def test_range_sizing(spark):
    from acctpulse.operators.quantiles import ROWS_PER_RANGE, range_partitions
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(spark, 10) == 1
    assert range_partitions(spark, ROWS_PER_RANGE) == 1
    assert range_partitions(spark, ROWS_PER_RANGE + 1) == min(2, most)
    assert range_partitions(spark, 10**12) == most
    assert range_partitions(spark, None) == most
