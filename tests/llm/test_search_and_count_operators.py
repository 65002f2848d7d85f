import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctpulse.llm import hard_negatives, spelling_variants, token_counts
from tests.llm.conftest import passage

SF = "/root/testdata/sf0.01"


# -- op11 hard negatives


def mined_plainly(rows):
    """Every score of every anchor, sorted and filtered."""
    own, seen = [], set()
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        own.append((vec_id, label, tuple(max(-(1 << 25), min(1 << 25, math.floor(256 * x))) for x in vector)))
    out = []
    for at, anchor in enumerate(own):
        if anchor[0] is None or anchor[0] % 100 or anchor in seen:
            continue
        seen.add(anchor)
        scored = [(sum(a * b for a, b in zip(anchor[2], v)), i, label) for j, (i, label, v) in enumerate(own) if j != at]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for score, positive, _ in [r for r in scored if r[2] == anchor[1]][:5]:
            fits = [r for r in scored if r[2] != anchor[1] and 30 * score <= 100 * r[0] <= 90 * score][:10]
            out += [(anchor[0], positive, rank, r[1], score, r[0]) for rank, r in enumerate(fits, 1)]
    return Counter(out)


def vectors(n, dims, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(int(i), [float(np.float32(x)) for x in middle[i % centres] + rng.normal(size=dims) * 0.6], int(rng.integers(0, 10))) for i in range(n)]


def test_mined_rows_equal_a_full_scan(spark):
    rows = vectors(1500, 24, 3)
    rows += [(2000 + i, rows[5][1], i % 4) for i in range(400)]  # many equal vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    for cells, chunk in ((1 << 20, 4096), (256 * 24, 3)):
        got = Counter(map(tuple, hard_negatives.mine(df, block_cells=cells, chunk_anchors=chunk).collect()))
        assert got == mined_plainly(rows) and len(got) > 100


def test_bitmaps_lose_only_rows_that_cannot_count(spark):
    rng = np.random.default_rng(5)
    columns = rng.integers(-200, 200, size=(32, 3000)).astype(np.int32)
    labels = rng.integers(0, 3, 3000)
    block = hard_negatives.Block({"columns": [c.tobytes() for c in columns], "low": columns.min(1).tolist(), "high": columns.max(1).tolist(), "labels": labels.tolist(), "ids": list(range(3000))})
    for q in (rng.integers(-200, 200, 32), np.append(rng.integers(900, 1000, 2), np.zeros(30, np.int64)), np.zeros(32, np.int64), np.full(32, 1 << 25)):
        exact = q @ columns.astype(np.int64)
        order = sorted(np.flatnonzero(labels == 1), key=lambda i: (-exact[i], i))
        assert hard_negatives.best_of_label(block, q, 1, 6) == [(exact[i], i) for i in order[:6]]
        windows = [(0, 10_000), (5_000, 5_400), (-1 << 40, 1 << 60), (7, 3)]
        order = sorted(np.flatnonzero(labels != 1), key=lambda i: (-exact[i], i))
        assert hard_negatives.best_in_windows(block, q, 1, windows, 10) == [[(exact[i], i) for i in order if a <= exact[i] <= b][:10] for a, b in windows]


def test_mining_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [1.0, 0.5], 2), (100, [0.5, 1.0], 1), (None, [1.0, 0.5], 2), (None, [0.9, 0.4], 2), (None, None, None),
        (1, [0.8, 0.6], 2), (2, [0.8, 0.6], 2), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (8, [1.0, 1.0], None),
        (200, [], 2), (9, [1.0], 1), (10, [0.7, 0.7, 0.7], 3), (300, [-1.0, -1.0], 3), (11, [1e30, -1e30], 4), (400, [1e30, 1e-30], 4), (7, [0.8, 0.5], 1), (-7, [0.8, 0.5], -3),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("id", "v", "key", "chunk", "block", "rank", "Columns"):
        df = df.withColumn(name, F.lit("x"))
    got = hard_negatives.mine(df)
    assert Counter(map(tuple, got.collect())) == mined_plainly(rows) and not got.isEmpty()
    assert hard_negatives.mine(df.limit(0)).count() == 0


def test_a_very_long_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i * 50, [float(x) for x in rng.normal(size=20_000)], i % 3) for i in range(12)]
    rows += [(i * 50 + 1, [0.8 * x for x in rows[i][1]], (i + 1) % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert Counter(map(tuple, hard_negatives.mine(df).collect())) == mined_plainly(rows)


# -- op12 spelling variants


def variants_plainly(rows):
    low, counts = str.maketrans(string.ascii_uppercase, string.ascii_lowercase), Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 5:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= 3}
    near, blank = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            blank[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in blank.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda o: (-words[o], o), default=None) for w in words}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_variants_of_the_documents(many_partitions):
    docs = many_partitions.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(spelling_variants.variants(docs)) == variants_plainly([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_variants_of_a_small_alphabet(many_partitions):
    """Words so close that runs of equal letters, chains of forms and nodes shared by many partitions abound."""
    rng = random.Random(4)
    pool = ["".join(rng.choice("aabÿ") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice((5, 60, 200))))) for i in range(60)]
    rows.append((99, " ".join(w for i, w in enumerate(pool[:40]) for _ in range(2**(i % 9)))))
    expected = variants_plainly(rows)
    assert rows_of(spelling_variants.variants(many_partitions.createDataFrame(rows, "doc_id long, text string"))) == expected
    assert any(root != form for _, form, root, *_ in expected if form)


def test_one_word_a_partition(many_partitions):
    """Fewer words than partitions, all with one long common start and one long common end."""
    words = ["abcdefghij" * 30 + c + "klmnopqrst" * 30 for c in ("", "x", "y", "zz")] + ["abcdefghij" * 30]
    rows = [(i, " ".join(words)) for i in range(5)]
    assert rows_of(spelling_variants.variants(many_partitions.createDataFrame(rows, "doc_id long, text string"))) == variants_plainly(rows)


def test_variants_edge_cases(spark, odd_docs, no_docs):
    long = "q" * 2_000
    extra = [(20, f"{long} {long} {long} {long}r"), (21, "x" * 2_000 + "é" + " word×÷word WORD×÷word Word×÷WORD"), (None, "nulls nulls nulls nullz nullz nullz nulls"), (22, None)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    clash = docs
    for name in ("id", "n", "word", "f", "r", "kind", "number", "part", "Edge"):
        clash = clash.withColumn(name, F.lit(1))
    expected = variants_plainly([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(spelling_variants.variants(clash)) == expected
    assert spelling_variants.variants(no_docs).count() == 0


def test_very_long_words(many_partitions):
    long = "q" * 100_000 + "é" * 100_000
    doc_id = next(i for i in range(100) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in (long, long + "r", "q" + long)))
    docs = many_partitions.createDataFrame([(doc_id, " ".join([long] * 3 + [long + "r"] * 6 + ["q" + long] * 5))], "doc_id long, text string")
    assert rows_of(spelling_variants.variants(docs)) == sorted([(long, long + "r", long + "r", 3, 2, 6), (long + "r", None, long + "r", 6, 1, None), ("q" + long, None, "q" + long, 5, 1, None)])


# -- op13 token counts


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())


def counted(library, rows):
    return Counter((d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t in rows)


ODD_TEXTS = [
    "a" * 5000 + " hello " + "b" * 3000, "漢字😀" * 900 + "x" * 50 + "ꙮ" * 700, "the quick brown " * 400 + " " * 3000 + "fox\n" * 500, "▁▁a" * 1500,
    "\t\n\x00é" * 1000, "</s><s>[INST] <0x41><unk>" * 200, " " * 4000, "ab" * 4000, passage(3, 2000), "no " * 300 + "aaaa" * 700 + " no" * 900,
]


@pytest.mark.parametrize("chunk, overlap, wide", [(400, 16, 64), (97, 3, 20), (2, 1, 1)])
def test_spliced_counts_equal_the_library(spark, library, chunk, overlap, wide):
    rows = [(i, t if chunk > 10 else t[:300]) for i, t in enumerate(ODD_TEXTS)]
    got = token_counts.count(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk, overlap=overlap, wide=wide)
    assert Counter(map(tuple, got.collect())) == counted(library, rows)


def test_counts_of_the_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = counted(library, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter(map(tuple, token_counts.count(docs).collect())) == expected
    assert Counter(map(tuple, token_counts.count(docs, chunk=600, overlap=16, wide=64).collect())) == expected


def test_counts_edge_cases(spark, library, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    clash = odd_docs.withColumn("row", F.lit("x")).withColumn("lo", F.lit(1)).withColumn("n_tokens", F.lit(1)).withColumn("N_bytes", F.lit(1))
    assert Counter(map(tuple, token_counts.count(clash).collect())) == counted(library, rows)
    assert Counter(map(tuple, token_counts.count(clash, chunk=500, overlap=20, wide=100).collect())) == counted(library, rows)
    assert token_counts.count(no_docs).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        token_counts.count(no_docs, chunk=10, overlap=8, wide=8)
