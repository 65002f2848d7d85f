import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acctpulse.llm import decontaminate, jaccard_join, language_id, license_scan, piece_codec, quality_rules, token_store
from acctpulse.llm.common import shingle_sets, text_chunks
from tests.llm.conftest import passage

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- op6 quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


def test_counts_equal_a_plain_reading(docs, odd_docs):
    texts = [r.text for r in docs.select("text").collect()] + [r.text for r in odd_docs.select("text").collect()] + ["a b c a b c\n\na b c a b c\n a", "é\u00a0x  y\x0bz\n"]
    counts = quality_rules.text_counts(pa.array(texts))
    assert counts[:5].T.tolist() == [plain_counts(t) for t in texts]


def test_rules_are_learned_and_emitted(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    assert rules
    out = quality_rules.judge(docs, labels)
    table = out.join(labels, "doc_id").toPandas()
    good, bad = table[(table.quality == 1) & ~table.base_failed], table[(table.quality == 0) & ~table.base_failed]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.2
    # the emitted expression equals the rules applied in numpy
    counts = quality_rules.with_counts(docs, keep=["doc_id"]).withColumn("out", quality_rules.rejected(rules)).toPandas()
    x = quality_rules.features(counts[quality_rules.COUNTS].to_numpy().T)
    assert (counts["out"].to_numpy() == np.any([quality_rules._covers(x, r) for r in rules], axis=0)).all()


def test_quality_edge_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 0), (1, None, 0), (None, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_rules.judge(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert not any(r.kept for r in rows if r.base_failed)
    kept = quality_rules.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert quality_rules.judge(no_docs, labels.limit(0)).count() == 0
    assert quality_rules.judge(odd_docs, labels.limit(0)).count() == len(rows)


# -- op4 language ID


def test_language_on_held_out_documents(docs):
    table = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = table[table.held_out]
    assert len(table) == docs.count() and len(held) > 100
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert table.score.between(0, 1).all()


def test_prediction_reads_whole_texts():
    net = language_id.ByteConvNet(["a", "b"])
    net.kernels = [np.zeros_like(k) for k in net.kernels]
    net.kernels[0][0, ord("q"), 0] = 5
    net.out[:] = 0
    net.out[0] = [-3, 3]
    net.bias[:] = [1, -1]
    names, _ = net.predict(pa.array(["xx " * 400, "xx " * 90 + "q " * 3000, None, "..", "é", "漢"]))
    assert names == ["a", "b", "und", "und", "a", "a"]


def test_language_edge_cases(odd_docs, no_docs):
    rows = language_id.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 6))
    assert by[1].lang_pred in ("en", "de", "fr")
    kept = language_id.keep_known(odd_docs, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.lang_pred != "und" for r in rows)
    assert language_id.identify(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_documents_in_several_languages_stay(spark):
    speech = {"a": "bab dab gab ", "b": "lil nil sil ", "c": "tut put kut "}
    rows = [(3 * i + j, t * 40, name) for i in range(40) for j, (name, t) in enumerate(speech.items())]
    rows += [(900, "".join(t * 200 for t in speech.values()), None), (901, "12 34", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    score = {r.doc_id: r.score for r in language_id.identify(df).collect()}
    assert 0.3 < score[900] < 0.4
    assert {r.doc_id for r in language_id.keep_known(df).collect()} == {r[0] for r in rows} - {901}


# -- op3 SentencePiece


def test_pieces_equal_the_library(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    rng = random.Random(1)
    texts = ["", "  a  b\n\tc", " ", "▁x\x00y😀𝕏", "a" * 1000, "<s>hello</s><0x0A> world", " ".join(["xyz" * 300] * 3), None, "x▁▁ y" + " " * 40 + "z", "の日本語 text\r\n  end  "]
    texts += ["".join(rng.choice("abcdefgh  ▁é日\n_-") for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts += [r.text for r in docs.limit(200).collect()]
    model = piece_codec.PieceModel(piece_codec.default_model())
    for text, ids in zip(texts, model.encode(texts)):
        assert ids.tolist() == library.encode(text or "")
        assert model.decode(ids) == library.decode(ids.tolist())


def test_suffix_ranges_find_every_occurrence():
    model = piece_codec.PieceModel(piece_codec.default_model())
    text = "▁the▁thing\0▁there\0"
    place, length, piece = model.edges(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    own = [model.pieces[i] for i in model.ids]
    found = sorted(zip(place.tolist(), (own[p] for p in piece)))
    assert found == sorted((i, p) for p in own for i in range(len(text)) if text.startswith(p, i))
    assert (np.diff(place) >= 0).all() and (length == [len(own[p]) for p in piece]).all()


def test_piece_edge_cases(odd_docs, no_docs):
    rows = piece_codec.round_trip(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    out = piece_codec.encode_documents(odd_docs)
    assert out.filter("text is null" if "text" in out.columns else "n_ids = 0").count() == 3
    assert piece_codec.round_trip(no_docs).count() == 0


def test_frequent_units_stay_remembered(monkeypatch):
    """A full memo forgets what came once, not the words of every batch."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    monkeypatch.setattr(piece_codec, "MEMO_UNITS", 60)
    model, met = piece_codec.PieceModel(piece_codec.default_model()), Counter()
    keep = model._encode_units
    monkeypatch.setattr(model, "_encode_units", lambda units: met.update(units) or keep(units))
    for b in range(12):
        texts = ["the of and " + " ".join(f"w{b}x{j}ßğ漢\U00020000😀é" for j in range(20)), None, "", "of\u2581\u2581the", "z" * 300 + f"\U00010348{b}"]
        assert [ids.tolist() for ids in model.encode(texts)] == [library.encode(t or "") for t in texts]
    assert met["▁the"] == met["▁of"] == met["▁and"] == 1 and len(model.number) <= 60


# -- op8 Jaccard join


def plain_join(rows, threshold=0.8):
    rows = [(i, t) for i, t in rows if i is not None]
    sets = []
    for _, data, offsets in text_chunks(pa.array([t for _, t in rows], pa.string())):
        sets += [set(s.tolist()) for s in shingle_sets(data, offsets)]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter(p for own in holders.values() for p in itertools.combinations(own, 2))
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, least[find(i)], links[i]) for i, (doc, _) in enumerate(rows))


def joined(df, **how):
    return sorted(tuple(r) for r in jaccard_join.join(df, **how).collect() if r.doc_id is not None)


def test_join_equals_brute_force(docs):
    assert joined(docs) == plain_join([(r.doc_id, r.text) for r in docs.collect()])


def test_large_buckets_are_split_and_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    base = passage(5, 200).split()
    rows = []
    for i in range(260):  # near copies of one text, exact copies of some, and texts that only share a passage
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(200)] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(300 + i, rows[i % 7][1]) for i in range(20)]
    rows += [(400 + i, " ".join(base[:60]) + " " + passage(100 + i, 90)) for i in range(120)]
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got, want = joined(df, leaf=16, recall=0.9999), plain_join(rows)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    missed = sum(w[2] - g[2] for g, w in zip(got, want))
    assert 0 <= missed <= 0.001 * sum(w[2] for w in want) and all(g[2] <= w[2] for g, w in zip(got, want))


def test_runs_reach_the_target_recall():
    assert jaccard_join.runs_needed(0.99) < jaccard_join.runs_needed(0.9999)
    alive, rng = 0, np.random.default_rng(1)
    for _ in range(4000):
        paths = 1
        for _ in range(jaccard_join.MAX_DEPTH):
            paths = rng.poisson(jaccard_join.BRANCHING * paths) if paths else 0
        alive += paths > 0
    assert (1 - alive / 4000) ** jaccard_join.runs_needed() < 1 - jaccard_join.TARGET_RECALL + 0.003


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(7, 7)]
    found = {r.k: r.root for r in jaccard_join.connected(spark.createDataFrame(edges, "k long, root long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}


def test_join_edge_cases(odd_docs, no_docs):
    rows = [tuple(r) for r in jaccard_join.join(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    assert sorted(r for r in rows if r[0] == 1) == [(1, 1, 2), (1, 1, 2)] and (2, 1, 2) in rows
    assert (3, 3, 0) in rows and (4, 4, 0) in rows and rows.count((None, None, 0)) == 2
    kept = jaccard_join.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id = 2").isEmpty() and kept.filter("doc_id = 1").count() == 1 and kept.count() == odd_docs.count() - 2
    assert jaccard_join.join(no_docs).count() == 0


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (passage(20 + i, 60) for i in range(4))
    rows = [(3, b), (7, a), (7, b.upper()), (8, c), (9, c + " end"), (8, d), (2, d), (7, c), (11, "x"), (11, "x"), (12, "X")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # a has no copy; of c under 7, 8 and 9 the first stays, though 7 and 8 have copies of smaller ids elsewhere
    want = [(2, d), (3, b), (7, a), (7, c), (11, "x"), (11, "x")]
    assert sorted(tuple(r) for r in jaccard_join.keep_first(df).collect()) == sorted(want)
    assert joined(df) == plain_join(rows)
    two = spark.createDataFrame([(5, b), (5, b.upper()), (6, b)], "doc_id long, text string")
    assert [r.doc_id for r in jaccard_join.keep_first(two).collect()] == [5]


def test_a_common_passage_is_split_until_small(spark, monkeypatch):
    """Unlike documents that share a passage of more than a quarter of their shingles."""
    common = passage(77, 60)
    rows = [(i, common + " " + " ".join(f"w{i}x{j}" for j in range(140))) for i in range(700)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 700, 70)]
    compared, names = [], []
    keep = jaccard_join.written

    def written(df, name):
        out = keep(df, name)
        names.append(name)
        if name == "buckets":
            compared.append({tuple(r) for r in out.groupBy("bucket").count().select("bucket", "count").collect()})
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    monkeypatch.setattr(jaccard_join, "LEAF", 16)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), leaf=16).collect()}
    assert got == {i: (i % 1000, 1) if i >= 1000 or i % 70 == 0 else (i, 0) for i, _ in rows}
    # a bucket a little above the leaf's size may pass for dense; none near the passage's does
    sizes = [n for _, n in compared[0]]
    assert "level2" in names and max(sizes, default=0) < 200 and sum(n * (n - 1) // 2 for n in sizes) < 20 * len(rows)


def test_levels_share_the_written_representatives(spark, monkeypatch):
    """However many levels: one table of representatives, and small buckets are pruned twice at most."""
    common = passage(77, 60)
    rows = [(i, common + " " + " ".join(f"w{i}x{j}" for j in range(140))) for i in range(300)] + [(i, passage(i, 80)) for i in (400, 401)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 300, 30)]
    names, keep = [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name: names.append(name) or keep(df, name))
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), leaf=2).collect()}
    assert got == {i: (i % 1000, 1) if i >= 1000 or i < 300 and i % 30 == 0 else (i, 0) for i, _ in rows}
    assert "level3" in names and names.count("small") == 2 and names.count("representatives") == 1


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """Many shuffle partitions that nothing merges: a small join's tables still have few parts, with the same rows."""
    base = passage(5, 200).split()
    rows = [(i, " ".join(base[:i] + [f"edit{i}"] + base[i + 1 :])) for i in range(150)] + [(500 + i, passage(40 + i, 70)) for i in range(8)] + [(600, passage(40, 70))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    parts, keep = {}, jaccard_join.written

    def written(df, name):
        out = keep(df, name)
        parts[name] = max(parts.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = joined(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == plain_join(rows)
    assert max(parts[n] for n in ("classes", "level1-sizes", "level1", "small", "edges", "known")) <= jaccard_join.LEAST_TASKS


def test_density_is_the_mean_similarity(spark):
    sets = [set(range(100 * j, 100 * j + 30)) | set(range(10_000, 10_000 + s)) for s in (5, 45, 270) for j in range(200)]
    rng = np.random.default_rng(3)
    perms = [rng.permutation(40_000) * (1 << 13) + rng.integers(0, 1 << 13, 40_000) for _ in range(jaccard_join.SKETCH)]
    low = spark.createDataFrame([(k, [int(p[list(s)].min()) for p in perms]) for k, s in enumerate(sets)], "k long, low array<long>")
    large = low.selectExpr("k div 200 AS path", "k", "200L AS size")
    # 5, 45 and 270 of 30 + n shingles are shared: similarities 0.08, 0.43 and 0.82
    assert sorted(r.path for r in jaccard_join._dense(large, low).collect()) in ([1, 2], [2])


def test_rows_without_an_id_are_joined(spark):
    a, b, c = (passage(30 + i, 60) for i in range(3))
    rows = [(None, a), (4, a), (None, b), (None, b), (None, b.upper()), (None, c), (None, None), (None, ""), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in jaccard_join.join(df).collect())
    assert got == Counter([(None, 4, 1), (4, 4, 1), *[(None, None, 2)] * 3, *[(None, None, 0)] * 3, (5, 5, 0)])
    kept = [tuple(r) for r in jaccard_join.keep_first(df).collect()]
    left = Counter((i, (t or "").lower()) for i, t in kept)
    assert left == Counter([(4, a), (None, b), (None, c), (None, ""), (None, ""), (5, "")])


# -- op10 decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items, size=10):
    words, hit, found = plain_words(text), set(), set()
    for item, t in items:
        own = plain_words(t)
        for w in [own[i : i + size] for i in range(max(1, len(own) - size + 1))] if own else []:
            for s in range(len(words) - len(w) + 1):
                if words[s : s + len(w)] == w:
                    hit.update(range(s, s + len(w)))
                    found.add(item)
    return len(words), len(hit), len(found)


def test_decontamination_edge_cases(spark, odd_docs, no_docs):
    items = [(1, passage(1, 80)[:200]), (1, passage(1, 30)), (2, "Déjà VU été"), (3, "one"), (4, None), (5, ""), (6, "!!"), (None, "one"), (7, passage(6, 12)), (8, "ONE"), (10, passage(1, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.report(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    known = [(i, t) for i, t in items if i is not None]
    want = Counter((r.doc_id, *plain_hits(r.text, known)) for r in odd_docs.collect() if r.doc_id != 7)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in rows if r.doc_id != 7) == want
    assert all(r.contaminated == (r.n_hit > 0) for r in rows)
    kept = decontaminate.keep_clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == sum(not r.contaminated for r in rows)
    assert decontaminate.report(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(odd_docs, bench.limit(0)).collect())


def test_items_without_an_id_are_searched(spark):
    own, other = passage(11, 14), passage(12, 14)
    docs = spark.createDataFrame([(1, f"x {own} y"), (2, f"{other} {own}"), (3, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, own), (None, own), (5, other)], "item_id long, text string")
    rows = sorted(tuple(r)[:4] + (r.contaminated,) for r in decontaminate.report(docs, bench).collect())
    assert rows == [(1, 16, 14, 0, True), (2, 28, 28, 1, True), (3, 2, 0, 0, False)]
    assert [r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()] == [3]


def test_proximity_finds_reordered_terms(spark):
    w = passage(3, 10).split()
    near = " ".join(w[::-1][:5] + ["gap", "gap"] + w[::-1][5:])
    far = " ".join(w[:5] + ["gap"] * 30 + w[5:])
    docs = spark.createDataFrame([(1, near), (2, far), (3, " ".join(w)), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(w))], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.proximity(docs, bench).collect()) == [(1, 9), (3, 9)]


def plain_near(text, items, slack=5, size=10):
    words, found = plain_words(text), set()
    for item, t in items:
        own = plain_words(t)
        for w in [own[i : i + size] for i in range(max(1, len(own) - size + 1))] if own else []:
            width = len(w) + slack
            if any(set(w) <= set(words[b : b + width]) for b in range(max(1, len(words) - width + 1))):
                found.add(item)
    return found


def test_proximity_matches_brute_force(spark, odd_docs):
    rng = random.Random(5)
    vocabulary = passage(21, 14).split()
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(60)] + ["", None, "!!" + " ".join(vocabulary[:12][::-1])]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(1, texts[2]), (1, texts[1])]
    items = [(i, " ".join(rng.sample(vocabulary, rng.randrange(1, 13)))) for i in range(12)] + [(None, vocabulary[0]), (3, vocabulary[1]), (20, None), (21, f"{vocabulary[2]} {vocabulary[2]} {vocabulary[3]}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if i is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_near_items, r.near_items_sha256) for r in decontaminate.report(docs, bench).collect())
    listed = lambda t: sorted(map(str, plain_near(t, known)))
    assert got == Counter((i, len(listed(t)), hashlib.sha256(",".join(listed(t)).encode()).hexdigest()) for i, t in rows)
    pairs = Counter(tuple(r) for r in decontaminate.proximity(docs, bench).collect())
    assert pairs == Counter({(i, item) for i, t in rows for item in plain_near(t, known)})
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter((r.doc_id, r.n_near_items) for r in decontaminate.report(odd_docs, bench).collect()) == Counter((i, len(plain_near(t, known))) for i, t in odd)


# -- op2 token store


def test_coder_round_trip_and_compression():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.int32), np.array([50256]), rng.integers(0, 50257, 9000), rng.zipf(1.5, 9000) % 50257, np.tile([5, 60, 700, 8000], 3000)):
        payloads = token_store.encode_blocks(ids, 50257)
        sizes = token_store.block_sizes(len(ids))
        assert sum(sizes) == len(ids) and (token_store.decode_blocks(payloads, sizes, 50257) == ids).all()
    assert sum(map(len, payloads)) * 8 < 0.5 * len(ids)  # a repeated pattern is learned
    # blocks are independent: one alone decodes to the same ids
    assert (token_store.decode_blocks(payloads[1:2], sizes[1:2], 50257) == ids[sizes[0] : sum(sizes[:2])]).all()


def test_large_vocabularies():
    ids = np.random.default_rng(3).integers(0, 200_000, 500)
    assert (token_store.decode_blocks(token_store.encode_blocks(ids, 200_000), [500], 200_000) == ids).all()


def test_store_reads_back_what_the_library_encodes(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_store.default_tokenizer())
    library.encode_special_tokens = True
    docs = odd_docs.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text").limit(60))
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    files = token_store.written(token_store.store(docs), "test-tokens")
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.read_digest(files).collect())
    start = 0
    for (doc_id, text), (at, own, n, check) in zip(rows, got, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2])
        assert (at, own, n, check) == (start, doc_id, len(ids), token_store.crc(ids))
        start += n
    ids = {r.doc_id: r.ids for r in token_store.read_ids(files).collect()}
    assert ids[9] == library.encode("one", add_special_tokens=False).ids + [2] and ids[3] == [2]
    assert token_store.report(no_docs).count() == 0


def test_units_give_the_library_ids():
    encoder = token_store.TextEncoder(token_store.default_tokenizer())
    texts = ["a  b \n c\t d", "  x", " \n y<|endoftext|> z  ", "", "a\0 b  \0c  d é  f", "x \u00a0y", "x \x1cy \x85z", "I'll  go 's"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.library.encode(text, add_special_tokens=False).ids + [2]


def test_slices_and_groups_change_nothing(monkeypatch):
    encoder = token_store.TextEncoder(token_store.default_tokenizer())
    texts = ["", passage(3, 400), "x" * 900, " lead, and (more). It's 5.5!", None, "é è ,à; ü:ö " * 60, "a" * 300 + " " + "b" * 300, ""]
    expected = [encoder.library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(token_store, "SLICE", size)
        monkeypatch.setattr(token_store, "MEMO_UNITS", size)
        own = token_store.TextEncoder(token_store.default_tokenizer())
        for _ in range(2):  # the second time from what was kept
            assert [x.tolist() for x in own.encode(texts)] == expected
            assert len(own.number) <= size
    ids = np.random.default_rng(4).zipf(1.4, 40_000) % 50257
    whole = token_store.encode_blocks(ids, 50257)
    monkeypatch.setattr(token_store, "TOGETHER", 13)
    assert token_store.encode_blocks(ids, 50257) == whole  # a block's bytes do not depend on the others
    assert (token_store.decode_blocks(whole, token_store.block_sizes(len(ids)), 50257) == ids).all()


def test_a_very_long_text_and_clashing_columns_are_stored(spark):
    long = passage(5, 3000) + "z" * 200_000 + " end."
    docs = spark.createDataFrame([(1, long, 7, "c", 9), (1, long, 7, "c", 9), (2, "t", 1, "c", 2)], "doc_id long, text string, shard int, ids string, start long")
    library = token_store.TextEncoder(token_store.default_tokenizer()).library
    n = len(library.encode(long, add_special_tokens=False).ids) + 1
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_store.report(docs).collect())
    assert got == [(0, 1, n), (n, 1, n), (2 * n, 2, 2)]


def test_a_damaged_block_is_noticed(spark):
    docs = spark.createDataFrame([(1, passage(1, 50))], "doc_id long, text string")
    files = token_store.store(docs).withColumn("blocks", F.transform("blocks", lambda b: b.withField("crc", b["crc"] + 1)))
    with pytest.raises(Exception, match="damaged"):
        token_store.read_digest(files).collect()


def test_damaged_payloads_fail_alone():
    ids = np.random.default_rng(6).zipf(1.4, 20_000) % 50257
    payloads, sizes = token_store.encode_blocks(ids, 50257), token_store.block_sizes(len(ids))
    rng = random.Random(7)
    for damaged in (b"", payloads[1][:-1], payloads[1][:9], payloads[1] + b"xyz", b"\xff" * 400, bytes(b ^ (rng.random() < 0.1) * 85 for b in payloads[1])):
        got = token_store.decode_blocks([payloads[0], damaged, *payloads[2:]], sizes, 50257)
        same = np.split(got == ids, np.cumsum(sizes)[:-1])
        assert not same[1].all() and all(own.all() for k, own in enumerate(same) if k != 1)


def test_every_block_length_round_trips():
    ids = np.random.default_rng(8).zipf(1.3, 12_000) % 300_000
    for n in (1, 2, 63, 64, 127, 128, 129, 1000, 1023, 1025, 4095, 4096, 4097, 8200, 12_000):
        for vocabulary in (300_000, 40_000_000):
            payloads, sizes = token_store.encode_blocks(ids[:n], vocabulary), token_store.block_sizes(n)
            assert (token_store.decode_blocks(payloads, sizes, vocabulary) == ids[:n]).all()


def test_a_block_is_coded_in_many_lanes(monkeypatch):
    calls = []
    slots = token_store._Mixer.slots
    monkeypatch.setattr(token_store._Mixer, "slots", lambda self, *a: calls.append(1) or slots(self, *a))
    ids = np.random.default_rng(9).zipf(1.4, 4096) % 50257
    payloads = token_store.encode_blocks(ids, 50257)
    calls.clear()
    assert (token_store.decode_blocks(payloads, token_store.block_sizes(4096), 50257) == ids).all()
    assert len(calls) <= 4096 // 8  # one numpy step per id before


def test_new_words_reach_the_library_joined():
    class Counted:
        def __init__(self, library):
            self.library, self.texts = library, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.library.encode_batch_fast(texts, **options)

    encoder = token_store.TextEncoder(token_store.default_tokenizer())
    encoder.library = counted = Counted(encoder.library)
    text = "start" + "".join(f" {a}{b}é\n {b}<|endoftext|>{a}" for a in "abcdefghijklmno" for b in "pqrstuvwxyz'#") + " \t end."
    expected = counted.library.encode(text, add_special_tokens=False).ids + [2]
    assert [ids.tolist() for ids in encoder.encode([text, text])] == [expected] * 2
    assert counted.texts < 40  # one for each of about 400 units before


def test_vocabularies_whose_ids_are_not_of_the_bytes_width():
    encoder = token_store.TextEncoder(token_store.default_tokenizer())
    encoder.width[:] += 1  # as if the ids stood for other bytes: the units are encoded one by one
    texts = ["one two, three  four. " + passage(4, 300), None, " five"]
    assert [ids.tolist() for ids in encoder.encode(texts)] == [encoder.library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


# -- fitting on awkward labels


def test_many_labels_and_a_null_id_on_a_third_of_the_rows(spark, monkeypatch):
    words = "der die das und ist nicht ein zu".split(), "the of and to in is that it".split()
    rows = [(i, f"l{i % 2000}", f"{passage(i, 12)} {i}") for i in range(4000)]
    rows += [(None, "de" if i % 2 else "en", " ".join(words[1 - i % 2][(i * j) % 8] for j in range(40)) + f" {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    monkeypatch.setattr(language_id, "MAX_WINDOWS", 3000)
    seen = []
    monkeypatch.setattr(language_id.ByteConvNet, "train", lambda self, x, y: seen.append((len(self.languages), len(x))) or self)
    model = language_id.fit(docs, train_docs=300)
    assert model is not None and seen[0][1] <= 3000 and seen[0][0] > 1500
    out = language_id.with_language(docs.limit(50), model, "lang_pred", "score", ["doc_id"])
    assert out.count() == 50


def test_the_sample_of_labels_is_bounded_and_never_empty(spark, monkeypatch):
    texts = [(i if i % 3 else 7, passage(i, 60) + (" # " * 40 if i % 2 else "")) for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 ^ 1) for i in range(900)], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(quality_rules, "learn_rules", lambda x, bad: sizes.append(len(bad)) or [])
    quality_rules.fit(docs, labels, rows=100)
    assert 0 < sizes[-1] <= 200
    # a share far below a millionth still samples by the hash, and does not fail
    monkeypatch.setattr(quality_rules, "_n_labels", lambda known: 10**11)
    share = 20_000 / 10**11
    assert quality_rules.fit(docs, labels) == [] and share > 0


# -- op7 license scan


def test_scan_equals_verifying_every_window(docs, odd_docs):
    scanner = license_scan.Scanner()
    mit = license_scan.TEMPLATES["mit-grant"]
    texts = [r.text for r in docs.collect()] + [r.text for r in odd_docs.collect() if r.doc_id != 7]
    texts += [passage(1, k) + " " + mit + " " + passage(2, 40) for k in range(0, 90, 7)] + [mit.replace("merge", "blend"), mit[:150], "released under the mit license"]
    for _, data, offsets in text_chunks(pa.array(texts, pa.string()), 1 << 30):
        found, all_windows = set(scanner.scan(data, offsets)), set(scanner.scan(data, offsets, exhaustive=True))
    assert found <= all_windows and len(found) >= 0.99 * len(all_windows)
    names = Counter(name for _, name, *_ in found)
    assert names["mit-grant"] >= 14 and names["apache-2.0-notice"] > 0


def test_bands_reach_the_recall():
    scanner = license_scan.Scanner()
    for size, own in scanner.classes.items():
        for i in own:
            m = len(scanner.sets[i])
            held = int(np.ceil(license_scan.CONTAINMENT * m))
            similarity = held / (2 * size + m - held)
            assert m <= size and 1 - (1 - similarity) ** scanner.bands >= license_scan.RECALL


def test_license_edge_cases(spark, odd_docs, no_docs):
    extra = spark.createDataFrame([(50, "x y z " * 20 + "Released under the MIT License."), (50, "x y z " * 20 + "Released under the MIT License."), (None, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.license, r.containment, r.first_word, r.last_word) for r in license_scan.scan(odd_docs.select("doc_id", "text").union(extra)).collect())
    assert rows == [(0, "cc-by-nc-4.0-notice", 1.0, 0, 6), (50, "mit-notice", 1.0, 60, 64), (50, "mit-notice", 1.0, 60, 64)]
    assert license_scan.scan(no_docs).count() == 0
