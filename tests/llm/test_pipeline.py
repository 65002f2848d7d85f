import corpus_pipeline
from acctpulse.llm import decontaminate, jaccard_join, language_id, piece_codec, quality_rules
from tests.llm.test_text_operators import plain_join

SF = "/root/testdata/sf0.01"


def test_stages_against_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    (_, quality), (_, language), (_, near), (_, clean), (_, pieces) = corpus_pipeline.STAGES
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    kept = corpus_pipeline.written(quality(spark, docs, SF), "t1")
    assert kept.columns == docs.columns and ids(kept) == ids(quality_rules.judge(docs, labels).filter("kept"))
    known = corpus_pipeline.written(language(spark, kept, SF), "t2")
    assert known.columns == docs.columns and ids(known) == ids(language_id.identify(kept).filter("lang_pred != 'und' and score >= 0.4"))
    single = corpus_pipeline.written(near(spark, known, SF), "t3")
    want = plain_join([(r.doc_id, r.text) for r in known.collect()])
    assert single.columns == docs.columns and ids(single) == sorted({c for _, c, _ in want})
    safe = corpus_pipeline.written(clean(spark, single, SF), "t4")
    assert safe.columns == docs.columns and ids(safe) == ids(decontaminate.report(single, bench).filter("not contaminated"))
    last = pieces(spark, safe, SF).collect()
    model = piece_codec.load(piece_codec.default_model())
    texts = {r.doc_id: r.text for r in safe.collect()}
    assert {r.doc_id: r.ids for r in last} == {d: model.encode([t])[0].tolist() for d, t in texts.items()}


def test_predicted_languages_reach_the_last_stage(spark, tmp_path):
    speech = {"a": "bab dab gab ", "b": "lil nil sil ", "c": "tut put kut "}
    rows = [(3 * i + j, t * (20 + i), name) for i in range(40) for j, (name, t) in enumerate(speech.items())]
    rows += [(900, speech["b"] * 300, None), (901, speech["c"] * 400, "a"), (902, "12 34", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, language), (_, pieces) = corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[-1]
    known = corpus_pipeline.written(language(spark, docs, str(tmp_path)), "t5")
    got = {r.doc_id: r.lang for r in pieces(spark, known, str(tmp_path)).collect()}
    assert got == {d: lang for d, _, lang in rows if d < 900} | {900: "b", 901: "c"}


def test_run_survives_odd_documents(spark, odd_docs, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= {1, 2, 7, 8, None}
    assert jaccard_join.join(odd_docs).count() == odd_docs.count()


def test_run_on_empty_tables(spark, odd_docs, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    odd_docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
