"""Stages of the pipeline by themselves; ``test_pipeline_rules`` holds the run to plain stages."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs = empty
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, empty, SF)
        assert docs.columns == empty.columns, name
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_stages_lose_no_unrelated_row(spark):
    words = " ".join(f"w{k} hello" for k in range(60))
    rows = [
        (1, words + " tail"), (2, words), (2, " ".join(f"other{k} text" for k in range(60))),
        (2, words + " tail"), (3, " ".join(f"third{k} one" for k in range(60))),
    ]
    docs = spark.createDataFrame(
        [(i, t, "en", "src1", len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted([rows[0], rows[2], rows[4]])
