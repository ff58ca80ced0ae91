import os

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "packing"]
    before = docs.count()
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(os.path.join(folder, str(k)))
        docs = spark.read.parquet(os.path.join(folder, str(k)))
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
            assert docs.count() <= before
            before = docs.count()
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} and docs.select("doc_id").distinct().count() == before
    assert before > 120


def test_run_is_the_stages_in_order(spark, edge_docs, no_docs, folder):
    for name, frame in (("edges", edge_docs), ("none", no_docs)):
        frame.write.parquet(f"{folder}/{name}/documents.parquet")
        spark.createDataFrame([(1, "the thing of her")], "item_id bigint, text string").write.parquet(f"{folder}/{name}/benchmark.parquet")
    rows = pipeline.run(spark, f"{folder}/edges").collect()
    assert all(r.n_words <= 2048 for r in rows)
    assert pipeline.run(spark, f"{folder}/none").collect() == []
