import corpus_pipeline


def test_a_document_that_holds_a_window_of_one_benchmark_item_goes(spark, sf_dir):
    item = max((r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()), key=len).split()
    mine = [f"own{k}" for k in range(60)]
    texts = {1: [*mine, *item, *mine], 2: [*mine, *item[: len(item) * 3 // 4]], 3: [*mine, *item[:9]], 4: [*mine, *item[:7]], 5: mine}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.stage_decontaminate(spark, docs, sf_dir).collect()} == {4, 5}
