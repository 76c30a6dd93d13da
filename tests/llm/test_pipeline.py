"""The corpus pipeline stage by stage."""

import corpus_pipeline
from lexmill.functions.scratch import materialize

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    sizes, kept = [], {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert len(kept[name]) == sizes[-1]
    assert len(bad & kept["quality"].keys()) <= 0.02 * len(bad)
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3]
    # No 50 words of a document are in an earlier one any more.
    seen = set()
    for i in sorted(kept["passages"]):
        words = kept["passages"][i].lower().split()
        windows = {tuple(words[k : k + 50]) for k in range(len(words) - 49)}
        assert not windows & seen
        seen |= windows
    assert {r["doc_id"] for r in docs.collect()} == kept["decontamination"].keys()


def test_run_on_an_empty_and_an_odd_corpus(spark, tmp_path):
    for n, rows in enumerate([[], [(1, None, 0), (2, "", 0), (None, "a b", 0), (3, "x " * 3000, 0), (3, "x " * 3000, 0), (4, "é", 0)]]):
        folder = str(tmp_path / str(n))
        spark.createDataFrame(rows, "doc_id long, text string, key int").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert sorted({str(r["doc_id"]) for r in got.collect()}) == ([] if not rows else ["1", "2", "3", "4", "None"])
