"""Stages one after another against the operators on what the one before kept."""

import corpus_pipeline
from mercato.llm import decontaminate, pii, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        kept[name] = after.collect()
        if name != "bpe":
            assert after.columns == docs.columns
            after = spark.createDataFrame(kept[name], docs.schema)
        before = after
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    assert ids["simhash"] <= ids["toxicity"] and ids["decontamination"] <= ids["simhash"]
    assert ids["decontamination"] == ids["pii"] == ids["bpe"]
    groups = simhash.near_duplicates(spark.createDataFrame(kept["toxicity"], docs.schema)).collect()
    assert ids["simhash"] == {r["component_id"] for r in groups}
    found = decontaminate.find_contamination(
        spark.createDataFrame(kept["simhash"], docs.schema), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids["simhash"] - ids["decontamination"] == {r["doc_id"] for r in found}
    texts = {r["doc_id"]: r["text"] for r in kept["decontamination"]}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept["pii"]} == {
        i: (pii.mask_text(t), len(pii.mask_text(t))) for i, t in texts.items()}


def test_run_and_an_empty_corpus(spark, docs):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) > 60
    empty = docs([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, empty, SF)
        assert made.count() == 0
