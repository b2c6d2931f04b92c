"""The pipeline: stages keep the documents' columns and do what their operators say."""

import corpus_pipeline
from vacantia.llm import decontamination, linededup, quality, simhash


def test_stages_and_result(spark, folder):
    source = spark.read.parquet(f"{folder}/documents.parquet")
    docs, texts = source, {r["doc_id"]: r["text"] for r in source.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.settle(stage(spark, docs, folder), name)
        assert docs.columns == source.columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert {r["id"] for r in quality.judge(source).where("kept").collect()} == set(after)
        elif name == "line_dedup":
            kept = [n for t in after.values() for n in map(str.strip, t.lower().split("\n")) if n]
            assert len(kept) == len(set(kept))
            assert all(set(after[i].split("\n")) <= set(before[i].split("\n")) for i in after)
        else:
            assert all(after[i] == before[i] for i in after)
            if name == "simhash_near_dedup":
                classes = [simhash.fingerprint(t.encode()) for t in after.values()]
                assert len(classes) == len(set(classes))
    assert set(after) <= set(texts)
    result = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in result} == set(after)
    assert linededup.SIMILARITY == 0.8 and decontamination.MIN_SCORE <= 0.8
