import itertools

import corpus_pipeline
from millrace.llm import mixing, quality_rules, shared, simhash
from millrace.llm.shared import stored, table
from test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    """Each stage against what its operator decides, over what the stage before has kept."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "secret scans", "mixing", "packing"]
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), "test-pipeline")
        at[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
        ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if name == "quality rules":
            assert ids == sorted(r["doc_id"] for r in quality_rules.judge(before, labels).where("kept").collect())
        if name == "SimHash near-dedup":
            assert ids == sorted({r["component_id"] for r in simhash.near_duplicates(before).collect()})
        if name == "secret scans":
            assert len(ids) == before.count()
        if name == "mixing":
            assert len(ids) == sum(r["copies"] for r in mixing.mix(before).collect())
    texts = {r["doc_id"]: r["text"] for r in at["mixing"].collect()}
    copies = at["mixing"].groupBy("doc_id").count().collect()
    pieces = docs.collect()
    for c in copies:
        own = [p for p in pieces if p["doc_id"] == c["doc_id"]]
        assert sum(p["length"] for p in own) == c["count"] * own[0]["doc_tokens"]
    once = {c["doc_id"] for c in copies if c["count"] == 1}
    assert once and set(texts) == {c["doc_id"] for c in copies}


def test_run_equals_the_stages_and_empty_table(spark, docs_of, tmp_path):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 0
    docs_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    check([], {})


def test_odd_rows_pass_through_every_stage(spark, docs_of, words, tmp_path):
    rows = [(None, words(90, 1), None), (1, None, "a"), (2, "", None), (3, words(200, 2), "a"), (3, words(200, 2), "a"), (4, words(50_000, 3), "b")]
    rows.append((5, words(60, 4) + " password = abcdefghijklmnop", None))
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1, 0), (1, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {4} <= {r["doc_id"] for r in got} <= {None, 3, 4, 5}


def test_run_leaves_its_result_alone_in_the_shared_folder(spark, tmp_path, monkeypatch):
    numbers = itertools.count()
    monkeypatch.setattr(shared, "scratch_dir", lambda _, purpose: f"{tmp_path}/{purpose}-{next(numbers)}")
    rows = corpus_pipeline.run(spark, SF)
    left = [p.name for p in tmp_path.iterdir()]
    assert len(left) == 1 and left[0].startswith("pipeline-packing-") and rows.count() > 0
