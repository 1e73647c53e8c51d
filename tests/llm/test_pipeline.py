import corpus_pipeline
from cases import documents
from pyspark.sql import functions as F

from quire.llm import decontaminate, quality, simhash


def test_each_stage_takes_all_that_the_one_before_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        path = str(tmp_path / f"{k}-{name}")
        stage(spark, before, sf).write.parquet(path)
        kept = spark.read.parquet(path)
        if name == "sentencepiece_encoding":
            assert kept.count() == before.count()
            break
        assert kept.columns == docs.columns
        assert kept.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        if name == "quality_rules":
            assert quality.with_stats(kept, out="s").where("s.n_words < 50").count() == 0
        if name == "simhash_near_dedup":
            groups = simhash.near_duplicates(before).select("component_id").distinct()
            assert kept.count() == groups.count()
            assert kept.select("doc_id").exceptAll(groups).count() == 0
        if name == "suffix_array_dedup":
            assert kept.count() == before.count()
            assert kept.where(F.col("n_chars") != F.length("text")).count() == 0
        if name == "benchmark_decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert decontaminate.find_items(kept, bench).where("hits.n_hit > 0").count() == 0
    rows = corpus_pipeline.run(spark, sf)
    assert rows.exceptAll(kept).count() == 0 and kept.exceptAll(rows).count() == 0


def test_stages_on_awkward_and_empty_documents(spark):
    docs = documents(spark)
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.where("false")):
            got = stage(spark, rows, sf)
            if name != "sentencepiece_encoding":
                assert got.columns == docs.columns
            n = got.count()
            if rows is not docs:
                assert n == 0
            elif name == "simhash_near_dedup":
                assert 0 < n < docs.count()
            elif name in ("suffix_array_dedup", "sentencepiece_encoding"):
                assert n == docs.count()
