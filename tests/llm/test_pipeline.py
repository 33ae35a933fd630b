from collections import Counter

import pytest

from gristmill.llm import ngram_join, quality

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        docs = kept[name] = spark.createDataFrame(docs.collect(), docs.schema)
    judged = quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("keep").count()
    assert kept["quality_rules"].count() == judged
    assert kept["line_dedup"].count() == judged and kept["line_dedup"].where("length(text) <> n_chars").count() == 0
    assert ngram_join.ngram_classes(kept["ngram_jaccard_join"]).where("n_copies + n_links > 0").count() == 0
    mixed = Counter(r["doc_id"] for r in kept["source_mixing"].collect())
    assert set(mixed) <= {r["doc_id"] for r in kept["ngram_jaccard_join"].collect()}
    tokens = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter(r["doc_id"] for r in tokens) == mixed and all(r["round_trip"] for r in tokens)


def test_stages_of_messy_rows(spark, messy, nothing, sf_dir):
    for rows in (messy, nothing):
        docs = rows
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == rows.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_run_reads_the_table(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 0
