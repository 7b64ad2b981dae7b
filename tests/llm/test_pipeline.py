import corpus_pipeline
from quire.llm.common import stage


def test_stages_keep_the_documents_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, sf), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert dict(docs.dtypes)["doc_id"] == "bigint"
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
