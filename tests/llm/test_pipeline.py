import corpus_pipeline
from tallyscope.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_pass_on_documents(spark):
    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stage(spark, docs, SF).collect()
        if k == len(corpus_pipeline.STAGES) - 1:
            assert len(rows) == before and all(r["lossless"] for r in rows)
            break
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns and (name == "mix sources" or 0.6 * before < len(rows) <= before)
        before = len(rows)
    assert corpus_pipeline.run(spark, SF).count() == before
