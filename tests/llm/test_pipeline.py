"""The registered queries and the pipeline end to end on the smallest sample."""

import pytest

import __spark_entry__
import corpus_pipeline
from tidewater.llm.queries import queries
from tidewater.llm.tables import read

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries()))
def test_query_runs_over_its_whole_table(spark, name):
    assert __spark_entry__.queries()[name] is queries()[name]
    rows = queries()[name](spark, SMALL)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)


def test_pipeline_stages_keep_columns_and_drop_only(spark):
    docs = read(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SMALL)
        assert left.schema.simpleString() == docs.schema.simpleString()
        assert left.exceptAll(docs).count() == 0 and 0 < left.count() <= docs.count()
        docs = left
    packed = corpus_pipeline.pack(spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, packed.collect()))


def test_pipeline_of_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        read(spark, SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
