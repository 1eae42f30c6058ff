import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from trolley.llm.common import store, table

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_stages_and_run(spark):
    """Each stage's rows come from its input, and run() gives what the stages give one by one."""
    docs = table(spark, SF, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = store(stage(spark, docs, SF), f"test-{name}")
        if k < 4:
            assert out.columns == docs.columns
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, docs.collect()))
