"""Every stage on its predecessor's rows, each against its operator's plain reading."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sorigil.llm import secret_lexer
from sorigil.llm.common import stored
from tests.llm.test_benchmark_packing import check_packing, plain_ids, plain_report
from tests.llm.test_near_duplicates import plain_groups
from tests.llm.test_quality_toxicity import plain_verdicts

SMALL = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SMALL), "test-stage")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        before, after = ({r.doc_id: r for r in df.collect()} for df in (docs, out))
        kept[name] = set(after)
        if name == "quality":
            want = {v[0] for v in plain_verdicts([(r.doc_id, r.text, r.lang) for r in before.values()]) if v[-1]}
        elif name == "near_duplicates":
            want = set(plain_groups([(r.doc_id, r.text) for r in before.values()]).values())
        elif name == "decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            want = {v[0] for v in plain_report([(r.doc_id, r.text) for r in before.values()], bench) if not v[-1]}
        else:
            want = set(before)
            assert all(after[i].text == secret_lexer.redact(before[i].text) and after[i].n_chars == len(after[i].text) for i in after)
        assert kept[name] == want
        docs = out
    pieces = corpus_pipeline.packing(spark, docs, SMALL).collect()
    check_packing(pieces, plain_ids([(r.doc_id, r.text) for r in docs.collect()]), 2048)
    assert {r.doc_id for r in entry.queries()["pipeline"](spark, SMALL).collect()} == kept["secrets"]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2])
def test_empty_and_null_documents(spark, rows):
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() in (0, len(rows))
