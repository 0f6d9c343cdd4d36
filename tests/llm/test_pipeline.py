import os

import public_tokenizers
import pytest
from test_overlap import brute
from tokenizers import Tokenizer

from tessera.llm import mixing, quality

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as pipeline

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for _, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def test_rejected_documents_go(spark, stages):
    from tessera.llm import catalog

    model = catalog.fitted(spark, stages[0], SF)
    want = {r["doc_id"] for r in quality.classify(stages[0], model).filter("keep").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == want and stages[1].columns == stages[0].columns
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, r in labels.items() if r["quality"] and not r["toxic"]]
    assert sum(i in want for i in clean) >= 0.97 * len(clean)


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    assert sorted(r["doc_id"] for r in stages[2].collect()) == brute(rows)


def test_documents_are_repeated_by_their_counts(stages):
    counts = mixing.counts(stages[2], mixing.rates(stages[2]))
    want = sorted(r["doc_id"] for r in counts.collect() for _ in range(r["n_copies"]))
    assert sorted(r["doc_id"] for r in stages[3].collect()) == want and stages[3].columns == stages[0].columns


def test_tokens_are_the_librarys(stages):
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    rows = stages[4].collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in stages[3].collect())
    for r in rows:
        assert r["ids"] == theirs.encode(text[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_run_applies_the_stages(spark, stages):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in stages[4].collect())


def test_columns_that_clash_and_empty_tables(spark, odd, none):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
        out = stage(spark, odd, SF)
        assert out.count() > 0
        if name != "tokens":
            assert out.columns == odd.columns
