"""The corpus pipeline: each stage against a brute-force version on its own input."""

import corpus_pipeline
import helpers as H
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import check_packing

from tessaline.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, input, output) of every stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        now = spark.read.parquet(path)
        out.append((name, docs, now))
        docs = now
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    scorer = toxicity.train(before, spark.read.parquet(f"{FOLDER}/labels.parquet"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    given = texts(before)
    assert texts(after) == {k: t for k, t in given.items() if scorer.score(t) < 0.5} and len(texts(after)) < len(given)


def test_one_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near_dedup"])
    assert set(after) == {k for k, (_, least) in H.groups(sorted(before.items()), 5, 80).items() if k == least} and len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = (texts(x) for x in stages["decontamination"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(after) == {k for k, (_, hit, _) in H.contamination(sorted(before.items()), items).items() if not hit} and len(after) < len(before)


def test_secrets_are_redacted(stages):
    before, after = (texts(x) for x in stages["secrets"])
    assert set(before) == set(after)
    for k, text in before.items():
        if H.base_spans(text):
            assert "[SECRET]" in after[k] and not H.base_spans(after[k])
        elif "[SECRET]" not in after[k]:
            assert after[k] == text
    assert all(r["n_chars"] == len(r["text"]) for r in stages["secrets"][1].collect() if "[SECRET]" in r["text"])


def test_packing_holds_every_id(stages):
    before, after = stages["packing"]
    assert check_packing(after.collect(), sorted(texts(before).items())) < 0.1


def test_run_equals_the_stages(spark, stages):
    total = lambda df: df.groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect()
    assert total(corpus_pipeline.run(spark, FOLDER)) == total(stages["packing"][1])
