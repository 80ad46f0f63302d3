import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import toxicity
from tests.llm.test_repeats import brute_components, brute_hits, brute_kept

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of each stage and the output of the last, each written and read again, as small as they are."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, seen[-1], DATA).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "repeated_passages", "decontamination", "pieces"]
    assert all(s.columns == stages[0].columns for s in stages[1:5])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    left = {i for i, _ in rows(stages[1])}
    for r in labels.collect():
        assert (r["doc_id"] in left) == (r["toxic"] == 0)


def test_one_document_of_each_group_stays(stages):
    groups = brute_components(rows(stages[1]), 80, 5)
    assert [i for i, _ in rows(stages[2])] == sorted(i for i, (_, c) in groups.items() if i == c)


def test_repeated_runs_go(stages):
    kept = {i: words for i, _, words in brute_kept(rows(stages[2]), 35)}
    after = stages[3].collect()
    assert {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"]) for r in after} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_contaminated_documents_go(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute_hits(rows(stages[3]), items, 10) if not hit}
    assert {str(i) for i, _ in rows(stages[4])} == clean


def test_pieces_are_all_there(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].where(F.col("n_pieces") != F.size("piece_ids")).count() == 0


def test_stages_take_nulls_copies_and_empty_tables(spark, monkeypatch):
    fields = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b " * 40, None, "s", 1)], fields)
    chain = toxicity.fit_chain(odd, spark.createDataFrame([], "doc_id long, low_quality int, toxic int"), ("low_quality", "toxic"))
    monkeypatch.setattr(toxicity, "fit_chain", lambda *a, **b: chain)
    for docs, n in ((odd, 4), (spark.createDataFrame([], fields), 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        assert docs.count() == n
