import importlib

import pytest

from conftest import SF_TINY
from llm.helpers import docs


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_and_columns(spark, pipeline):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "packing"]
    current = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    columns, before = current.columns, current.count()
    for name, stage in pipeline.STAGES[:-1]:
        current = stage(spark, current, SF_TINY)
        assert current.columns == columns, name
        current = spark.createDataFrame(current.collect(), current.schema)
        after = current.count()
        assert 0 < after <= before and (name != "pii" or after == before)
        before = after


def test_run_equals_plain_decisions(spark, pipeline):
    """The kept documents, decided by plain Python; the packed tokens are theirs."""
    from llm.helpers import ALNUM_WORDS, words
    from llm.test_ngram_join import brute
    from viewstar.llm import langid
    from viewstar.llm.queries import held_out

    df = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    model = langid.train(df.where(~held_out("doc_id", 3, 1)))
    spoken = {r.id for r in langid.identify(df, model).where("lang_pred <> 'und' AND score >= 0.5").collect()}
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id in spoken]
    first = {i for i, _, c in brute(rows) if i == c}
    windows = set()
    for r in spark.read.parquet(f"{SF_TINY}/benchmark.parquet").collect():
        w = words(ALNUM_WORDS, r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(len(w) - 9)}
    clean = {i for i, t in rows if i in first
             and not any(tuple(w[k:k + 10]) in windows for w in [words(ALNUM_WORDS, t)] for k in range(len(w) - 9))}
    out = pipeline.run(spark, SF_TINY)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == clean


def test_odd_documents_pass_through_every_stage(spark, pipeline):
    rows = [(1, None, None), (2, "", "en"), (3, "the cat sat on the mat and so on", "en"), (None, "the dog and the cat", "en"),
            (4, "the cat sat on the mat and so on", "en"), (4, "the cat sat on the mat and so on", "en")]
    more = [(20 + i, f"horse {i} ran over hill {i * 7} with friend {i * 11} at noon", "en") for i in range(6)]  # to learn from
    current = docs(spark, rows + more)
    for _, stage in pipeline.STAGES:
        current = spark.createDataFrame((out := stage(spark, current, SF_TINY)).collect(), out.schema)
    assert {r.doc_id for r in current.collect()} == {3, None, *(i for i, _, _ in more)}
    empty = docs(spark, [])
    for _, stage in pipeline.STAGES:
        empty = spark.createDataFrame((out := stage(spark, empty, SF_TINY)).collect(), out.schema)
        assert empty.count() == 0
