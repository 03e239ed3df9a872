"""The registered queries against their SQL, and the stages against what they promise."""

import sys
from collections import Counter

import pytest
from cases import docs, empty
from fieldmart.llm import classifier, decontaminate, queries, simhash
from oracle_compare import connect, differences

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_as_sql(spark, name):
    assert differences(queries.RUNS[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) == []


def test_one_query_for_each_operator():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.RUNS} == {f"op{i}" for i in range(1, 14)}
    assert names >= {*queries.RUNS, "pipeline"}


def test_stages(spark, tmp_path):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [frame]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], FOLDER).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    scored, kept, clean, mixed, tokens = seen[1:]
    assert all(f.columns == frame.columns for f in (scored, kept, clean, mixed))
    rejected = classifier.scores(frame, spark.read.parquet(f"{FOLDER}/labels.parquet")).filter("predicted = 0").count()
    assert scored.count() == frame.count() - rejected
    assert kept.count() == simhash.near_duplicates(scored).select("root").distinct().count()
    bad = decontaminate.contamination(kept, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).filter("contaminated").count()
    assert clean.count() == kept.count() - bad
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in clean.select("doc_id").collect()}
    assert Counter(r.doc_id for r in tokens.collect()) == times


def test_stages_take_awkward_rows(spark, tmp_path):
    """With columns of the names that operators use: all values come back as they were."""
    for k, frame in enumerate((docs(spark), empty(spark))):
        given = {tuple(r) for r in frame.collect()}
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, frame, FOLDER).write.parquet(str(tmp_path / f"{k}-{i}"))
            before, frame = frame, spark.read.parquet(str(tmp_path / f"{k}-{i}"))
            if i + 1 < len(corpus_pipeline.STAGES):
                assert frame.columns == before.columns
                assert {tuple(r) for r in frame.collect()} <= given


def test_entry_without_the_optional_part(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "fieldmart.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline")
    monkeypatch.delitem(sys.modules, "fieldmart.llm.queries")
    try:
        plain = importlib.reload(entry)
        assert set(plain.queries()) == set(plain.RUNS) and set(plain.oracle_sql()) == set(plain.SQL)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
