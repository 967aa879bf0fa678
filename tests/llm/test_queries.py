"""The queries of the operators beside their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from checks import compare
from rowmill.llm import decontaminate, language, minhash, pii
from rowmill.llm.queries import QUERIES
from rowmill.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with duckdb.connect() as c:
        for t in compare.TABLES:
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        yield c


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, connection, monkeypatch, name):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLE, name, ORACLE[name])
    assert compare.differences(spark, connection, name, SF) == []


def test_there_is_a_query_for_each_operator():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_language_on_held_out_documents(spark, connection):
    found = {r.doc_id: r for r in QUERIES["op3_language"](spark, SF).collect()}
    real = dict(connection.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = [r.lang_pred == real[k] for k, r in found.items() if r.held_out]
    assert set(found) == set(real) and sum(held) / len(held) >= 0.9


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").persist()
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    first = stages["language identification"](spark, docs, SF).persist()
    named = language.identify(docs, language.fit(docs)).collect()
    assert ids(first) == {r.doc_id for r in named if r.lang_pred != "und" and not r.ambiguous}

    second = stages["near-duplicate removal"](spark, first, SF).persist()
    near = minhash.near_documents(first, shingle=5, percent=80).collect()
    assert ids(second) == {r.doc_id for r in near if r.kept}
    assert second.count() == len(ids(second))

    third = stages["benchmark decontamination"](spark, second, SF).persist()
    hits = decontaminate.find_hits(second, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids(third) == {r.doc_id for r in hits if not r.hit_words}

    fourth = stages["personal data"](spark, third, SF).persist()
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (third, fourth))
    assert set(before) == set(after)
    assert all(after[k] == t for k, t in before.items() if not pii.islands(t))
    assert not any(pii.base_spans(t) for t in after.values())
    assert all(r.n_chars == len(r.text) for r in fourth.collect())
    assert first.columns == second.columns == third.columns == fourth.columns == docs.columns

    last = stages["best-fit packing"](spark, fourth, SF)
    assert ids(last) == ids(fourth)
