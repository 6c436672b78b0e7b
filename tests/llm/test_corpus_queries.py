"""Every corpus query and the pipeline over a small table of odd rows; those with SQL against DuckDB."""

from __future__ import annotations

import pytest

import corpus_pipeline
from ridemill.llm import queries as corpus

from . import cases

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = corpus.queries(), corpus.oracle_sql()
#: Queries with other rows than one for each document.
OTHER_ROWS = {"op5_packing", "op7_html_text", "op13_filter_audit"}
TABLES = ("documents", "labels", "pages")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("odd"))
    texts = [(i, t) for i, (_, t) in enumerate(cases.odd_texts())]
    texts += [(100 + i, cases.prose(i, 250)) for i in range(12)]
    cases.table(spark, texts).write.parquet(f"{place}/documents.parquet")
    labels = spark.createDataFrame([(d, d % 2, d % 3 // 2, "x") for d, _ in texts] + [(None, 1, 0, "x"), (7, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    labels.write.parquet(f"{place}/labels.parquet")
    pages = [(1, None, None), (2, "http://a.example/", "<article><p>Text.</p></article>"), (3, "http://a.example/", "plain"), (3, "http://a.example/", "plain")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{place}/pages.parquet")
    return place


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").where("false").write.parquet(f"{place}/{name}.parquet")
    return place


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_over_odd_rows(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    rows = found.collect()
    if name not in OTHER_ROWS:
        ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
    if name in SQL:
        duck = duckdb.connect()
        for table in TABLES:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet/*.parquet'")
        wanted = duck.execute(SQL[name])
        columns = [d[0] for d in wanted.description]
        assert in_order(found.columns, rows) == in_order(columns, wanted.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_query_over_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_pipeline_over_odd_rows(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    own = {r.doc_id for r in rows}
    # Clean documents stay; null, empty and very short ones go.
    assert set(range(100, 112)) <= own
    assert not own & {0, 1, 2, 3, 4}


def test_pipeline_over_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
