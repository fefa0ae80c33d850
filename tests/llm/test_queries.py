"""Registered queries against their SQL, and the pipeline against its operators."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from shopgrain.llm import oracle, queries
from shopgrain.llm.common import settled

from .test_documents import brute_components, brute_groups, brute_quality


def canonical(table):
    names = sorted(table.column_names)
    return names, sorted(
        zip(*[table.column(n).to_pylist() for n in names], strict=True),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_sql(spark, folder, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = canonical(queries.queries()[name](spark, folder).toArrow())
    expected = canonical(duck.execute(oracle.oracle_sql()[name]).to_arrow_table())
    assert found == expected


def test_native_plans_run_no_python(spark, folder):
    for name in ("op3_quality_rules", "op5_url_filters", "op10_license_scan"):
        plan = queries.queries()[name](spark, folder)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, folder))
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in docs.collect()}
    whole = corpus_pipeline.run(spark, folder)
    pieces = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert whole.select(*pieces).exceptAll(last.select(*pieces)).count() == 0


def test_pipeline_keeps_what_brute_force_keeps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = []
    for r in docs:
        n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat = brute_quality(r.text)
        fails = (
            n_words < 50
            or 100 * n_repeat > 50 * n_words
            or 10 * n_symbols > n_words
            or 100 * n_dup_lines > 40 * n_lines
            or not 3 * n_words <= word_chars <= 10 * n_words
        )
        if not fails:
            rows.append((r.doc_id, r.text))
    assert all(any(c.isalpha() for c in text) for _, text in rows)  # every language here is learned
    texts = dict(rows)
    rows = [(r[0], texts[r[0]]) for r in brute_groups(rows) if r[3]]
    expected = {r[0] for r in brute_components(rows) if r[3]}
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == expected


def test_pipeline_takes_edge_cases(spark, edge, folder):
    docs = edge
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, folder))
        assert docs.columns == edge.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
