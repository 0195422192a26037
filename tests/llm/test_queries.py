"""Registered text queries against their SQL, and the pipeline's stages."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_lines
from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.SQL[name]).df()
    cols = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == cols
    tidy = lambda d: d[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(tidy(got), tidy(want), check_dtype=False, rtol=1e-12)


def test_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        path = corpus_pipeline.materialise(out, f"test-{name}")
        assert path.count() <= docs.count()
        docs = path
    assert docs.count() < before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(mixed) == docs.count() and sum(r.taken for r in mixed) > 0


def test_stages_match_plain_results_on_their_input(spark):
    """Line dedup, near duplicates and mixing; quality and decontamination are not covered here."""
    stages = dict(corpus_pipeline.STAGES)
    docs = corpus_pipeline.materialise(stages["quality_rules"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), "test-plain")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len({i for i, _ in rows} - {None}) == len(rows)
    docs = corpus_pipeline.materialise(stages["line_dedup"](spark, docs, SF), "test-plain")
    rows, want = [(r.doc_id, r.text) for r in docs.collect()], brute_lines(rows, 2)
    assert len(rows) == len(want) and dict(rows) == want
    docs = corpus_pipeline.materialise(stages["minhash_near_dedup"](spark, docs, SF), "test-plain")
    want = sorted(i for i, first in brute_components(rows, 5).items() if i == first)
    rows = docs.toPandas()
    assert sorted(rows["doc_id"]) == want
    con = duckdb.connect()
    con.register("documents", rows)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    tidy = lambda d: d[cols].sort_values("doc_id").reset_index(drop=True)
    got = stages["source_mixing"](spark, docs, SF).toPandas()
    pd.testing.assert_frame_equal(tidy(got), tidy(con.execute(queries.SQL["op5_mixing"]).df()), check_dtype=False, rtol=1e-12)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
