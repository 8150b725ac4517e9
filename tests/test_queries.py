"""Every registered query against its SQL twin, and rules about plans."""

import math

import pytest

from conftest import TESTDATA, plan_of
from larder.plans import catalog
from larder.plans.registry import QUERIES, SQL

FOLDER = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in sorted(FOLDER.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def canonical(frame):
    import pandas as pd

    def cell(value):
        if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
            return None
        value = value.item() if hasattr(value, "item") else value
        return round(value, 8) + 0.0 if isinstance(value, float) else value

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER)).toPandas()
    expected = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)


def test_names_and_twins():
    assert set(SQL) <= set(QUERIES) == set(catalog.QUERIES)
    without = sorted(set(QUERIES) - set(SQL))
    assert without == ["evl08_rouge_l_stemmed", "ml01_kmeans", "ml02_sweep", "ml04_projection", "ret04_approximate_matches", "ret04_approximate_top_k"]


@pytest.mark.parametrize(
    "name",
    ["prj04_search_text", "win02_dedup_by_name", "agg02_ingredient_index", "jon01_similarity_join", "ret02_text_top_k",
     "ret03_by_ingredients", "ret07_batch_answers", "evl03_ndcg_at_k", "evl07_bleu", "jon02_similar_pairs", "agg05_histogram"],
)
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, str(FOLDER)))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["set02_distinct_by_id"](spark, str(FOLDER)))
    assert "l_shipdate" not in plan.split("Physical Plan")[-1]
    plan = plan_of(QUERIES["ret02_category_strict"](spark, str(FOLDER)))
    assert "lower(lang" in plan.split("Physical Plan")[-1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2500
    assert set(entry.oracle_sql()) <= set(entry.queries())
