"""Plan-shape invariants that matter at scale."""

import tempfile

import pytest

from conftest import SF_SMALL
from shelfwise.catalog import Catalog
from shelfwise.operators import collab, search
from shelfwise.plans import PLANS
from shelfwise.sources.testdata import catalog_from_tables

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_cross_products(spark, name):
    if name.startswith("als_"):
        pytest.skip("ALS plans are built by Spark ML")
    plan = _plan(PLANS[name].build(spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def test_topk_per_key_uses_window_group_limit(spark):
    c = catalog_from_tables(spark, SF_SMALL)
    model = collab.fit_similarity(c.reviews, persist=False)
    plan = collab.also_bought(model.edges, c.products, 10)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filters_reach_parquet_scan(spark):
    c = catalog_from_tables(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="shelfwise-cat-")
    c.save(path)
    stored = Catalog.load(spark, path)
    q = search.best_sellers(stored.products, "PROMO", 10)
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(category), EqualTo(category,PROMO)]" in text
    # column pruning: only the needed columns are read
    narrow = stored.products.where("category = 'PROMO'").select("product_id")
    scan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<product_id:bigint,category:string>" in scan


def test_scratch_scope_deletes_its_tables_only(spark):
    from shelfwise.session import materialize, scratch_scope
    kept = materialize(spark.range(5))
    with scratch_scope(spark):
        inside = materialize(spark.range(7))
        path = inside.inputFiles()[0]
        assert inside.count() == 7
    assert kept.count() == 5
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def test_drop_materialized(spark):
    from shelfwise.session import drop_materialized, materialize, scratch_path
    df = materialize(spark.range(10))
    assert df.count() == 10
    drop_materialized(spark)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    assert not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


@pytest.mark.parametrize("name, key, table, column, others", [
    ("user_cf_requested", "customer_id", "customer", "c_custkey", {-1, -2}),
    ("hybrid_recs_requested", "customer_id", "customer", "c_custkey", {-1, -2}),
    ("similar_products_requested", "target_id", "part", "p_partkey", {-5})])
def test_every_key_is_requested(spark, name, key, table, column, others):
    """No part of the keys is left out, and unknown ids are answered too."""
    asked = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(column).collect()} | others
    assert {r[0] for r in PLANS[name].build(spark, SF_SMALL).select(key).distinct().collect()} == asked
    assert "% 100" not in PLANS[name].sql
