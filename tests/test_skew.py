"""One key with a third of all rows must not stay in one task: the joins that
meet it are plain exchanges, which adaptive execution splits."""
import pytest

from shelfwise.operators import collab, evaluate, search

SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "24"}


@pytest.fixture()
def hot(spark):
    """Reviews of which one product has a third, under low skew thresholds."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    df = spark.range(60_000).selectExpr(
        "id as customer_id", "if(id % 3 = 0, -1, id % 2000) as product_id", "cast(id % 5 + 1 as double) as rating")
    yield df
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df = df.groupBy().count()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_copurchasers_split_the_hot_product(hot):
    assert "skew=true" in _final_plan(search.copurchasers(hot))


def test_item_frequency_join_splits_the_hot_product(hot):
    inter = collab.interactions(hot)
    freq = collab.materialize(collab.item_frequency(inter), "frequency")
    assert "skew=true" in _final_plan(inter.select("customer_id", "product_id").join(freq, "product_id"))


def test_mean_baseline_splits_the_hot_product(hot):
    train, test = evaluate.train_test_split(hot, ["customer_id", "product_id"], 0.5)
    assert "skew=true" in _final_plan(evaluate.mean_baseline_predictions(train, test))
