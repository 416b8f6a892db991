"""M1 kept up load by load: equal to the fact built from the raw tables, and only affected orders are written."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

import queries_ext as Q
from tillroll.plans import order_facts, run
from tillroll.plans.models import RetailModels
from tillroll.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
MOST_EXCHANGES = 30


def load(spark, root, tables, number):
    for name, df in tables.items():
        run.raw_table(spark, root, name).upsert(df, ["id"], f"{name}-{number}", number)


def rows(df, columns):
    return sorted(map(str, df.select(columns).collect()))


def same_as_built(spark, root):
    want = RetailModels({**fx.raw_feeds(spark, SF), **run.read_raw(spark, root)}).fct_orders
    got = order_facts.read_order_facts(spark, root)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, want.columns) == rows(want, want.columns)
    return len(want.columns)


def test_three_loads(spark, scratch):
    loads = Q.order_loads(fx.raw_feeds(spark, SF))
    with pytest.raises(ValueError, match="payments"):
        load(spark, scratch, {"orders": loads[0]["orders"]}, 1)
        order_facts.refresh_order_facts(spark, scratch)
    for number, tables in enumerate(loads, 1):
        load(spark, scratch, tables, number)
        order_facts.refresh_order_facts(spark, scratch)
        same_as_built(spark, scratch)


def test_only_affected_orders_are_written(spark, scratch):
    feeds = fx.raw_feeds(spark, SF)
    load(spark, scratch, {n: feeds[n] for n in order_facts.TABLES}, 1)
    order_facts.refresh_order_facts(spark, scratch)
    table = order_facts._facts(spark, scratch)
    # One payment moves to another order, which has two then and its own none; one order's customer changes a name.
    moved = feeds["payments"].orderBy("id").limit(1).withColumn("order_id", F.lit(3).cast("long"))
    load(spark, scratch, {"payments": moved}, 2)
    order_facts.refresh_order_facts(spark, scratch)
    same_as_built(spark, scratch)
    new = table.read().where(F.col("_load_seq") == 2).select("order_id", "payment_id", order_facts.GONE).collect()
    assert len({r.order_id for r in new}) == 2 and sum(r[order_facts.GONE] for r in new) == 1
    assert order_facts.read_order_facts(spark, scratch).where("order_id = 3").count() == 2
    # Nothing new: no version.
    at = table.current_version()
    order_facts.refresh_order_facts(spark, scratch)
    assert table.current_version() == at == 2
    # The payment goes back: the marked row is there again.
    load(spark, scratch, {"payments": feeds["payments"].orderBy("id").limit(1)}, 3)
    order_facts.refresh_order_facts(spark, scratch)
    same_as_built(spark, scratch)


def test_versions_no_longer_kept(spark, scratch):
    feeds = fx.raw_feeds(spark, SF)
    load(spark, scratch, {n: feeds[n] for n in order_facts.TABLES}, 1)
    order_facts.refresh_order_facts(spark, scratch)
    one = feeds["customers"].where("id = 1")
    for number in range(2, 6):
        load(spark, scratch, {"customers": one.withColumn("city", F.lit(f"city {number}"))
                              .withColumn("updated_at", F.lit(dt.datetime(2030, 1, number)))}, number)
    assert run.raw_table(spark, scratch, "customers").manifest(1) is None
    order_facts.refresh_order_facts(spark, scratch)
    same_as_built(spark, scratch)


def test_a_refresh_is_several_queries(spark, scratch, monkeypatch):
    """The driver holds all stages of a query until it ends: the query that writes the fact must not have those of every table."""
    import os
    upsert, plans = run.merge.MergedTable.upsert, []

    def seen(table, batch, *args, **kw):
        if table.root.endswith("fct_orders_live"):
            plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return upsert(table, batch, *args, **kw)

    monkeypatch.setattr(run.merge.MergedTable, "upsert", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        for number, tables in enumerate(Q.order_loads(fx.raw_feeds(spark, SF)), 1):
            load(spark, scratch, tables, number)
            order_facts.refresh_order_facts(spark, scratch)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    same_as_built(spark, scratch)
    assert len(plans) == 3 and max(p.count("Exchange") for p in plans) <= MOST_EXCHANGES
    assert not any("order_items" in p for p in plans[1:])
    assert os.listdir(f"{scratch}/mart/fct_orders_live/building") == []
