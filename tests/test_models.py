"""Golden rows for every CASE branch and null rule of the facts and reconciliations."""

import datetime as dt
from decimal import Decimal as D

from tillroll.plans import marts, recon

T = dt.datetime(2024, 1, 7, 10)  # a Sunday


def stg_orders(spark, rows):
    return spark.createDataFrame(
        [(i, f"ORD-{i}", c, s, D(st), D(dc), D("0"), D("0"), D(tot), None, None, "X", "Y", T, T)
         for i, c, s, st, dc, tot in rows],
        "order_id long, order_number string, customer_id long, order_status string, subtotal decimal(38,9), "
        "discount_amount decimal(38,9), tax_amount decimal(38,9), shipping_amount decimal(38,9), "
        "total_amount decimal(38,9), shipping_city string, notes string, shipping_state string, "
        "shipping_country string, ordered_at timestamp, updated_at timestamp")


def test_fct_orders_branches(spark):
    o = stg_orders(spark, [(1, 10, "delivered", "10", "1", "9"), (2, 10, "cancelled", "5", "0", "5"),
                           (3, 11, "returned", "5", "0", "5"), (4, 99, "pending", "5", "0", "5"),
                           (5, 10, None, "5", "0", "5"), (6, 10, "shipped", "5", "0", "5")])
    c = spark.createDataFrame([(10, "A B", "a@x", "C", "S", "US"), (11, None, "b@x", "C", "S", "US")],
                              "customer_id long, full_name string, email string, city string, state string, country string")
    items = spark.createDataFrame([(1, 1, 2, D("4"), D("0.5")), (2, 1, 1, D("6"), D("0.5"))],
                                  "order_item_id long, order_id long, quantity int, item_total decimal(38,9), "
                                  "item_discount_amount decimal(38,9)")
    pays = spark.createDataFrame([(1, "card", "completed", D("9"), T), (1, "card", "refunded", D("1"), T)],
                                 "order_id long, payment_method string, payment_status string, "
                                 "payment_amount decimal(38,9), paid_at timestamp")
    refs = spark.createDataFrame([(1, D("2")), (1, D("1"))], "order_id long, refund_amount decimal(38,9)")
    f = marts.fct_orders(o, c, items, pays, refs)
    rows = {(r["order_id"], r["payment_status"]): r for r in f.collect()}
    assert len(rows) == 7  # order 1 fans out over its two payments
    cat = {k[0]: r["order_status_category"] for k, r in rows.items()}
    assert cat == {1: "completed", 2: "closed", 3: "closed", 4: "open", 5: "in_progress", 6: "in_progress"}
    r1 = rows[(1, "completed")]
    assert (r1["item_count"], r1["total_quantity"], r1["item_discount_amount"]) == (2, 3, D("1"))
    assert r1["total_discount_amount"] == D("2") and r1["refund_count"] == 2 and r1["has_refund"] is True
    assert r1["net_revenue"] == D("6") and r1["order_day_of_week"] == 1
    r2 = rows[(2, None)]
    assert (r2["item_count"], r2["refund_amount"], r2["has_refund"], r2["net_revenue"]) == (0, D("0"), False, D("5"))
    assert rows[(3, None)]["customer_name"] is None and rows[(4, None)]["customer_email"] is None


def test_recon_orders_vs_items(spark):
    o = stg_orders(spark, [(1, 1, "x", "10.00", "0", "0"), (2, 1, "x", "10.03", "0", "0"), (3, 1, "x", "0.02", "0", "0")])
    items = spark.createDataFrame([(1, D("9.98")), (2, D("10.00"))], "order_id long, item_total decimal(38,9)")
    r = {x["order_id"]: x for x in recon.recon_orders_vs_items(o, items, "2024-01-01 00:00:00").collect()}
    assert r[1]["status"] == "matched" and r[1]["discrepancy"] == D("0.02")
    assert r[2]["status"] == "discrepancy" and r[2]["discrepancy"] == D("0.03")
    assert r[3]["items_subtotal"] == D("0") and r[3]["status"] == "matched"
    assert r[1]["reconciled_at"] == dt.datetime(2024, 1, 1)


def test_recon_payments_vs_refunds(spark):
    p = spark.createDataFrame([(1, "completed", D("10")), (2, "refunded", D("10")), (3, "completed", D("10")),
                               (4, "failed", D("10"))], "order_id long, payment_status string, payment_amount decimal(38,9)")
    r = spark.createDataFrame([(1, "processed", D("12")), (2, "processed", D("10")), (3, "pending", D("5"))],
                              "order_id long, refund_status string, refund_amount decimal(38,9)")
    out = {x["order_id"]: x for x in recon.recon_payments_vs_refunds(p, r, "2024-01-01 00:00:00").collect()}
    assert set(out) == {1, 2, 3}  # only orders with a qualifying payment
    assert out[1]["refund_status"] == "over_refunded" and out[1]["net_collected"] == D("-2")
    assert out[2]["refund_status"] == "partially_refunded"  # a full refund counts as partial
    assert out[3]["refund_status"] == "no_refund" and out[3]["total_refunded"] == D("0")


def test_recon_marketing_profitability(spark):
    d = dt.date(2024, 3, 5)
    f = spark.createDataFrame(
        [("a", d, D("10"), D("30"), 100, 10, 2), ("b", d, D("10"), D("10"), 100, 0, 0),
         ("c", d, D("10"), D("5"), 0, 0, 0), ("d", d, D("0"), D("5"), 0, 0, 0)],
        "platform string, performance_date date, spend decimal(38,9), revenue decimal(38,9), impressions int, "
        "clicks int, purchases int")
    out = {x["platform"]: x for x in recon.recon_marketing_spend_vs_revenue(f, "2024-01-01 00:00:00").collect()}
    assert out["a"]["profitability_status"] == "profitable" and out["a"]["roas"] == D("3")
    assert out["a"]["cpa"] == D("5") and out["a"]["avg_ctr"] == 0.1
    assert out["b"]["profitability_status"] == "break_even" and out["b"]["cpa"] is None
    assert out["c"]["profitability_status"] == "unprofitable" and out["c"]["avg_ctr"] is None
    assert out["d"]["roas"] is None and out["d"]["profitability_status"] == "unprofitable"
    assert (out["a"]["year"], out["a"]["month"]) == (2024, 3)


def test_fct_orders_plan(spark):
    """Without broadcasts: 8 scans and 5 sort-merge joins."""
    from tillroll.plans.models import RetailModels
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = RetailModels.from_driver_tables(spark, "/root/testdata/sf0.001").fct_orders._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FileScan") <= 8 and plan.count("SortMergeJoin") <= 5


def test_order_with_over_a_thousand_lines_has_distinct_item_ids(spark, tmp_path):
    from pyspark.sql import functions as F

    from tillroll.sources import fixtures as fx
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    one = li.limit(1).crossJoin(spark.range(1500).withColumnRenamed("id", "k")).withColumn("l_partkey", F.col("k")).drop("k")
    li.unionByName(one.withColumn("l_orderkey", F.lit(1).cast("long"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    items = fx.order_items(fx.DriverTables(spark, str(tmp_path)))
    assert items.count() == items.select("id").distinct().count() == li.count() + 1500


def test_recon_marketing_beyond_1e11(spark):
    f = spark.createDataFrame([("a", dt.date(2024, 3, 5), D("1000000000000"), D("3000000000000"), 100, 10, 2)],
                              "platform string, performance_date date, spend decimal(38,9), revenue decimal(38,9), impressions int, "
                              "clicks int, purchases int")
    r = recon.recon_marketing_spend_vs_revenue(f, "2024-01-01 00:00:00").first()
    assert r["roas"] == D("3") and r["cpa"] == D("500000000000")


def test_lines_are_numbered_once_for_all_feeds_of_a_run(spark, scratch):
    from tillroll.sources import fixtures as fx
    plain, landed = fx.raw_feeds(spark, "/root/testdata/sf0.001"), fx.raw_feeds(spark, "/root/testdata/sf0.001", f"{scratch}/lines")
    for name in ("order_items", "refunds", "inventory_movements"):
        assert "Window" not in landed[name]._jdf.queryExecution().executedPlan().toString()
        assert landed[name].dtypes == plain[name].dtypes
        assert landed[name].exceptAll(plain[name]).isEmpty() and landed[name].count() == plain[name].count()
