"""Reconciliation models M3-M5.

``run_ts`` replaces ``current_timestamp()`` so that a rerun over the same input is identical.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import NUMERIC, float_ratio, nullif_zero, numeric_ratio, numeric_subtract

MATCH_TOLERANCE = "0.02"


def _run_ts(run_ts) -> F.Column:
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(run_ts)).cast("timestamp")


def recon_orders_vs_items(stg_orders: DataFrame, stg_order_items: DataFrame, run_ts=None) -> DataFrame:
    """M3: order subtotal against the sum of item totals."""
    items = stg_order_items.groupBy("order_id").agg(F.sum("item_total").alias("items_subtotal"))
    o = stg_orders.select("order_id", F.col("subtotal").alias("order_subtotal"))
    j = o.join(items, "order_id", "left")
    items_sub = F.coalesce(F.col("items_subtotal"), F.lit(0).cast(NUMERIC))
    diff = numeric_subtract("order_subtotal", items_sub)
    return j.select(
        "order_id",
        F.col("order_subtotal").cast(NUMERIC).alias("order_subtotal"),
        items_sub.cast(NUMERIC).alias("items_subtotal"),
        F.round(diff, 2).cast(NUMERIC).alias("discrepancy"),
        F.when(F.abs(diff) <= F.lit(MATCH_TOLERANCE).cast("decimal(3,2)"), "matched")
        .otherwise("discrepancy").alias("status"),
        _run_ts(run_ts).alias("reconciled_at"),
    )


def recon_payments_vs_refunds(stg_payments: DataFrame, stg_refunds: DataFrame, run_ts=None) -> DataFrame:
    """M4: completed/refunded payments against processed refunds, per order."""
    paid = (stg_payments.filter(F.col("payment_status").isin("completed", "refunded"))
            .groupBy("order_id").agg(F.sum("payment_amount").alias("total_paid")))
    refunded = (stg_refunds.filter(F.col("refund_status") == "processed")
                .groupBy("order_id").agg(F.sum("refund_amount").alias("total_refunded")))
    j = paid.join(refunded, "order_id", "left")
    ref = F.coalesce(F.col("total_refunded"), F.lit(0).cast(NUMERIC))
    return j.select(
        "order_id",
        F.col("total_paid").cast(NUMERIC).alias("total_paid"),
        ref.cast(NUMERIC).alias("total_refunded"),
        numeric_subtract("total_paid", ref).alias("net_collected"),
        F.when(ref > F.col("total_paid"), "over_refunded")
        .when(ref > 0, "partially_refunded")
        .otherwise("no_refund").alias("refund_status"),
        _run_ts(run_ts).alias("reconciled_at"),
    )


def recon_marketing_spend_vs_revenue(fct_daily_marketing_performance: DataFrame, run_ts=None) -> DataFrame:
    """M5: monthly spend vs revenue by platform (A6). Few groups: partial aggregation keeps
    the shuffle to (#map partitions x #groups) rows whatever the fact size."""
    f = fct_daily_marketing_performance
    g = f.groupBy("platform", F.year("performance_date").alias("year"),
                  F.month("performance_date").alias("month")).agg(
        F.sum("spend").alias("total_spend"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("purchases").alias("total_purchases"),
    )
    roas = numeric_ratio("total_revenue", "total_spend")
    return g.select(
        "platform", "year", "month",
        F.col("total_spend").cast(NUMERIC).alias("total_spend"),
        F.col("total_revenue").cast(NUMERIC).alias("total_revenue"),
        F.col("total_impressions").cast("long").alias("total_impressions"),
        F.col("total_clicks").cast("long").alias("total_clicks"),
        F.col("total_purchases").cast("long").alias("total_purchases"),
        roas.alias("roas"),
        numeric_ratio("total_spend", nullif_zero("total_purchases")).alias("cpa"),
        float_ratio("total_clicks", nullif_zero("total_impressions")).alias("avg_ctr"),
        F.when(roas >= 3.0, "profitable").when(roas >= 1.0, "break_even")
        .otherwise("unprofitable").alias("profitability_status"),
        _run_ts(run_ts).alias("reconciled_at"),
    )
