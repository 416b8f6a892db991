"""Fact tables M1 (fct_orders) and M2 (fct_daily_marketing_performance).

Physical plan at scale (see README "Plans"): every order-keyed input of ``fct_orders`` is
aggregated to one row per ``order_id`` *before* the join (partial aggregation on the map side,
so a hot order never crosses the shuffle as raw rows); orders, the item and refund aggregates
and payments then meet in left joins on ``order_id``, where AQE splits a skewed left partition.
Customers join last on ``customer_id``; Spark broadcasts them only when their measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), else shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import NUMERIC, day_of_week, float_ratio, nullif_zero, numeric_add, numeric_ratio, numeric_subtract


def order_status_category(status) -> F.Column:
    """Delivered -> completed; cancelled/returned -> closed; pending -> open; else in_progress."""
    s = F.col(status) if isinstance(status, str) else status
    return (F.when(s == "delivered", "completed")
            .when(s.isin("cancelled", "returned"), "closed")
            .when(s == "pending", "open")
            .otherwise("in_progress"))


def item_totals(stg_order_items: DataFrame) -> DataFrame:
    """A1: per order count, quantity, item total and item discount."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("item_total").alias("items_subtotal"),
        F.sum("item_discount_amount").alias("items_discount_total"),
    )


def refund_totals(stg_refunds: DataFrame) -> DataFrame:
    """A2: refunds per order, every status."""
    return stg_refunds.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("refund_count"),
        F.sum("refund_amount").alias("total_refund_amount"),
    )


def fct_orders(stg_orders: DataFrame, stg_customers: DataFrame, stg_order_items: DataFrame,
               stg_payments: DataFrame, stg_refunds: DataFrame, with_payment_id: bool = False) -> DataFrame:
    """M1. ``with_payment_id`` adds the payment's id, which with the order's tells the rows apart."""
    return order_fact(stg_orders, stg_customers, item_totals(stg_order_items), stg_payments, refund_totals(stg_refunds), with_payment_id)


def order_fact(stg_orders: DataFrame, stg_customers: DataFrame, items: DataFrame, stg_payments: DataFrame, refunds: DataFrame,
               with_payment_id: bool = False) -> DataFrame:
    """M1 from the orders' ``item_totals`` and ``refund_totals``."""
    o = stg_orders.alias("o")
    c = stg_customers.select("customer_id", "full_name", "email", "city", "state", "country").alias("c")
    oi = items.alias("oi")
    # Payments are not aggregated; an order with two payments yields two rows (kept on purpose).
    r = refunds.alias("r")

    zero = F.lit(0).cast(NUMERIC)
    item_disc = F.coalesce(F.col("o.oi_items_discount_total"), zero)
    refund_amt = F.coalesce(F.col("o.r_total_refund_amount"), zero)
    # Per-order aggregates first (one row per order), then the payment fan-out, then customers.
    by_order = (
        o.join(oi, F.col("o.order_id") == F.col("oi.order_id"), "left")
        .join(r, F.col("o.order_id") == F.col("r.order_id"), "left")
        .select("o.*", *[F.col(f"oi.{x}").alias(f"oi_{x}") for x in ("item_count", "total_quantity",
                                                                      "items_discount_total")],
                *[F.col(f"r.{x}").alias(f"r_{x}") for x in ("refund_count", "total_refund_amount")])
    )
    pays = stg_payments.select(F.col("order_id").alias("p_order_id"), *[F.col(x).alias(f"p_{x}") for x in (
        *(["payment_id"] if with_payment_id else []), "payment_method", "payment_status", "payment_amount", "paid_at")])
    joined = (by_order.join(pays, F.col("order_id") == F.col("p_order_id"), "left").alias("o")
              .join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left"))
    return joined.select(
        F.col("o.order_id").alias("order_id"),
        F.col("o.order_number").alias("order_number"),
        F.col("o.ordered_at").alias("ordered_at"),
        F.col("o.updated_at").alias("order_updated_at"),
        F.col("o.customer_id").alias("customer_id"),
        F.col("c.full_name").alias("customer_name"),
        F.col("c.email").alias("customer_email"),
        F.col("c.city").alias("customer_city"),
        F.col("c.state").alias("customer_state"),
        F.col("c.country").alias("customer_country"),
        F.col("o.order_status").alias("order_status"),
        order_status_category(F.col("o.order_status")).alias("order_status_category"),
        F.coalesce(F.col("o.oi_item_count"), F.lit(0)).cast("long").alias("item_count"),
        F.coalesce(F.col("o.oi_total_quantity"), F.lit(0)).cast("long").alias("total_quantity"),
        F.col("o.subtotal").cast(NUMERIC).alias("subtotal"),
        F.col("o.discount_amount").cast(NUMERIC).alias("order_discount_amount"),
        item_disc.cast(NUMERIC).alias("item_discount_amount"),
        numeric_add("o.discount_amount", item_disc).alias("total_discount_amount"),
        F.col("o.tax_amount").cast(NUMERIC).alias("tax_amount"),
        F.col("o.shipping_amount").cast(NUMERIC).alias("shipping_amount"),
        F.col("o.total_amount").cast(NUMERIC).alias("order_total"),
        F.col("o.p_payment_method").alias("payment_method"),
        F.col("o.p_payment_status").alias("payment_status"),
        F.col("o.p_payment_amount").cast(NUMERIC).alias("payment_amount"),
        F.col("o.p_paid_at").alias("paid_at"),
        F.coalesce(F.col("o.r_refund_count"), F.lit(0)).cast("long").alias("refund_count"),
        refund_amt.cast(NUMERIC).alias("refund_amount"),
        F.coalesce(F.col("o.r_refund_count") > 0, F.lit(False)).alias("has_refund"),
        numeric_subtract("o.total_amount", refund_amt).alias("net_revenue"),
        F.col("o.shipping_city").alias("shipping_city"),
        F.col("o.shipping_state").alias("shipping_state"),
        F.col("o.shipping_country").alias("shipping_country"),
        F.to_date(F.col("o.ordered_at")).alias("order_date"),
        F.year(F.col("o.ordered_at")).alias("order_year"),
        F.month(F.col("o.ordered_at")).alias("order_month"),
        day_of_week(F.col("o.ordered_at")).alias("order_day_of_week"),
        *([F.col("o.p_payment_id").alias("payment_id")] if with_payment_id else []),
    )


def fct_daily_marketing_performance(stg_daily_performance: DataFrame, stg_ads: DataFrame,
                                    stg_ad_sets: DataFrame, stg_campaigns: DataFrame) -> DataFrame:
    """M2 with J5-J7.

    The dimension chain ads -> ad_sets -> campaigns is joined first (left joins whose predicates
    reject nulls on the inner side are associative), so the fact table is joined exactly once,
    on ``ad_id``. Nothing is broadcast by hint: Spark broadcasts a dimension whose size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a larger one.
    """
    a = stg_ads.select("ad_id", "ad_set_id", "ad_name", "ad_type", "call_to_action", "ad_status")
    s = stg_ad_sets.select(F.col("ad_set_id").alias("_ast_id"), F.col("campaign_id").alias("_campaign_fk"), "ad_set_name", "bid_strategy",
                           "targeting_gender", "targeting_age_min", "targeting_age_max")
    c = stg_campaigns.select("campaign_id", "campaign_name", "platform", "objective", "campaign_status")
    dims = (
        a.join(s, F.col("ad_set_id") == F.col("_ast_id"), "left")
        .join(c, F.col("_campaign_fk") == F.col("campaign_id"), "left")
        # ad_set_id comes from the ad-set side: null when the ad set is missing.
        .select("ad_id", "ad_name", "ad_type", "call_to_action", "ad_status",
                F.col("_ast_id").alias("ad_set_id"),
                "ad_set_name", "bid_strategy", "targeting_gender", "targeting_age_min", "targeting_age_max",
                "campaign_id", "campaign_name", "platform", "objective", "campaign_status")
    )
    dp = stg_daily_performance.alias("dp")
    j = dp.join(dims.alias("d"), F.col("dp.ad_id") == F.col("d.ad_id"), "left")
    date = F.col("dp.performance_date")
    return j.select(
        F.col("dp.performance_id").alias("performance_id"),
        date.alias("performance_date"),
        F.col("d.campaign_id").alias("campaign_id"),
        "campaign_name", "platform", "objective", "campaign_status",
        F.col("d.ad_set_id").alias("ad_set_id"),
        "ad_set_name", "bid_strategy", "targeting_gender", "targeting_age_min", "targeting_age_max",
        F.col("d.ad_id").alias("ad_id"),
        "ad_name", "ad_type", "call_to_action", "ad_status",
        F.col("dp.impressions").alias("impressions"),
        F.col("dp.clicks").alias("clicks"),
        F.col("dp.spend").alias("spend"),
        F.col("dp.ctr").alias("ctr"),
        F.col("dp.cpc").alias("cpc"),
        F.col("dp.purchases").alias("purchases"),
        F.col("dp.revenue").alias("revenue"),
        numeric_ratio(F.col("dp.revenue"), F.col("dp.spend")).alias("roas"),
        numeric_ratio(F.col("dp.spend"), nullif_zero(F.col("dp.purchases"))).alias("cost_per_acquisition"),
        float_ratio(F.col("dp.purchases"), nullif_zero(F.col("dp.clicks"))).alias("conversion_rate"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        day_of_week(date).alias("day_of_week"),
    )
