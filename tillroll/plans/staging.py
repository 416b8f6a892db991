"""Staging projections P1-P12: one narrow ``select`` over one raw table each.

No filter, no dedupe. They stay lazy views (K4): Catalyst inlines them into the marts and
prunes every column a mart does not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clean, clean_lower, clean_upper, numeric, numeric_ratio

_TS = ["created_at", "updated_at"]


def _ts(*names) -> list:
    return [F.col(n).cast("timestamp").alias(n) for n in names]


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("customer_id"),
        clean_lower("email").alias("email"),
        clean("first_name").alias("first_name"),
        clean("last_name").alias("last_name"),
        # concat (not concat_ws): a null first or last name makes the full name null.
        F.concat(clean("first_name"), F.lit(" "), clean("last_name")).alias("full_name"),
        "phone", "date_of_birth", "gender",
        clean("address_line1").alias("address_line1"),
        clean("address_line2").alias("address_line2"),
        clean("city").alias("city"),
        clean_upper("state").alias("state"),
        clean("postal_code").alias("postal_code"),
        clean_upper("country").alias("country"),
        "is_active",
        *_ts(*_TS),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    price, cost = numeric("price"), numeric("cost_price")
    return raw.select(
        F.col("id").alias("product_id"),
        clean_upper("sku").alias("sku"),
        clean("name").alias("product_name"),
        F.col("description").alias("product_description"),
        "category_id",
        clean("brand").alias("brand"),
        price.alias("price"),
        cost.alias("cost_price"),
        numeric_ratio(price - cost, price, scale=4).alias("gross_margin"),
        clean("size").alias("size"),
        clean("color").alias("color"),
        clean("material").alias("material"),
        "stock_quantity", "is_active",
        *_ts(*_TS),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"),
        clean("order_number").alias("order_number"),
        "customer_id",
        clean_lower("status").alias("order_status"),
        numeric("subtotal").alias("subtotal"),
        numeric("discount_amount").alias("discount_amount"),
        numeric("tax_amount").alias("tax_amount"),
        numeric("shipping_amount").alias("shipping_amount"),
        numeric("total_amount").alias("total_amount"),
        clean("shipping_address_line1").alias("shipping_address_line1"),
        clean("shipping_address_line2").alias("shipping_address_line2"),
        clean("shipping_city").alias("shipping_city"),
        clean_upper("shipping_state").alias("shipping_state"),
        clean("shipping_postal_code").alias("shipping_postal_code"),
        clean_upper("shipping_country").alias("shipping_country"),
        "notes",
        F.col("created_at").cast("timestamp").alias("ordered_at"),
        *_ts("updated_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_item_id"),
        "order_id", "product_id", "quantity",
        numeric("unit_price").alias("unit_price"),
        numeric("discount_amount").alias("item_discount_amount"),
        numeric("total_price").alias("item_total"),
        *_ts(*_TS),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("payment_id"),
        "order_id",
        clean_lower("payment_method").alias("payment_method"),
        clean_lower("payment_status").alias("payment_status"),
        numeric("amount").alias("payment_amount"),
        clean("transaction_id").alias("transaction_id"),
        F.col("created_at").cast("timestamp").alias("paid_at"),
        *_ts("updated_at"),
    )


def stg_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("refund_id"),
        "order_id", "payment_id", "order_item_id",
        clean_lower("reason").alias("refund_reason"),
        clean_lower("status").alias("refund_status"),
        numeric("amount").alias("refund_amount"),
        F.col("notes").alias("refund_notes"),
        F.col("created_at").cast("timestamp").alias("refunded_at"),
        *_ts("updated_at"),
    )


def stg_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("campaign_id"),
        clean("name").alias("campaign_name"),
        clean_lower("platform").alias("platform"),
        clean_lower("objective").alias("objective"),
        clean_lower("status").alias("campaign_status"),
        numeric("daily_budget").alias("daily_budget"),
        numeric("total_budget").alias("total_budget"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        *_ts(*_TS),
    )


def stg_ad_sets(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("ad_set_id"),
        "campaign_id",
        clean("name").alias("ad_set_name"),
        "targeting_gender", "targeting_age_min", "targeting_age_max", "targeting_interests",
        numeric("daily_budget").alias("daily_budget"),
        clean_lower("bid_strategy").alias("bid_strategy"),
        clean_lower("status").alias("ad_set_status"),
        *_ts(*_TS),
    )


def stg_ads(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("ad_id"),
        "ad_set_id",
        clean("name").alias("ad_name"),
        clean_lower("ad_type").alias("ad_type"),
        clean("headline").alias("headline"),
        F.col("description").alias("ad_description"),
        clean_lower("call_to_action").alias("call_to_action"),
        clean("destination_url").alias("destination_url"),
        clean_lower("status").alias("ad_status"),
        *_ts(*_TS),
    )


def stg_daily_performance(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("performance_id"),
        "ad_id",
        F.col("date").cast("date").alias("performance_date"),
        "impressions", "clicks",
        numeric("spend").alias("spend"),
        numeric("ctr").alias("ctr"),
        numeric("cpc").alias("cpc"),
        "purchases",
        numeric("revenue").alias("revenue"),
        *_ts(*_TS),
    )


def stg_inventory_snapshots(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("snapshot_id"),
        "product_id",
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        "quantity_on_hand", "quantity_reserved", "quantity_available",
        numeric("unit_cost").alias("unit_cost"),
        numeric("total_value").alias("total_value"),
        clean_upper("warehouse_location").alias("warehouse_location"),
        *_ts(*_TS),
    )


def stg_inventory_movements(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("movement_id"),
        "product_id",
        clean_lower("movement_type").alias("movement_type"),
        "quantity",
        numeric("unit_cost").alias("unit_cost"),
        numeric("total_cost").alias("total_cost"),
        clean("reference_id").alias("reference_id"),
        clean_upper("warehouse_location").alias("warehouse_location"),
        "notes",
        F.col("movement_date").cast("date").alias("movement_date"),
        *_ts(*_TS),
    )


STAGING = {
    "stg_customers": ("customers", stg_customers),
    "stg_products": ("products", stg_products),
    "stg_orders": ("orders", stg_orders),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_payments": ("payments", stg_payments),
    "stg_refunds": ("refunds", stg_refunds),
    "stg_campaigns": ("campaigns", stg_campaigns),
    "stg_ad_sets": ("ad_sets", stg_ad_sets),
    "stg_ads": ("ads", stg_ads),
    "stg_daily_performance": ("daily_performance", stg_daily_performance),
    "stg_inventory_snapshots": ("inventory_snapshots", stg_inventory_snapshots),
    "stg_inventory_movements": ("inventory_movements", stg_inventory_movements),
}


class LazyStaging(Mapping):
    """Staging views over a raw mapping, each built on first access."""

    def __init__(self, raw):
        self.raw = raw
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STAGING or STAGING[name][0] not in self.raw:
            raise KeyError(name)
        if name not in self._built:
            src, fn = STAGING[name]
            self._built[name] = fn(self.raw[src])
        return self._built[name]

    def __iter__(self):
        return iter([n for n, (src, _) in STAGING.items() if src in self.raw])

    def __len__(self) -> int:
        return len(list(iter(self)))


def build_staging(raw) -> LazyStaging:
    """All staging views from a mapping of raw tables (missing raw tables are skipped)."""
    return LazyStaging(raw)
