"""Explicit StructTypes: the 12 raw feeds, the page envelope and the 3 audit tables."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B, TS, DT = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)


def _s(*fields) -> T.StructType:
    cols = [T.StructField(n, t, nullable) for n, t, nullable in fields]
    cols += [T.StructField("created_at", TS, False), T.StructField("updated_at", TS, False)]
    return T.StructType(cols)


FEED_SCHEMAS: dict[str, T.StructType] = {
    "customers": _s(("id", L, False), ("email", S, False), ("first_name", S, False), ("last_name", S, True),
                    ("phone", S, True), ("date_of_birth", S, True), ("gender", S, True),
                    ("address_line1", S, True), ("address_line2", S, True), ("city", S, True),
                    ("state", S, True), ("postal_code", S, True), ("country", S, False),
                    ("is_active", B, False)),
    "products": _s(("id", L, False), ("sku", S, False), ("name", S, False), ("description", S, True),
                   ("category_id", L, False), ("brand", S, False), ("price", MONEY, False),
                   ("cost_price", MONEY, False), ("size", S, True), ("color", S, True), ("material", S, True),
                   ("stock_quantity", I, False), ("is_active", B, False)),
    "orders": _s(("id", L, False), ("order_number", S, False), ("customer_id", L, False), ("status", S, False),
                 ("subtotal", MONEY, False), ("discount_amount", MONEY, False), ("tax_amount", MONEY, False),
                 ("shipping_amount", MONEY, False), ("total_amount", MONEY, False),
                 ("shipping_address_line1", S, True), ("shipping_address_line2", S, True),
                 ("shipping_city", S, True), ("shipping_state", S, True), ("shipping_postal_code", S, True),
                 ("shipping_country", S, True), ("notes", S, True)),
    "order_items": _s(("id", L, False), ("order_id", L, False), ("product_id", L, False), ("quantity", I, False),
                      ("unit_price", MONEY, False), ("discount_amount", MONEY, False), ("total_price", MONEY, False)),
    "payments": _s(("id", L, False), ("order_id", L, False), ("payment_method", S, False),
                   ("payment_status", S, False), ("amount", MONEY, False), ("transaction_id", S, False)),
    "refunds": _s(("id", L, False), ("order_id", L, False), ("payment_id", L, False), ("order_item_id", L, True),
                  ("reason", S, False), ("status", S, False), ("amount", MONEY, False), ("notes", S, True)),
    "campaigns": _s(("id", L, False), ("name", S, False), ("platform", S, False), ("objective", S, False),
                    ("status", S, False), ("daily_budget", MONEY, False), ("total_budget", MONEY, False),
                    ("start_date", S, False), ("end_date", S, True)),
    "ad_sets": _s(("id", L, False), ("campaign_id", L, False), ("name", S, False), ("targeting_gender", S, True),
                  ("targeting_age_min", I, True), ("targeting_age_max", I, True), ("targeting_interests", S, True),
                  ("daily_budget", MONEY, False), ("bid_strategy", S, False), ("status", S, False)),
    "ads": _s(("id", L, False), ("ad_set_id", L, False), ("name", S, False), ("ad_type", S, False),
              ("headline", S, False), ("description", S, True), ("call_to_action", S, False),
              ("destination_url", S, False), ("status", S, False)),
    "daily_performance": _s(("id", L, False), ("ad_id", L, False), ("date", S, False), ("impressions", I, False),
                            ("clicks", I, False), ("spend", MONEY, False), ("ctr", DT, False),
                            ("cpc", DT, True), ("purchases", I, False), ("revenue", MONEY, False)),
    "inventory_snapshots": _s(("id", L, False), ("product_id", L, False), ("snapshot_date", S, False),
                              ("quantity_on_hand", I, False), ("quantity_reserved", I, False),
                              ("quantity_available", I, False), ("unit_cost", MONEY, False),
                              ("total_value", MONEY, False), ("warehouse_location", S, False)),
    "inventory_movements": _s(("id", L, False), ("product_id", L, False), ("movement_type", S, False),
                              ("quantity", I, False), ("unit_cost", MONEY, False), ("total_cost", MONEY, False),
                              ("reference_id", S, True), ("warehouse_location", S, False), ("notes", S, True),
                              ("movement_date", S, False)),
}

# Columns added by additive schema evolution (K3).
EVOLVED_COLUMNS: dict[str, list[tuple[str, T.DataType]]] = {
    "customers": [("loyalty_tier", S)],
    "orders": [("shipping_priority", S)],
    "products": [("sustainability_flag", B)],
}


def page_envelope(row_schema: T.StructType) -> T.StructType:
    """Feed page: {data: [rows], page, page_size, total_count, total_pages, has_next, has_previous}."""
    return T.StructType([
        T.StructField("data", T.ArrayType(row_schema), True),
        T.StructField("page", I, True),
        T.StructField("page_size", I, True),
        T.StructField("total_count", L, True),
        T.StructField("total_pages", I, True),
        T.StructField("has_next", B, True),
        T.StructField("has_previous", B, True),
    ])


AUDIT_SCHEMAS: dict[str, T.StructType] = {
    "pipeline_runs": T.StructType([
        T.StructField("run_id", S, False), T.StructField("pipeline_name", S, False),
        T.StructField("pipeline_type", S, False), T.StructField("status", S, False),
        T.StructField("started_at", TS, False), T.StructField("completed_at", TS, True),
        T.StructField("duration_seconds", DT, True), T.StructField("total_rows", L, True),
        T.StructField("error_message", S, True), T.StructField("metadata", S, True),
    ]),
    "pipeline_resource_runs": T.StructType([
        T.StructField("id", S, False), T.StructField("run_id", S, False),
        T.StructField("resource_name", S, False), T.StructField("row_count", L, True),
        T.StructField("status", S, False), T.StructField("started_at", TS, False),
        T.StructField("completed_at", TS, True), T.StructField("duration_seconds", DT, True),
        T.StructField("error_message", S, True),
    ]),
    "quality_check_results": T.StructType([
        T.StructField("table_name", S, False), T.StructField("check_type", S, False),
        T.StructField("column_name", S, True), T.StructField("description", S, True),
        T.StructField("passed", B, False), T.StructField("failed_count", L, True),
        T.StructField("total_count", L, True), T.StructField("checked_at", TS, False),
    ]),
}
