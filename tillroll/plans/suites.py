"""Expectation suites: the declared data tests (Q11-Q19), the raw-layer suite (Q20-Q24),
layer-populated checks (Q25), the end-to-end summary (Q26, A7) and the schema inventory (Q27)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.quality import RESULT_SCHEMA, DataTest, run_data_tests
from tillroll.plans.parallel import side_by_side
from tillroll.plans.staging import STAGING

# Fixed values of the suites, here and below: accepted statuses, the raw tables, their mandatory columns
# and their foreign keys.
ORDER_STATUSES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "returned"]
PAYMENT_STATUSES = ["pending", "completed", "failed", "refunded"]


def _ui(model: str, column: str) -> list[DataTest]:
    return [DataTest(f"unique_{model}_{column}", model, column, "unique"),
            DataTest(f"not_null_{model}_{column}", model, column, "not_null")]


def _nn(model: str, column: str) -> DataTest:
    return DataTest(f"not_null_{model}_{column}", model, column, "not_null")


def _rel(model: str, column: str, to: str, field: str = "id") -> DataTest:
    return DataTest(f"relationships_{model}_{column}__{field}__{to}", model, column, "relationships",
                    (("to", to), ("field", field)))


def declared_tests() -> list[DataTest]:
    """The 107 declared tests (sources, staging, marketing, inventory, marts, reconciliation, singular)."""
    t: list[DataTest] = []
    # raw commerce sources (32)
    t += _ui("customers", "id") + _ui("customers", "email")
    t += _ui("products", "id") + _ui("products", "sku")
    t += _ui("orders", "id") + _ui("orders", "order_number") + [_nn("orders", "customer_id"),
                                                                  _rel("orders", "customer_id", "customers")]
    t += _ui("order_items", "id") + [_nn("order_items", "order_id"), _rel("order_items", "order_id", "orders"),
                                     _nn("order_items", "product_id"), _rel("order_items", "product_id", "products")]
    t += _ui("payments", "id") + [_nn("payments", "order_id"), _rel("payments", "order_id", "orders")]
    t += _ui("payments", "transaction_id")
    t += _ui("refunds", "id") + [_nn("refunds", "order_id"), _rel("refunds", "order_id", "orders"),
                                 _nn("refunds", "payment_id"), _rel("refunds", "payment_id", "payments")]
    # staging commerce (26)
    t += _ui("stg_customers", "customer_id") + _ui("stg_customers", "email")
    t += _ui("stg_products", "product_id") + _ui("stg_products", "sku")
    t += _ui("stg_orders", "order_id") + _ui("stg_orders", "order_number") + [_nn("stg_orders", "customer_id")]
    t += _ui("stg_order_items", "order_item_id") + [_nn("stg_order_items", "order_id"),
                                                    _nn("stg_order_items", "product_id")]
    t += _ui("stg_payments", "payment_id") + [_nn("stg_payments", "order_id")] + _ui("stg_payments", "transaction_id")
    t += _ui("stg_refunds", "refund_id") + [_nn("stg_refunds", "order_id"), _nn("stg_refunds", "payment_id")]
    # marketing sources and staging (19)
    t += _ui("campaigns", "id")
    t += _ui("ad_sets", "id") + [_nn("ad_sets", "campaign_id")]
    t += _ui("ads", "id") + [_nn("ads", "ad_set_id")]
    t += _ui("daily_performance", "id") + [_nn("daily_performance", "ad_id")]
    t += _ui("stg_campaigns", "campaign_id") + _ui("stg_ad_sets", "ad_set_id") + _ui("stg_ads", "ad_id")
    t += _ui("stg_daily_performance", "performance_id")
    # inventory sources and staging (10)
    t += _ui("inventory_snapshots", "id") + [_nn("inventory_snapshots", "product_id")]
    t += _ui("inventory_movements", "id") + [_nn("inventory_movements", "product_id")]
    t += _ui("stg_inventory_snapshots", "snapshot_id") + _ui("stg_inventory_movements", "movement_id")
    # marts (13)
    t += _ui("fct_orders", "order_id") + _ui("fct_orders", "order_number") + [_nn("fct_orders", "customer_id")]
    t += [DataTest("accepted_values_fct_orders_order_status", "fct_orders", "order_status", "accepted_values",
                   (("values", tuple(ORDER_STATUSES)),))]
    t += [_nn("fct_orders", "order_total"), _nn("fct_orders", "order_date")]
    t += _ui("fct_daily_marketing_performance", "performance_id")
    t += [_nn("fct_daily_marketing_performance", c) for c in ("campaign_id", "ad_id", "performance_date")]
    # reconciliation (4)
    t += _ui("recon_orders_vs_items", "order_id") + _ui("recon_payments_vs_refunds", "order_id")
    # singular (3)
    t += [DataTest("assert_net_revenue_not_exceeds_total", "fct_orders", None, "net_revenue_not_exceeds_total"),
          DataTest("assert_order_total_matches_components", "fct_orders", None, "order_total_matches_components"),
          DataTest("assert_roas_not_negative", "fct_daily_marketing_performance", None, "roas_not_negative")]
    return t


def generic_tests() -> list[DataTest]:
    """The two generic tests, attached where they apply (they are declared without a model)."""
    return [
        DataTest("positive_value_fct_orders_order_total", "fct_orders", "order_total", "positive_value"),
        DataTest("positive_value_stg_inventory_movements_quantity", "stg_inventory_movements", "quantity",
                 "positive_value"),
        DataTest("value_in_range_stg_products_gross_margin", "stg_products", "gross_margin", "value_in_range",
                 (("min_value", 0), ("max_value", 1))),
    ]


#: Statements of tests that run at once: the driver holds the plans, tasks and map outputs of all of them. The
#: stages of one that don't depend on each other run at once anyway.
STATEMENTS_AT_ONCE = 1


def run_declared_tests(models: dict[str, DataFrame], include_generic: bool = True) -> DataFrame:
    """All declared tests; those of a model that isn't there are reported as failed. They run in statements by
    table, one after the other: adaptive execution plans and describes a whole statement anew after each of its stages, so
    that one of all tests takes the driver memory with the square of their number."""
    statements: dict[tuple[bool, str], list[DataTest]] = {}
    for t in declared_tests() + (generic_tests() if include_generic else []):
        statements.setdefault(_statement_of(t), []).append(t)
    spark = next(iter(models.values())).sparkSession
    done = side_by_side(spark, lambda tests: run_data_tests(tests, models).collect(), statements.values(), "data-tests",
                        STATEMENTS_AT_ONCE)
    return spark.createDataFrame([row for rows in done for row in rows], RESULT_SCHEMA)


def _statement_of(t: DataTest) -> tuple[bool, str]:
    """The statement in which a test runs: foreign keys by their parent, others by table, a staging view's with its raw
    table. What tests share, a parent's keys or the key of a raw table and its view, is in one and made once."""
    model = dict(t.params).get("to", t.model)
    return t.kind == "relationships", STAGING[model][0] if model in STAGING else model


# --------------------------------------------------------------------------- raw-layer suite (Q20-Q24)

RAW_TABLES = ["customers", "products", "orders", "order_items", "payments", "refunds"]

NOT_NULL_COLUMNS: dict[str, list[str]] = {
    "customers": ["id", "email", "first_name", "last_name", "country", "created_at", "updated_at"],
    "products": ["id", "sku", "name", "category_id", "brand", "price", "cost_price", "created_at", "updated_at"],
    "orders": ["id", "order_number", "customer_id", "status", "total_amount", "created_at", "updated_at"],
    "order_items": ["id", "order_id", "product_id", "quantity", "unit_price", "total_price", "created_at",
                    "updated_at"],
    "payments": ["id", "order_id", "payment_method", "payment_status", "amount", "transaction_id", "created_at",
                 "updated_at"],
    "refunds": ["id", "order_id", "payment_id", "reason", "status", "amount", "created_at", "updated_at"],
}

# (child, child column, parent, parent column)
FK_CHECKS = [
    ("orders", "customer_id", "customers", "id"),
    ("order_items", "order_id", "orders", "id"),
    ("order_items", "product_id", "products", "id"),
    ("payments", "order_id", "orders", "id"),
    ("refunds", "order_id", "orders", "id"),
    ("refunds", "payment_id", "payments", "id"),
]

METADATA_COLUMNS = ("_load_id", "_row_id")


def raw_suite(raw) -> DataFrame:
    """Five-part raw validation as one DataFrame: section, check_name, table_name, observed, passed.

    1 counts, 2 metadata columns, 3 not-null map, 4 FK orphans (anti joins), 5 spot checks. A table
    that is missing fails all its checks with ``observed`` -1. Compiled into one SQL statement: each
    table's counts, null counts and spot checks are one scan, each orphan check is one anti join.
    """
    present = [t for t in RAW_TABLES if t in raw]
    if not present:
        raise ValueError("none of the raw tables is there")
    frames = {t: raw[t] for t in present}
    ost = ", ".join(f"'{x}'" for x in ORDER_STATUSES)
    pst = ", ".join(f"'{x}'" for x in PAYMENT_STATUSES)
    spot = {
        "orders": [("orders_positive_totals", "total_amount < 0"),
                   ("orders_valid_statuses", f"status NOT IN ({ost})")],
        "products": [("products_price_gt_cost", "cost_price >= price"), ("products_positive_prices", "price <= 0")],
        "payments": [("payments_valid_statuses", f"payment_status NOT IN ({pst})")],
    }
    parts = []

    def missing(section: str, name: str, table: str) -> None:
        parts.append(f"SELECT '{section}', '{name}', '{table}', CAST(-1 AS BIGINT), false")

    for t in RAW_TABLES:
        items = [("1_counts", "row_count", "count(*)", "> 0")]
        items += [("3_not_null", f"null_{c}", f"count_if(`{c}` IS NULL)", "= 0") for c in NOT_NULL_COLUMNS[t]]
        items += [("5_spot_checks", n, f"count_if({pred})", "= 0") for n, pred in spot.get(t, [])]
        if t not in frames:
            for section, name, _, _ in [*items, ("2_schema", "data_columns", "", "")]:
                missing(section, name, t)
            continue
        aggs = ", ".join(f"CAST({e} AS BIGINT) AS _c{k}" for k, (_, _, e, _) in enumerate(items))
        stack = ", ".join(f"'{sec}', '{name}', '{t}', _c{k}, _c{k} {cmp}" for k, (sec, name, _, cmp) in enumerate(items))
        parts.append(f"SELECT stack({len(items)}, {stack}) FROM (SELECT {aggs} FROM {{{t}}})")
        cols = frames[t].columns
        has_meta = all(c in cols for c in METADATA_COLUMNS)
        n_data = len([c for c in cols if not c.startswith("_")])
        parts.append(f"SELECT '2_schema', 'data_columns', '{t}', CAST({n_data} AS BIGINT), {str(has_meta).lower()}")
    anti = [(f"{c}.{cc}->{p}.{pc}", c, c, cc, p, pc, "4_foreign_keys") for c, cc, p, pc in FK_CHECKS]
    anti += [("every_order_has_items", "orders", "orders", "id", "order_items", "order_id", "5_spot_checks"),
             ("every_order_has_payment", "orders", "orders", "id", "payments", "order_id", "5_spot_checks")]
    for name, table, child, ccol, parent, pcol, sec in anti:
        if child not in frames or parent not in frames:
            missing(sec, name, table)
            continue
        parts.append(f"SELECT '{sec}', '{name}', '{table}', CAST(n AS BIGINT), n = 0 FROM (SELECT coalesce(sum(ch.n), 0) AS n "
                     f"FROM (SELECT `{ccol}` AS _fk, count(*) AS n FROM {{{child}}} GROUP BY `{ccol}`) ch LEFT ANTI JOIN "
                     f"(SELECT DISTINCT `{pcol}` AS _pk FROM {{{parent}}}) pa ON ch._fk = pa._pk)")
    body = " UNION ALL ".join(f"({x})" for x in parts)
    spark = frames[present[0]].sparkSession
    return spark.sql(f"SELECT * FROM ({body}) AS r(section, check_name, table_name, observed, passed)", **frames)


# --------------------------------------------------------------------------- layer checks and summary

LAYER_TABLES = {
    "commerce": ["customers", "products", "orders", "order_items", "payments", "refunds"],
    "marketing": ["campaigns", "ad_sets", "ads", "daily_performance"],
    "inventory": ["inventory_snapshots", "inventory_movements"],
    "marts": ["fct_orders", "fct_daily_marketing_performance"],
}


def table_counts(tables: dict[str, DataFrame], layer: str | None = None, expected: list[str] | None = None) -> DataFrame:
    """One row per table (layer, table_name, row_count); unioned into one job. A table of
    ``expected`` that is not there has a null row_count."""
    names = list(tables) if expected is None else expected
    out = None
    for name in names:
        n = F.count(F.lit(1)).cast("long").alias("row_count")
        part = tables[name].agg(n) if name in tables else next(iter(tables.values())).sparkSession.range(1).select(
            F.lit(None).cast("long").alias("row_count"))
        part = part.select(F.lit(layer).cast("string").alias("layer"), F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def layer_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Q25: per layer, passed when each listed table is there and has rows; names those that don't."""
    counts = None
    for layer, names in LAYER_TABLES.items():
        part = table_counts({n: tables[n] for n in tables}, layer, names)
        counts = part if counts is None else counts.unionByName(part)

    def named(condition) -> F.Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(condition, F.col("table_name")))), ", ")

    n = F.col("row_count")
    return counts.groupBy("layer").agg(
        (F.count_if(F.coalesce(n, F.lit(0)) == 0) == 0).alias("passed"),
        named(n == 0).alias("empty_tables"),
        named(n.isNull()).alias("missing_tables"),
        F.count(F.lit(1)).cast("long").alias("tables_checked"),
    )


def fct_orders_kpis(fct_orders: DataFrame) -> DataFrame:
    """Global KPIs of the order fact."""
    return fct_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.round(F.sum("order_total"), 2).cast("decimal(38,9)").alias("total_revenue"),
        F.round(F.sum("net_revenue"), 2).cast("decimal(38,9)").alias("total_net_revenue"),
        F.count_if(F.col("has_refund")).alias("orders_with_refunds"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def e2e_summary(raw: dict[str, DataFrame], staging: dict[str, DataFrame], marts: dict[str, DataFrame]) -> DataFrame:
    """Q26: row counts of every layer; the A7 KPIs are ``fct_orders_kpis``."""
    return (table_counts(raw, "raw").unionByName(table_counts(staging, "staging"))
            .unionByName(table_counts(marts, "mart"))
            .withColumn("populated", F.col("row_count") > 0))


def schema_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Q27: (table_name, column_name, data_type, is_nullable, references, row_count, filled) of the tables given: their
    own schemas, the foreign keys that the suites check, and how many rows have a value. One scan a table."""
    keys = {(c, cc): f"{p}.{pc}" for c, cc, p, pc in FK_CHECKS}
    out = None
    for t, df in tables.items():
        counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
        columns = [F.struct(F.lit(t).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                            F.lit(f.nullable).alias("is_nullable"), F.lit(keys.get((t, f.name))).cast("string").alias("references"),
                            F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("filled")) for i, f in enumerate(df.schema.fields)]
        part = counted.select(F.inline(F.array(*columns)))
        out = part if out is None else out.unionByName(part)
    return out
