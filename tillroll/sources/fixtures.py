"""Retail raw feeds derived from the driver's TPC-H-like tables.

Every expression is deterministic, so the same feed can be rebuilt by any engine. Money is
``decimal(18,2)``; percentages are applied by multiplying with a decimal literal (never by
dividing by 100) so both engines round identically.

Scale notes: every feed is one narrow projection of one driver table, except
``orders`` (joins the per-order item sum; both sides hash-partitioned on the order key),
``customers`` (joins the two fixed-size geography tables, 25 and 5 rows, broadcast) and
``daily_performance`` (one partial-aggregated group-by on supplier and day).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.session import cut_lineage

MONEY = "decimal(18,2)"

# Fixed values of the mapping (order status, payment method/status, refund reason/status,
# movement type, warehouse spelling). Mixed case and blanks are deliberate: staging must clean them.
ORDER_STATUS_F = {0: " Returned", 1: "CANCELLED"}       # else "Delivered"
ORDER_STATUS_O = {0: "pending", 1: "confirmed", 2: "Processing"}
ORDER_STATUS_P = "shipped"
PAYMENT_METHODS = ["credit_card", "debit_card", "PayPal", "apple_pay", "google_pay"]
PAYMENT_STATUS = {0: "refunded", 1: "failed", 2: "pending"}  # else "Completed"
REFUND_REASONS = ["damaged", "Changed_Mind", "size_issue"]
REFUND_STATUS = {0: "rejected", 1: "pending"}               # else "Processed"
MOVEMENT_TYPES = ["Purchase", "sale", "return", "damage", "adjustment"]
WAREHOUSES = [" wh-east", "WH-West ", "Wh-Central"]
BASE_TS = "1992-01-01 00:00:00"
SNAPSHOT_START = "1998-01-05"

# Column order that tells the rows of one order and line number apart (they repeat).
_LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
               "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def m(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def dec(v: str) -> F.Column:
    """Exact decimal literal such as 0.05 -> decimal(3,2)."""
    digits = len(v.split(".")[1]) if "." in v else 0
    return F.lit(v).cast(f"decimal({max(len(v.replace('.', '').replace('-', '')), digits + 1)},{digits})")


def z() -> F.Column:
    return F.lit(0).cast(MONEY)


def _pick(key: F.Column, mapping: dict, default) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default) if not isinstance(default, F.Column) else default)


def _cycle(key: F.Column, values: list) -> F.Column:
    return _pick(key % len(values), dict(enumerate(values[:-1])), values[-1])


class DriverTables:
    """Lazy readers for the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:  # one file listing / footer read per table
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    @cached_property
    def line_widths(self) -> tuple[int, int]:
        """Powers of ten above the largest line number and above the most rows of one order and line
        number: the widths of the two lower places of an order item's id. One aggregate; one row
        reaches the driver."""
        per_line = self.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
        row = per_line.agg(F.max("l_linenumber"), F.max("n")).first()
        return 10 ** len(str(row[0] or 0)), 10 ** len(str(row[1] or 0))


# --------------------------------------------------------------------------- commerce

def _line_money() -> tuple[Column, Column]:
    """Discount and total of a line."""
    price = m("l_extendedprice")
    disc = m(price * m("l_discount"))
    return disc, m(price - disc)


def _numbered_lines(t: DriverTables) -> DataFrame:
    """The lines with ``_repeat``, their number among the rows of one order and line number: what an order
    item's id is made of, and its other columns."""
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*_LINE_ORDER)
    disc, total = _line_money()
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.row_number().over(w).alias("_repeat"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        m("l_extendedprice").alias("unit_price"),
        disc.alias("discount_amount"),
        total.alias("total_price"),
        F.col("l_shipdate").cast("timestamp").alias("_at"),
    )


def _items(numbered: DataFrame, lines: int, repeats: int) -> DataFrame:
    # Repeats of one line of one order; an order's lines are numbered apart from each other.
    return numbered.select(
        ((F.col("l_orderkey") * repeats + F.col("_repeat")) * lines + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), "product_id", "quantity", "unit_price", "discount_amount", "total_price",
        F.col("_at").alias("created_at"), F.col("_at").alias("updated_at"))


def order_items(t: DriverTables) -> DataFrame:
    return _items(_numbered_lines(t), *t.line_widths)


def landed_order_items(t: DriverTables, path: str) -> DataFrame:
    """``order_items`` from lines that are numbered once and written; the widths are found on the way."""
    seen = Observation()
    (_numbered_lines(t).observe(seen, F.max("l_linenumber").alias("line"), F.max("_repeat").alias("repeat"))
     .write.option("compression", "zstd").parquet(path))
    widths = (10 ** len(str(seen.get[n] or 0)) for n in ("line", "repeat"))
    return _items(t.spark.read.parquet(path), *widths)


def orders(t: DriverTables, items: DataFrame | None = None) -> DataFrame:
    if items is None:  # an order's sum needs no ids
        items = t.lineitem.select(F.col("l_orderkey").alias("order_id"), _line_money()[1].alias("total_price"))
    item_sum = items.groupBy("order_id").agg(F.sum("total_price").alias("_items"))
    o = t.orders.join(item_sum, F.col("o_orderkey") == F.col("order_id"), "left")
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", _pick(key % 10, ORDER_STATUS_F, "Delivered"))
        .when(F.col("o_orderstatus") == "O", _pick(key % 3, ORDER_STATUS_O, None))
        .when(F.col("o_orderstatus") == "P", F.lit(ORDER_STATUS_P))
    )
    subtotal = m(F.coalesce(F.col("_items"), z()) + F.when(key % 50 == 0, m(F.lit(1))).otherwise(z()))
    discount = F.when(key % 4 == 0, m(F.col("subtotal") * dec("0.05"))).otherwise(z())
    tax = m((F.col("subtotal") - F.col("discount_amount")) * dec("0.08"))
    shipping = _pick(key % 3, {0: z(), 1: dec("5.99")}, dec("9.99")).cast(MONEY)
    ts = F.col("o_orderdate").cast("timestamp")
    return (
        o.select("o_orderkey", "o_custkey", "o_orderpriority", status.alias("status"),
                 subtotal.alias("subtotal"), ts.alias("ts"))
        .withColumn("discount_amount", discount)
        .withColumn("tax_amount", tax)
        .withColumn("shipping_amount", shipping)
        .select(
            key.alias("id"),
            F.concat(F.lit("  ORD-"), key.cast("string")).alias("order_number"),
            F.col("o_custkey").alias("customer_id"),
            "status", "subtotal", "discount_amount", "tax_amount", "shipping_amount",
            m(F.col("subtotal") - F.col("discount_amount") + F.col("tax_amount") + F.col("shipping_amount")
              + F.when(key % 97 == 0, m(F.lit(1))).otherwise(z())).alias("total_amount"),
            F.concat(key.cast("string"), F.lit(" Main St ")).alias("shipping_address_line1"),
            F.lit(None).cast("string").alias("shipping_address_line2"),
            F.concat(F.lit(" City "), (F.col("o_custkey") % 50).cast("string")).alias("shipping_city"),
            F.concat(F.lit(" st"), (key % 7).cast("string"), F.lit(" ")).alias("shipping_state"),
            F.lpad((F.col("o_custkey") % 99999).cast("string"), 5, "0").alias("shipping_postal_code"),
            F.lit("us ").alias("shipping_country"),
            F.col("o_orderpriority").alias("notes"),
            F.col("ts").alias("created_at"),
            F.col("ts").alias("updated_at"),
        )
    )


def payments(t: DriverTables) -> DataFrame:
    key = F.col("o_orderkey")
    ts = F.col("o_orderdate").cast("timestamp")
    return t.orders.select(
        key.alias("id"),
        key.alias("order_id"),
        _cycle(key, PAYMENT_METHODS).alias("payment_method"),
        _pick(key % 10, PAYMENT_STATUS, "Completed").alias("payment_status"),
        m("o_totalprice").alias("amount"),
        F.concat(F.lit("txn_"), key.cast("string")).alias("transaction_id"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def refunds(t: DriverTables, items: DataFrame | None = None) -> DataFrame:
    items = order_items(t) if items is None else items
    key = F.col("id")
    return items.filter(key % 7 == 0).select(
        key.alias("id"),
        "order_id",
        F.col("order_id").alias("payment_id"),
        key.alias("order_item_id"),
        _cycle(key, REFUND_REASONS).alias("reason"),
        _pick(key % 4, REFUND_STATUS, "Processed").alias("status"),
        F.col("total_price").alias("amount"),
        F.when(key % 2 == 0, F.lit("customer note")).alias("notes"),
        "created_at",
        "updated_at",
    )


def customers(t: DriverTables) -> DataFrame:
    # nation and region have a fixed size (25 and 5 rows) whatever the scale: safe to broadcast.
    geo = F.broadcast(
        t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", "n_name", "r_name")
    )
    c = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("c_custkey")
    none = F.lit(None).cast("string")
    base = F.lit(BASE_TS).cast("timestamp")
    return c.select(
        key.alias("id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("first_name"),
        F.when(key % 50 != 0, F.col("c_name")).alias("last_name"),
        none.alias("phone"), none.alias("date_of_birth"), none.alias("gender"),
        none.alias("address_line1"), none.alias("address_line2"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        none.alias("postal_code"),
        F.lit("us").alias("country"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


def products(t: DriverTables) -> DataFrame:
    key = F.col("p_partkey")
    price = F.when(key % 500 == 0, z()).otherwise(m("p_retailprice"))
    base = F.lit(BASE_TS).cast("timestamp")
    return t.part.select(
        key.alias("id"),
        F.concat(F.lit("sku-"), key.cast("string"), F.lit(" ")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
        (F.col("p_size") % 10).cast("long").alias("category_id"),
        F.col("p_brand").alias("brand"),
        price.alias("price"),
        m(price * dec("0.45")).alias("cost_price"),
        F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("size"),
        F.lit(None).cast("string").alias("color"),
        F.lit(None).cast("string").alias("material"),
        (F.col("p_size") * 4).cast("int").alias("stock_quantity"),
        (key % 20 != 0).alias("is_active"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


# --------------------------------------------------------------------------- marketing

def campaigns(t: DriverTables) -> DataFrame:
    key = F.col("r_regionkey")
    base = F.lit(BASE_TS).cast("timestamp")
    return t.region.select(
        key.cast("long").alias("id"),
        F.concat(F.lit(" Campaign "), F.col("r_name"), F.lit(" ")).alias("name"),
        F.when(key % 2 == 0, F.lit("Google_Ads")).otherwise(F.lit("meta_ads")).alias("platform"),
        _cycle(key, ["Conversions", "traffic", "awareness"]).alias("objective"),
        F.lit(" ACTIVE").alias("status"),
        m(F.lit(100) + key * 25).alias("daily_budget"),
        m(F.lit(3000) + key * 750).alias("total_budget"),
        F.lit("1992-01-01").alias("start_date"),
        F.lit(None).cast("string").alias("end_date"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


def ad_sets(t: DriverTables) -> DataFrame:
    key = F.col("n_nationkey")
    base = F.lit(BASE_TS).cast("timestamp")
    return t.nation.select(
        key.cast("long").alias("id"),
        F.col("n_regionkey").cast("long").alias("campaign_id"),
        F.concat(F.col("n_name"), F.lit(" set ")).alias("name"),
        _cycle(key, ["all", "female", "male"]).alias("targeting_gender"),
        (F.lit(18) + key % 10).cast("int").alias("targeting_age_min"),
        (F.lit(45) + key % 20).cast("int").alias("targeting_age_max"),
        F.lit("fashion,shoes").alias("targeting_interests"),
        m(F.lit(20) + key).alias("daily_budget"),
        F.lit(" Lowest_Cost").alias("bid_strategy"),
        F.lit("active").alias("status"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


def ads(t: DriverTables) -> DataFrame:
    key = F.col("s_suppkey")
    base = F.lit(BASE_TS).cast("timestamp")
    return t.supplier.select(
        key.alias("id"),
        F.col("s_nationkey").cast("long").alias("ad_set_id"),
        F.col("s_name").alias("name"),
        _cycle(key, ["image", " Video ", "carousel"]).alias("ad_type"),
        F.concat(F.lit("Deal "), key.cast("string")).alias("headline"),
        F.lit(None).cast("string").alias("description"),
        F.lit(" Shop_Now").alias("call_to_action"),
        F.concat(F.lit("https://shop.example/s/"), key.cast("string"), F.lit(" ")).alias("destination_url"),
        F.when(key % 10 == 0, F.lit("paused")).otherwise(F.lit("ACTIVE")).alias("status"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


def daily_performance(t: DriverTables) -> DataFrame:
    li = t.lineitem.select("l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
                           F.to_date("l_shipdate").alias("d"))
    price = m("l_extendedprice")
    g = li.groupBy("l_suppkey", "d").agg(
        F.sum("l_quantity").alias("q"),
        F.sum(price).alias("p"),
        F.count_if(F.col("l_returnflag") == "N").alias("n"),
        F.sum(F.when(F.col("l_returnflag") == "N", price).otherwise(z())).alias("pn"),
    )
    s = F.col("l_suppkey")
    clicks = F.when(s % 20 == 0, F.lit(0)).otherwise(F.col("q")).cast("int")
    spend = F.when(s % 25 == 0, z()).otherwise(m(F.col("p") * dec("0.01")))
    ts = F.col("d").cast("timestamp")
    return g.select(
        (s * 100000 + (F.year("d") - 1990) * 400 + F.dayofyear("d")).alias("id"),
        s.alias("ad_id"),
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        (F.col("q") * 40).cast("int").alias("impressions"),
        clicks.alias("clicks"),
        spend.alias("spend"),
        F.when(s % 20 == 0, F.lit(0.0)).otherwise((31250 + s % 7 * 1171).cast("double") / 1000000).alias("ctr"),
        F.when(s % 20 != 0, F.col("p").cast("double") / 10000).alias("cpc"),
        F.col("n").cast("int").alias("purchases"),
        m(F.col("pn") * dec("0.02")).alias("revenue"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


# --------------------------------------------------------------------------- inventory

def inventory_snapshots(t: DriverTables) -> DataFrame:
    p = t.part.select("p_partkey", "p_size", "p_retailprice",
                      F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    key = F.col("p_partkey")
    on_hand = (F.col("p_size") * 4 + F.col("k")).cast("int")
    reserved = (F.col("p_size") % 3).cast("int")
    day = F.date_add(F.lit(SNAPSHOT_START).cast("date"), F.col("k") * 7)
    return p.select(
        (key * 1000 + F.col("k")).alias("id"),
        key.alias("product_id"),
        F.date_format(day, "yyyy-MM-dd").alias("snapshot_date"),
        on_hand.alias("quantity_on_hand"),
        reserved.alias("quantity_reserved"),
        (on_hand - reserved).cast("int").alias("quantity_available"),
        m(m("p_retailprice") * dec("0.45")).alias("unit_cost"),
        m(on_hand * m("p_retailprice")).alias("total_value"),
        _cycle(key, WAREHOUSES).alias("warehouse_location"),
        day.cast("timestamp").alias("created_at"),
        day.cast("timestamp").alias("updated_at"),
    )


def inventory_movements(t: DriverTables, items: DataFrame | None = None) -> DataFrame:
    items = order_items(t) if items is None else items
    key = F.col("id")
    kind = key % 5
    qty = F.when(kind.isin(1, 3), -F.col("quantity")).otherwise(F.col("quantity")).cast("int")
    unit_cost = m(F.col("unit_price") * dec("0.45"))
    return items.select(
        key.alias("id"),
        "product_id",
        _cycle(key, MOVEMENT_TYPES).alias("movement_type"),
        qty.alias("quantity"),
        unit_cost.alias("unit_cost"),
        m(unit_cost * qty).alias("total_cost"),
        F.concat(F.lit(" ORD-"), F.col("order_id").cast("string")).alias("reference_id"),
        _cycle(F.col("order_id"), WAREHOUSES).alias("warehouse_location"),
        F.lit(None).cast("string").alias("notes"),
        F.date_format("created_at", "yyyy-MM-dd").alias("movement_date"),
        "created_at",
        "updated_at",
    )


# --------------------------------------------------------------------------- change feeds

def change_feed(t: DriverTables) -> DataFrame:
    """Keyed change feed for merge and streaming: one event = one new version of entity ``id``."""
    ts = F.col("ts").cast("timestamp")
    return t.events.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("status"),
        F.col("value").alias("amount"),
        F.col("event_id"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def product_versions(t: DriverTables) -> list[DataFrame]:
    """Three successive extracts of products for SCD2 (v2 re-prices, v3 drops and adds)."""
    v1 = products(t)
    v2 = v1.withColumn("price", F.when(F.col("id") % 10 == 0, m(F.col("price") * dec("1.1")))
                       .otherwise(F.col("price")))
    added = (v1.filter(F.col("id") % 100 == 7)
             .withColumn("id", -F.col("id"))
             .withColumn("sku", F.concat(F.lit("sku-n"), F.col("id").cast("string"))))
    v3 = v2.filter(F.col("id") % 100 != 3).unionByName(added)
    return [v1, v2, v3]


BUILDERS = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "refunds": refunds,
    "campaigns": campaigns,
    "ad_sets": ad_sets,
    "ads": ads,
    "daily_performance": daily_performance,
    "inventory_snapshots": inventory_snapshots,
    "inventory_movements": inventory_movements,
}


class LazyFeeds(Mapping):
    """The 12 raw feeds, each built on first access (plans are cheap but not free to analyse);
    ``order_items`` is built once and shared by refunds and movements. With ``path`` it is written there
    first: for work that reads several of these feeds, or one of them several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, path: str | None = None):
        self.t = DriverTables(spark, sf_dir)
        self._built: dict[str, DataFrame] = {} if path is None else {"order_items": landed_order_items(self.t, path)}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in BUILDERS:
            raise KeyError(name)
        if name not in self._built:
            if name in ("refunds", "inventory_movements"):
                self._built[name] = BUILDERS[name](self.t, self["order_items"])
            else:
                self._built[name] = BUILDERS[name](self.t)
        return self._built[name]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def raw_feeds(spark: SparkSession, sf_dir: str, path: str | None = None) -> LazyFeeds:
    """All 12 raw feeds as lazy DataFrames (built on first access); order items are written to ``path``, if given."""
    return LazyFeeds(spark, sf_dir, path)


def raw_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](DriverTables(spark, sf_dir))


# --------------------------------------------------------------------------- page files

def row_index(df: DataFrame, order: list[str], name: str = "_rn") -> DataFrame:
    """0-based global position of each row in ``order`` without a single-partition window.

    ``orderBy`` range-partitions the rows; per-partition counts (one row per partition) give
    each partition's offset, which is joined back (broadcast: its size is the partition count).
    """
    ordered = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_mid", F.monotonically_increasing_id())
    # Partition ids must be the same for the counts and the join: pin them with a reliable checkpoint.
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ordered.join(F.broadcast(offsets.select("_pid", "_off", "_first")), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_pid", "_mid", "_off", "_first"))


def write_pages(df: DataFrame, path: str, pk: tuple[str, ...], page_size: int = 500) -> None:
    """Land a feed as page envelopes ordered by primary key (the serving side of S1).

    Page numbers come from a global rank on the key; each page holds at most ``page_size``
    rows, so every ``collect_list`` group is bounded."""
    numbered = row_index(df, list(pk), "_rn")
    n = numbered.count()  # of the rows that were put in order, not of the feed's plan again
    total_pages = max(1, -(-n // page_size))
    pages = (numbered.groupBy((F.col("_rn") / page_size).cast("long").alias("_p"))
             .agg(F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.struct(*[F.col(c) for c in df.columns]).alias("row"))))
                  .alias("_rows")))
    out = pages.select(
        F.transform("_rows", lambda x: x["row"]).alias("data"),
        (F.col("_p") + 1).cast("int").alias("page"),
        F.lit(page_size).alias("page_size"),
        F.lit(n).cast("long").alias("total_count"),
        F.lit(total_pages).alias("total_pages"),
        (F.col("_p") + 1 < total_pages).alias("has_next"),
        (F.col("_p") > 0).alias("has_previous"),
    )
    out.write.mode("overwrite").option("compression", "gzip").json(path)
