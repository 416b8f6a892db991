"""The order fact kept up with its raw tables, load by load (M1 with K1 and K5).

``refresh_order_facts`` works out which orders the loads since the last refresh can have changed, builds the fact
for these only and merges it. An order is affected if its own row, its customer, or an item, payment or refund
changed; a child that moved to another order affects both, so the rows before a change are looked up too (the
raw tables keep their last versions). Where the versions that the fact was built from are no longer kept, all
orders are built again; the result is the same.

The fact is a merged table with a row for each order and payment (an order without payments has one with a
null payment). A row that an affected order no longer has is marked, and not read. The table's load id names
the raw versions that it was built from, so fact and state change together and a refresh without new loads does
nothing. Of two refreshes at once the one that publishes later raises.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import merge
from tillroll.plans import marts, staging
from tillroll.plans.parallel import side_by_side
from tillroll.plans.run import layer_path, raw_table
from tillroll.session import cut_lineage

#: Raw tables that the fact reads, and the column that leads from a changed row to its order.
ORDER_OF = {"orders": "id", "order_items": "order_id", "payments": "order_id", "refunds": "order_id"}
TABLES = [*ORDER_OF, "customers"]
KEY = ["order_id", "payment_id"]
GONE, EPOCH = "_gone", "_epoch"


def _facts(spark: SparkSession, root: str) -> merge.MergedTable:
    return merge.MergedTable(spark, layer_path(root, "mart", "fct_orders_live"))


def read_order_facts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The fact as of the last refresh, in the columns of ``fct_orders``."""
    rows = _facts(spark, root).read(version)
    return None if rows is None else rows.where(~F.col(GONE)).drop("payment_id", GONE, EPOCH, *merge.METADATA)


def changed_values(table: merge.MergedTable, seen: int, now: int, pk: str, column: str) -> DataFrame | None:
    """The values of ``column`` in rows that changed after version ``seen``, before and after the change;
    None if that version is no longer kept."""
    before = table.manifest(seen)
    if before is None:
        return None
    after = table.read(now).where(F.col(merge.LOAD_SEQ) > before["load_seq"]).select(F.col(pk).alias("__pk"), F.col(column).alias("__id"))
    if column == pk:
        return after.select("__id")
    was = table.read(seen).join(after.select("__pk"), F.col(pk).eqNullSafe(F.col("__pk")), "left_semi")
    return after.select("__id").union(was.select(column))


def affected_orders(raw: dict[str, DataFrame], tables: dict[str, merge.MergedTable], seen: dict[str, int], now: dict[str, int]) -> DataFrame | None:
    """The ids (``__id``) of all orders whose fact can differ between the two states; None if that can't be told."""
    parts = []
    for name in (n for n in TABLES if seen[n] != now[n]):
        found = changed_values(tables[name], seen[name], now[name], "id", ORDER_OF.get(name, "id"))
        if found is None:
            return None
        if name == "customers":
            found = raw["orders"].join(found, F.col("customer_id") == F.col("__id"), "left_semi").select(F.col("id").alias("__id"))
        parts.append(found)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


#: Parts of a refresh that are written at once.
PARTS_AT_ONCE = 2


def _written(spark: SparkSession, at: str, parts: dict[str, DataFrame]) -> list[DataFrame]:
    """``parts``, each written under ``at`` by a query of its own and read from there."""
    def write(name: str) -> DataFrame:
        parts[name].write.option("compression", "zstd").parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    return side_by_side(spark, write, list(parts), f"order-facts-{at.rpartition('/')[2]}", PARTS_AT_ONCE)


def refresh_order_facts(spark: SparkSession, root: str) -> DataFrame:
    """Bring the fact up to the raw tables' current versions and return it."""
    tables = {n: raw_table(spark, root, n) for n in TABLES}
    now = {n: t.current_version() for n, t in tables.items()}
    absent = [n for n, v in now.items() if v is None]
    if absent:
        raise ValueError(f"raw tables not loaded yet: {', '.join(absent)}")
    state, live = ",".join(f"{n}={v}" for n, v in now.items()), _facts(spark, root)
    last = live.manifest()
    if last is not None and last["load_id"] == state:
        return read_order_facts(spark, root)
    raw = {n: t.read(now[n]).drop(*merge.METADATA) for n, t in tables.items()}
    ids = None
    if last is not None:
        seen = {n: int(v) for n, v in (x.split("=") for x in last["load_id"].split(","))}
        ids = affected_orders(raw, tables, seen, now)
    if ids is not None:
        ids = cut_lineage(ids)  # read once for every table below
        for name, column in ORDER_OF.items():
            raw[name] = raw[name].join(ids, F.col(column).eqNullSafe(F.col("__id")), "left_semi")
    orders, payments = staging.stg_orders(raw["orders"]), staging.stg_payments(raw["payments"])
    items = marts.item_totals(staging.stg_order_items(raw["order_items"]))
    refunds = marts.refund_totals(staging.stg_refunds(raw["refunds"]))
    building = layer_path(root, "mart", f"fct_orders_live/building/{uuid.uuid4().hex}")
    try:
        if last is not None:
            # A merged table of several runs takes some shuffles to read. With all of them in one query, the driver holds
            # the tasks and map outputs of some forty stages at once; so what is one row an order is worked out first.
            keys = (orders.select(F.col("order_id").alias("__order"))
                    .join(payments.select("order_id", F.col("payment_id").alias("__payment")), F.col("__order") == F.col("order_id"), "left")
                    .select("__order", "__payment"))
            items, refunds, keys = _written(spark, building, {"items": items, "refunds": refunds, "keys": keys})
        batch = marts.order_fact(orders, staging.stg_customers(raw["customers"]), items, payments, refunds,
                                 with_payment_id=True).withColumn(GONE, F.lit(False))
        if last is not None:
            old = live.read(last["version"]).where(~F.col(GONE)).select(*batch.columns)
            if ids is not None:
                old = old.join(ids, F.col("order_id").eqNullSafe(F.col("__id")), "left_semi")
            same = F.col("a.order_id").eqNullSafe(F.col("b.__order")) & F.col("a.payment_id").eqNullSafe(F.col("b.__payment"))
            batch = batch.unionByName(old.alias("a").join(keys.alias("b"), same, "left_anti").withColumn(GONE, F.lit(True)))
        live.upsert(batch.withColumn(EPOCH, F.timestamp_seconds(F.lit(0))), KEY, state, (last["version"] if last else 0) + 1, cursor=EPOCH)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(building)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return read_order_facts(spark, root)
