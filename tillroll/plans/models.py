"""One lazy model graph over a set of raw feeds (the dbt DAG as plain function calls).

sources -> 12 staging views -> fct_orders, fct_daily_marketing_performance,
recon_orders_vs_items, recon_payments_vs_refunds -> recon_marketing_spend_vs_revenue.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import marts, recon
from tillroll.plans.parallel import side_by_side
from tillroll.plans.staging import build_staging
from tillroll.sources.fixtures import raw_feeds

# Fixed reconciliation time of the registered queries (stands in for current_timestamp()).
RUN_TS = "2024-01-01 00:00:00"


class RetailModels:
    def __init__(self, raw: dict[str, DataFrame], run_ts: str | None = RUN_TS):
        self.raw = raw
        self.run_ts = run_ts
        self.stg = build_staging(raw)

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, run_ts: str | None = RUN_TS) -> "RetailModels":
        return cls(raw_feeds(spark, sf_dir), run_ts)

    @cached_property
    def fct_orders(self) -> DataFrame:
        s = self.stg
        return marts.fct_orders(s["stg_orders"], s["stg_customers"], s["stg_order_items"],
                                s["stg_payments"], s["stg_refunds"])

    @cached_property
    def fct_daily_marketing_performance(self) -> DataFrame:
        s = self.stg
        return marts.fct_daily_marketing_performance(s["stg_daily_performance"], s["stg_ads"],
                                                     s["stg_ad_sets"], s["stg_campaigns"])

    @cached_property
    def recon_orders_vs_items(self) -> DataFrame:
        return recon.recon_orders_vs_items(self.stg["stg_orders"], self.stg["stg_order_items"], self.run_ts)

    @cached_property
    def recon_payments_vs_refunds(self) -> DataFrame:
        return recon.recon_payments_vs_refunds(self.stg["stg_payments"], self.stg["stg_refunds"], self.run_ts)

    @cached_property
    def recon_marketing_spend_vs_revenue(self) -> DataFrame:
        return recon.recon_marketing_spend_vs_revenue(self.fct_daily_marketing_performance, self.run_ts)

    MART_NAMES = ("fct_orders", "fct_daily_marketing_performance", "recon_orders_vs_items",
                  "recon_payments_vs_refunds", "recon_marketing_spend_vs_revenue")

    #: Marts that read another mart.
    AFTER = ("recon_marketing_spend_vs_revenue",)

    def materialized(self, root: str) -> "RetailModels":
        """Write raw tables and marts once (Parquet under ``root``) and rebuild the graph over them.

        Staging stays a view over the written raw tables; tables that don't read each other are written side
        by side, the marketing reconciliation after the fact that it reads. Tests and reports then scan
        tables instead of re-deriving the whole lineage per test."""
        spark = next(iter(self.raw.values())).sparkSession
        root = root.rstrip("/")
        def written(df: DataFrame, path: str) -> DataFrame:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            return spark.read.parquet(path)

        names = list(self.raw)
        raw = side_by_side(spark, lambda name: written(self.raw[name], f"{root}/raw/{name}"), names, "raw tables")
        out = RetailModels(dict(zip(names, raw)), self.run_ts)
        for marts in ([n for n in self.MART_NAMES if n not in self.AFTER], list(self.AFTER)):
            made = side_by_side(spark, lambda name: written(out.model(name), f"{root}/mart/{name}"), marts, "marts")
            out.__dict__.update(zip(marts, made))
        return out

    def tables(self) -> dict[str, DataFrame]:
        """Every raw table, staging view and mart by name."""
        d = dict(self.raw)
        d.update(self.stg)
        for n in self.MART_NAMES:
            d[n] = self.model(n)
        return d

    def model(self, name: str) -> DataFrame:
        if name in self.stg:
            return self.stg[name]
        if name in self.MART_NAMES:
            return getattr(self, name)
        if name in self.raw:
            return self.raw[name]
        raise KeyError(name)
