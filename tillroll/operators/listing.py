"""Filtered, paged listings (L0-L12) and point lookups (F8): the query side of every feed route.

``list_page`` = optional filters -> total count -> ``orderBy(id).offset(o).limit(n)``. Spark
plans the page as a top-(o+n) per partition followed by a merge (TakeOrderedAndProject with an
offset), so a shallow page never sorts the whole table. A deep page costs its offset; a caller that
goes through all pages passes the last key it has (``after``) and each page costs its own size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PAGE_SIZE = 1000

# Listing filters per feed: parameter -> (column, comparison). Fixed by the feed routes.
LISTINGS: dict[str, dict[str, tuple[str, str]]] = {
    "customers": {"is_active": ("is_active", "eq"), "city": ("city", "eq"), "state": ("state", "eq"),
                  "country": ("country", "eq")},
    "products": {"category_id": ("category_id", "eq"), "brand": ("brand", "eq"), "is_active": ("is_active", "eq"),
                 "min_price": ("price", "ge"), "max_price": ("price", "le"), "color": ("color", "eq")},
    "orders": {"status": ("status", "eq"), "customer_id": ("customer_id", "eq"),
               "created_after": ("created_at", "ge"), "created_before": ("created_at", "le"),
               "min_total": ("total_amount", "ge"), "max_total": ("total_amount", "le")},
    "order_items": {"order_id": ("order_id", "eq"), "product_id": ("product_id", "eq")},
    "payments": {"order_id": ("order_id", "eq"), "payment_method": ("payment_method", "eq"),
                 "payment_status": ("payment_status", "eq")},
    "refunds": {"order_id": ("order_id", "eq"), "reason": ("reason", "eq"), "status": ("status", "eq")},
    "campaigns": {"platform": ("platform", "eq"), "status": ("status", "eq")},
    "ad_sets": {"campaign_id": ("campaign_id", "eq"), "status": ("status", "eq")},
    "ads": {"ad_set_id": ("ad_set_id", "eq"), "ad_type": ("ad_type", "eq"), "status": ("status", "eq")},
    "daily_performance": {"ad_id": ("ad_id", "eq"), "date_from": ("date", "ge"), "date_to": ("date", "le")},
    "inventory_snapshots": {"product_id": ("product_id", "eq"), "warehouse_location": ("warehouse_location", "eq"),
                            "snapshot_date": ("snapshot_date", "eq")},
    "inventory_movements": {"product_id": ("product_id", "eq"), "movement_type": ("movement_type", "eq"),
                            "warehouse_location": ("warehouse_location", "eq"),
                            "date_from": ("movement_date", "ge"), "date_to": ("movement_date", "le")},
}


@dataclass
class Page:
    data: DataFrame
    page: int
    page_size: int
    total_count: int

    @property
    def total_pages(self) -> int:
        return max(1, math.ceil(self.total_count / self.page_size))

    @property
    def has_next(self) -> bool:
        return self.page < self.total_pages

    @property
    def has_previous(self) -> bool:
        return self.page > 1

    def envelope(self) -> dict:
        return {"page": self.page, "page_size": self.page_size, "total_count": self.total_count,
                "total_pages": self.total_pages, "has_next": self.has_next, "has_previous": self.has_previous}

    def with_envelope(self) -> DataFrame:
        """Page rows with the envelope fields as columns."""
        types = {"total_count": "long", "has_next": "boolean", "has_previous": "boolean"}
        out = self.data
        for k, v in self.envelope().items():
            out = out.withColumn(k, F.lit(v).cast(types.get(k, "int")))
        return out


def _given(v) -> bool:
    # strings apply only when non-empty; numbers and booleans whenever not None
    return bool(v) if isinstance(v, str) else v is not None


def apply_filters(df: DataFrame, feed: str, params: dict, updated_since=None) -> DataFrame:
    """chain only the filters that were given; ``updated_since`` is strict (S3)."""
    spec = LISTINGS[feed]
    if updated_since is not None:
        df = df.filter(F.col("updated_at") > F.lit(str(updated_since)).cast("timestamp"))
    for name, value in params.items():
        if name not in spec:
            raise ValueError(f"unknown filter {name!r} for {feed}")
        if not _given(value):
            continue
        col, op = spec[name]
        c = F.col(col)
        lit = F.lit(value)
        if col in ("created_at", "updated_at"):
            lit = lit.cast("timestamp")
        df = df.filter(c == lit if op == "eq" else (c >= lit if op == "ge" else c <= lit))
    return df


def check_paging(page: int, page_size: int) -> None:
    if page < 1:
        raise ValueError("page must be >= 1")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")


def list_page(df: DataFrame, feed: str, params: dict | None = None, page: int = 1, page_size: int = 100,
              updated_since=None, order_by: str = "id", after=None) -> Page:
    """L0: one page of the filtered feed ordered by ``id`` and its totals. With ``after`` the rows are
    those that follow that key, whatever ``page`` says (it is only echoed)."""
    check_paging(page, page_size)
    filtered = apply_filters(df, feed, params or {}, updated_since)
    total = filtered.count()
    if after is not None:
        data = filtered.filter(F.col(order_by) > F.lit(after)).orderBy(order_by).limit(page_size)
    else:
        data = filtered.orderBy(order_by).offset((page - 1) * page_size).limit(page_size)
    return Page(data, page, page_size, int(total))


def get_by_id(df: DataFrame, value, key: str = "id") -> DataFrame:
    """F8: point lookup; an empty result means 'not found'. Pushed down to the Parquet scan."""
    return df.filter(F.col(key) == F.lit(value))
