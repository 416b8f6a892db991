"""Feed registry (S5-S18), page-envelope reader (S1) and warehouse scans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import EVOLVED_COLUMNS, FEED_SCHEMAS, page_envelope

PAGE_SIZE = 500  # records of one page of a feed


@dataclass(frozen=True)
class FeedSpec:
    """An incremental resource: name, primary key, cursor column, merge disposition."""
    name: str
    pk: tuple[str, ...] = ("id",)
    cursor: str = "updated_at"
    disposition: str = "merge"
    schema: T.StructType | None = field(default=None, compare=False, hash=False)

    @property
    def row_schema(self) -> T.StructType:
        return self.schema or FEED_SCHEMAS[self.name]


def _specs(names: list[str]) -> list[FeedSpec]:
    return [FeedSpec(n) for n in names]


# Domains in load order. `categories` exists at the source but is never loaded.
DOMAINS: dict[str, dict] = {
    "commerce": {"pipeline_name": "commerce", "dataset": "raw",
                 "feeds": _specs(["customers", "products", "orders", "order_items", "payments", "refunds"])},
    "marketing": {"pipeline_name": "marketing", "dataset": "raw_marketing",
                  "feeds": _specs(["campaigns", "ad_sets", "ads", "daily_performance"])},
    "inventory": {"pipeline_name": "inventory", "dataset": "raw_inventory",
                  "feeds": _specs(["inventory_snapshots", "inventory_movements"])},
}


def feed(name: str) -> FeedSpec:
    for d in DOMAINS.values():
        for f in d["feeds"]:
            if f.name == name:
                return f
    raise KeyError(name)


class IncompleteExtract(ValueError):
    """An extract whose pages aren't one whole listing; the message names them."""


def _pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(page_envelope(schema)).option("mode", "FAILFAST").json(path)


#: What identifies the listing that a page was cut from.
LISTING = ("page_size", "total_count", "total_pages")


def page_faults(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """What is wrong with the extracts (folders of page files) under ``path``: extract, fault, first_page and
    last_page. No row: each extract is one whole listing. The faults are

    - ``foreign``: a page whose page size, totals or number fit another listing than most pages of its extract;
    - ``doubled``: a page that is there more than once;
    - ``missing``: a stretch of pages that aren't there;
    - ``miscounted``: a page that doesn't hold the records its number and the totals say, or denies its successor.

    Pages are small rows here (the envelope without its records). A missing stretch begins after a page without a
    successor and ends before one without a predecessor, which are anti-joins by page number; only such edges
    are put in order."""
    pages = _pages(spark, path, spec.row_schema).select(
        F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]*$", 1).alias("extract"), "page", F.struct(*LISTING).alias("listing"),
        "has_next", "has_previous", F.size("data").alias("records"))
    usual = (pages.groupBy("extract", "listing").count().groupBy("extract")
             .agg(F.max_by("listing", F.struct("count", "listing")).alias("usual")))
    known = pages.join(usual, "extract")
    last = F.greatest(F.col("usual.total_pages"), F.lit(1))
    fits = F.col("listing").eqNullSafe(F.col("usual")) & F.col("page").between(1, last)
    foreign = known.where(~F.coalesce(fits, F.lit(False))).select("extract", F.lit("foreign").alias("fault"), F.col("page").alias("first_page"),
                                                                  F.col("page").alias("last_page"))
    known = known.where(fits)
    numbers = known.groupBy("extract", "page").agg(F.count(F.lit(1)).alias("n"), F.first(last).alias("last"))
    doubled = numbers.where("n > 1").select("extract", F.lit("doubled").alias("fault"), F.col("page").alias("first_page"), F.col("page").alias("last_page"))
    full = F.when(F.col("page") < last, F.col("usual.page_size")).otherwise(
        F.col("usual.total_count") - (last - 1) * F.col("usual.page_size"))
    right = (F.col("records") == full) & (F.col("has_next") == (F.col("page") < last)) & (F.col("has_previous") == (F.col("page") > 1))
    miscounted = known.where(~F.coalesce(right, F.lit(False))).select(
        "extract", F.lit("miscounted").alias("fault"), F.col("page").alias("first_page"), F.col("page").alias("last_page")).distinct()

    ends = usual.select("extract", last.alias("last"))
    there = numbers.select("extract", "page")
    starts = (numbers.select("extract", (F.col("page") + 1).alias("page"), "last").unionByName(ends.select("extract", F.lit(1).alias("page"), "last"))
              .where("page <= last").distinct().join(there, ["extract", "page"], "left_anti"))
    stops = (numbers.select("extract", (F.col("page") - 1).alias("page")).unionByName(ends.select("extract", F.col("last").alias("page")))
             .where("page >= 1").distinct().join(there, ["extract", "page"], "left_anti"))
    order = F.row_number().over(Window.partitionBy("extract").orderBy("page"))
    missing = starts.select("extract", F.col("page").alias("first_page"), order.alias("gap")).join(
        stops.select("extract", F.col("page").alias("last_page"), order.alias("gap")), ["extract", "gap"])
    return foreign.unionByName(doubled).unionByName(miscounted).unionByName(
        missing.select("extract", F.lit("missing").alias("fault"), "first_page", "last_page"))


def read_pages(spark: SparkSession, path: str, spec: FeedSpec, evolved: bool = False, complete: bool = True) -> DataFrame:
    """Landed page files (one JSON envelope per line) -> one row per record.

    Files are split across tasks by Spark; an empty ``data`` array yields no rows (the
    paging loop's stop condition needs no driver-side loop here). A truncated or malformed page
    fails the read, and so does an extract with missing, doubled, foreign or miscounted pages, unless
    ``complete`` is off. With ``evolved`` the columns that a feed is known to gain (K3) are read too."""
    schema = spec.row_schema
    if evolved:
        schema = T.StructType(schema.fields + [T.StructField(n, k) for n, k in EVOLVED_COLUMNS.get(spec.name, [])])
    if complete:
        faults = page_faults(spark, path, spec).orderBy("extract", "first_page", "fault").limit(20).collect()  # for the message
        if faults:
            raise IncompleteExtract(f"{spec.name}: " + "; ".join(
                f"{r.fault} page {r.first_page}" + (f" to {r.last_page}" if r.last_page != r.first_page else "") + f" in {r.extract}" for r in faults))
    return _pages(spark, path, schema).select(F.explode("data").alias("r")).select("r.*")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A warehouse table (``source()`` / ``ref()``)."""
    return spark.read.option("mergeSchema", "true").parquet(path)
