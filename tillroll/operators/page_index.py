"""Deep pages of a listing (L0): a listing stored once in key order, with an index of its key ranges.

``store_listing`` writes the filtered rows range-partitioned and sorted by the key, and beside them one row a
range, a stretch of a file: its largest key, its number of rows and how many rows are before it. A page then needs two reads, the index
(rows / ``range_rows`` rows, filtered by Spark) and the ranges that hold the page, which Parquet's statistics find
from the key bounds; totals come from the index. So page 10,000 costs what page 1 does, where an offset costs all
the rows before it. The listing is that of the time it was stored.

Rows of equal keys are in one range, in no given order, as in ``list_page``; null keys come first.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .listing import Page, apply_filters, check_paging

RANGE_ROWS = 100_000
#: Rows of a file, which holds many ranges if these are small: files and tasks go by rows, not by ranges.
FILE_ROWS = 500_000


def store_listing(df: DataFrame, path: str, feed: str, params: dict | None = None, updated_since=None, order_by: str = "id",
                  range_rows: int = RANGE_ROWS) -> "StoredListing":
    """The filtered rows of ``feed`` at ``path``, and the index of their ranges of about ``range_rows`` rows each."""
    spark, filtered = df.sparkSession, apply_filters(df, feed, params or {}, updated_since)
    files = max(1, math.ceil(filtered.count() / max(range_rows, FILE_ROWS)))
    rows = filtered.repartitionByRange(files, order_by).sortWithinPartitions(order_by)
    rows.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(f"{path}/rows")
    # Files hold ranges of keys, each in order; ranges are cut by the rows' places in their file.
    placed = spark.read.parquet(f"{path}/rows").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), F.col(order_by).alias("key")).withColumn(
        "block", F.floor(F.col("at") / range_rows))
    placed.groupBy("file", "block").agg(
        F.min_by("key", "at").alias("first_key"), F.max_by("key", "at").alias("last_key"), F.count(F.lit(1)).alias("rows"),
        F.min("at").alias("start")).write.mode("overwrite").parquet(f"{path}/blocks")
    blocks = spark.read.parquet(f"{path}/blocks")
    stored = blocks.select("last_key", "rows")
    # Equal keys are in one range: where a key goes on into the next block, its rows there are counted with the block before.
    goes_on = blocks.withColumn("key_before", F.lag("last_key").over(Window.partitionBy("file").orderBy("block"))).where(
        (F.col("start") > 0) & F.col("first_key").eqNullSafe(F.col("key_before")) & ~F.col("first_key").eqNullSafe(F.col("last_key")))
    if not goes_on.isEmpty():
        goes_on = goes_on.select(F.col("file").alias("__file"), F.col("block").alias("__block"), "first_key", "last_key")
        moved = placed.join(goes_on, (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")) & F.col("key").eqNullSafe(F.col("first_key")))
        moved = moved.groupBy("file", "block", "first_key", "last_key").agg(F.count(F.lit(1)).alias("rows"))
        stored = (stored.unionByName(moved.select(F.col("first_key").alias("last_key"), "rows"))
                  .unionByName(moved.select("last_key", (-F.col("rows")).alias("rows"))))
    stored = stored.groupBy("last_key").agg(F.sum("rows").alias("rows"))
    earlier = Window.orderBy(F.col("last_key").asc_nulls_first())  # one row a range
    index = stored.select("last_key", "rows", (F.sum("rows").over(earlier) - F.col("rows")).alias("before"),
                          F.lag("last_key").over(earlier).alias("after_key"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")
    return StoredListing(spark, path, order_by)


class StoredListing:
    """Pages of what ``store_listing`` has written."""

    def __init__(self, spark: SparkSession, path: str, order_by: str = "id"):
        self.rows, self.index, self.order_by = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/index"), order_by

    def page(self, page: int = 1, page_size: int = 100) -> Page:
        check_paging(page, page_size)
        start = (page - 1) * page_size
        needed = (F.col("before") < start + page_size) & (F.col("before") + F.col("rows") > start)
        only = lambda c: F.when(needed, F.col(c))
        found = self.index.agg(F.sum("rows").alias("total"), F.min(only("before")).alias("before"), F.max(only("last_key")).alias("last"),
                               F.min_by("after_key", only("before")).alias("after"), F.count_if(needed).alias("ranges")).first()
        key = F.col(self.order_by)
        if not found["ranges"]:
            return Page(self.rows.limit(0), page, page_size, found["total"] or 0)
        # The first range has nothing before it and holds the null keys.
        part = self.rows
        if found["last"] is not None:
            inside = key <= F.lit(found["last"])
            part = part.where(key.isNull() | inside if found["before"] == 0 else inside)
        if found["after"] is not None:
            part = part.where(key > F.lit(found["after"]))
        elif found["before"]:
            part = part.where(key.isNotNull())  # the range before held null keys only
        return Page(part.orderBy(key.asc_nulls_first()).offset(start - found["before"]).limit(page_size), page, page_size, found["total"])
