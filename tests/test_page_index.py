"""L0: pages of a stored listing equal those found by offset."""
import pytest
from pyspark.sql import functions as F

from tillroll.operators.listing import list_page
from tillroll.operators.page_index import StoredListing, store_listing


def both(df, stored, page, size):
    a, b = list_page(df, "orders", {"customer_id": 1}, page, size), stored.page(page, size)
    assert a.envelope() == b.envelope()
    key = lambda p: [r.id for r in p.data.collect()]
    assert key(a) == key(b)


def test_pages_by_index(spark, scratch):
    df = spark.range(3000).selectExpr("id * 7 % 3001 AS id", "id % 3 AS customer_id").repartition(5)
    store_listing(df, scratch, "orders", {"customer_id": 1}, range_rows=90)
    stored = StoredListing(spark, scratch)
    assert 8 <= stored.index.count() <= 12
    for page, size in ((1, 100), (5, 100), (10, 100), (11, 100), (2, 1), (1, 1000), (7, 37)):
        both(df, stored, page, size)
    with pytest.raises(ValueError):
        stored.page(0, 10)


def test_equal_and_null_keys_and_empty_listings(spark, scratch):
    ids = [None] * 40 + [5] * 60 + list(range(100))
    df = spark.createDataFrame([(i, 1) for i in ids], "id long, customer_id long")
    store_listing(df, f"{scratch}/a", "orders", {"customer_id": 1}, range_rows=20)
    for page, size in ((1, 30), (2, 30), (3, 30), (4, 30), (7, 30), (8, 30), (1, 200)):
        both(df, StoredListing(spark, f"{scratch}/a"), page, size)
    store_listing(df.where(F.lit(False)), f"{scratch}/b", "orders")
    empty = StoredListing(spark, f"{scratch}/b").page(1, 10)
    assert empty.total_count == 0 and empty.data.count() == 0 and empty.total_pages == 1


def test_a_page_reads_its_ranges_only(spark, scratch):
    store_listing(spark.range(20000).withColumn("customer_id", F.lit(1)), scratch, "orders", range_rows=1000)
    data = StoredListing(spark, scratch).page(150, 100).data
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id" in plan and "LessThanOrEqual(id" in plan


def test_files_go_by_rows_and_equal_keys_stay_in_one_range(spark, scratch):
    import os
    ids = [i // 7 for i in range(700)] + [None] * 15
    df = spark.createDataFrame([(i, 1) for i in ids], "id long, customer_id long")
    store_listing(df, scratch, "orders", {"customer_id": 1}, range_rows=10)
    assert sum(n.endswith(".parquet") for n in os.listdir(f"{scratch}/rows")) == 1  # 72 before, one a range
    stored = StoredListing(spark, scratch)
    ranges = stored.index.orderBy("before").collect()
    assert len(ranges) > 40 and ranges[0].last_key is None and sum(r.rows for r in ranges) == 715
    assert all(r.rows == 7 * (r.last_key - (-1 if r.after_key is None else r.after_key)) for r in ranges[1:])
    for page, size in ((1, 20), (3, 20), (30, 20), (36, 20), (37, 20)):
        both(df, stored, page, size)
