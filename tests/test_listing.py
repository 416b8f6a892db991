import pytest

from tillroll.operators.listing import get_by_id, list_page

SCHEMA = "id long, status string, total_amount double, created_at timestamp, updated_at timestamp"


@pytest.fixture()
def orders(spark):
    import datetime as dt
    rows = [(i, "delivered" if i % 2 else "pending", float(i), dt.datetime(2024, 1, 1 + i % 20),
             dt.datetime(2024, 2, 1 + i % 20)) for i in range(1, 251)]
    return spark.createDataFrame(rows, SCHEMA)


def test_page_math_and_disjoint_pages(orders):
    p1 = list_page(orders, "orders", {}, page=1, page_size=100)
    p3 = list_page(orders, "orders", {}, page=3, page_size=100)
    assert p1.total_count == 250 and p1.total_pages == 3 and p1.has_next and not p1.has_previous
    assert not p3.has_next and p3.has_previous
    ids1 = [r["id"] for r in p1.data.collect()]
    ids3 = [r["id"] for r in p3.data.collect()]
    assert ids1 == list(range(1, 101)) and ids3 == list(range(201, 251))


def test_filters_and_empty_string_ignored(orders):
    p = list_page(orders, "orders", {"status": "delivered", "min_total": 100, "max_total": 120, "customer_id": None,
                                     "created_after": ""}, page=1, page_size=1000)
    ids = [r["id"] for r in p.data.collect()]
    assert ids == [i for i in range(100, 121) if i % 2]
    empty = list_page(orders, "orders", {"status": "nope"})
    assert empty.total_count == 0 and empty.total_pages == 1


def test_updated_since_strict(orders):
    p = list_page(orders, "orders", {}, page_size=1000, updated_since="2030-01-01 00:00:00")
    assert p.total_count == 0


def test_bounds(orders):
    for page, size in [(0, 10), (1, 0), (1, 1001)]:
        with pytest.raises(ValueError):
            list_page(orders, "orders", {}, page=page, page_size=size)
    with pytest.raises(ValueError):
        list_page(orders, "orders", {"bogus": 1})


def test_get_by_id(orders):
    assert get_by_id(orders, 7).count() == 1
    assert get_by_id(orders, 9999).count() == 0


def test_keyset_pages_cover_the_feed(spark):
    from tillroll.operators import listing
    df = spark.range(95).selectExpr("id", "id % 3 AS customer_id")
    seen, last = [], -1
    while True:
        rows = [r.id for r in listing.list_page(df, "orders", {"customer_id": 1}, page_size=10, after=last).data.collect()]
        if not rows:
            break
        seen += rows
        last = rows[-1]
    assert seen == [i for i in range(95) if i % 3 == 1]
