import json

from tillroll.operators.quarantine import REASONS, QUARANTINED_AT, rule as R, validate_and_split, write_quarantine

SCHEMA = "id long, name string, price double, status string"


def split(spark, rows, rules):
    df = spark.createDataFrame(rows, SCHEMA)
    valid, bad = validate_and_split(df, rules, run_ts="2024-01-01 00:00:00")
    return valid.collect(), bad.collect()


def test_valid_record(spark):
    v, b = split(spark, [(1, "Test", 10.0, None)], [R("id", "not_null"), R("price", "positive")])
    assert len(v) == 1 and not b


def test_null_id_quarantined(spark):
    v, b = split(spark, [(None, "Test", None, None)], [R("id", "not_null")])
    assert not v and len(b) == 1
    assert json.loads(b[0][REASONS]) == ["id must not be null"]
    assert b[0][QUARANTINED_AT] is not None


def test_negative_and_zero_price(spark):
    v, b = split(spark, [(1, None, -5.0, None), (2, None, 0.0, None)], [R("price", "positive")])
    assert not v and len(b) == 2


def test_in_list_invalid_and_null(spark):
    rules = [R("status", "in_list", values=["active", "paused"])]
    v, b = split(spark, [(1, None, None, "invalid_status"), (2, None, None, None), (3, None, None, "active")], rules)
    assert [r["id"] for r in v] == [3]
    assert sorted(r["id"] for r in b) == [1, 2]
    # None listed: null passes
    v, b = split(spark, [(2, None, None, None)], [R("status", "in_list", values=["active", None])])
    assert len(v) == 1 and not b


def test_mixed_batch(spark):
    rows = [(1, None, 10.0, None), (2, None, -1.0, None), (None, None, 5.0, None), (3, None, 20.0, None)]
    v, b = split(spark, rows, [R("id", "not_null"), R("price", "positive")])
    assert len(v) == 2 and len(b) == 2


def test_reasons_in_rule_order_json_dumps_format(spark):
    v, b = split(spark, [(None, None, -1.0, "x")], [R("id", "not_null"), R("price", "positive"),
                                                    R("status", "in_list", values=["a"]), R("price", "min_value", min=0)])
    text = b[0][REASONS]
    expected = ["id must not be null", "price must be positive", "status must be in ['a']", "price must be >= 0"]
    assert text == json.dumps(expected)


def test_missing_field_counts_as_null(spark):
    v, b = split(spark, [(1, "n", 1.0, "a")], [R("no_such_field", "not_null")])
    assert not v and json.loads(b[0][REASONS]) == ["no_such_field must not be null"]


def test_unknown_rule_raises(spark):
    import pytest
    df = spark.createDataFrame([(1, "n", 1.0, "a")], SCHEMA)
    with pytest.raises(ValueError):
        validate_and_split(df, [R("id", "custom")])


def test_quarantine_of_a_load_is_replaced_by_its_retry(spark, scratch):
    df = spark.createDataFrame([(None, "n", 1.0, "a"), (2, "n", 1.0, "a")], SCHEMA)
    _, bad = validate_and_split(df, [R("id", "not_null")], run_ts="2024-01-01 00:00:00")
    assert write_quarantine(bad, scratch, "t", "load-1") == 1
    assert write_quarantine(bad, scratch, "t", "load-1") == 1
    assert write_quarantine(bad, scratch, "t", "load-2") == 1
    assert write_quarantine(bad.where("false"), scratch, "t", "load-3") == 0
    got = sorted(r["load_id"] for r in spark.read.parquet(f"{scratch}/t_quarantine").collect())
    assert got == ["load-1", "load-2"]
