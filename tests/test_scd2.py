import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.operators.scd2 import changed_versions, snapshot_check

SCHEMA = "product_id long, price int, name string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def snap(spark, snapshot, rows, ts):
    return snapshot_check(snapshot, spark.createDataFrame(rows, SCHEMA), "product_id", ["price"], ts)


def test_three_batches(spark):
    s1 = snap(spark, None, [(1, 10, "a"), (2, 20, "b"), (3, None, "c")], T1)
    s2 = snap(spark, s1, [(1, 11, "a"), (2, 20, "renamed"), (3, None, "c")], T2)   # 1 re-priced, 2 renamed only
    s3 = snap(spark, s2, [(1, 11, "a"), (4, 40, "d")], T3)                          # 2 and 3 vanish, 4 new
    rows = sorted((r["product_id"], r["price"], r["name"], r["valid_from"], r["valid_to"]) for r in s3.collect())
    d = dt.datetime
    assert rows == [
        (1, 10, "a", d(2024, 1, 1), d(2024, 2, 1)),
        (1, 11, "a", d(2024, 2, 1), None),
        (2, 20, "b", d(2024, 1, 1), None),       # a non-check column change opens no version
        (3, None, "c", d(2024, 1, 1), None),     # null == null: unchanged; missing rows stay open
        (4, 40, "d", d(2024, 3, 1), None),
    ]


def test_rerun_same_source_adds_nothing(spark):
    s1 = snap(spark, None, [(1, 10, "a")], T1)
    s2 = snap(spark, s1, [(1, 10, "a")], T2)
    assert s2.count() == 1
    assert s2.first()["scd_id"] == s1.first()["scd_id"]


def fold(spark, rows_by_ts):
    """The history of extracts in order, by the in-order operator."""
    out = None
    for ts, rows in sorted(rows_by_ts.items()):
        out = snap(spark, out, rows, ts)
    return out


def test_extracts_in_any_order(spark):
    """Random extracts applied in random order give the history of the right order; unchanged versions aren't returned."""
    draw = random.Random(11)
    times = [f"2024-0{m}-01 00:00:00" for m in range(1, 7)]
    rows_of = {ts: [(k, draw.choice([None, 1, 2]), draw.choice("xy")) for k in range(14) if draw.random() < 0.75] for ts in times}
    want = sorted(map(str, fold(spark, rows_of).collect()))
    for seed in range(3):
        order = list(times)
        random.Random(seed).shuffle(order)
        history, taken = None, []
        for ts in order:
            source = spark.createDataFrame(rows_of[ts], SCHEMA)
            after = [t for t in taken if t > ts]
            later = None
            for t in after:
                part = spark.createDataFrame(rows_of[t], SCHEMA).withColumn("seen_at", F.lit(t).cast("timestamp"))
                later = part if later is None else later.unionByName(part)
            changed = changed_versions(history, later, source, "product_id", ["price"], ts)
            if history is None:
                history = changed.drop("removed")
            else:
                key = ["product_id", "valid_from"]
                kept = history.join(changed.select(key), key, "left_anti").select(history.columns)
                history = kept.unionByName(changed.where("NOT removed").select(history.columns))
            history = spark.createDataFrame(history.collect(), history.schema)
            taken.append(ts)
            # At every point it is the history of the extracts taken so far.
            assert sorted(map(str, history.collect())) == sorted(map(str, fold(spark, {t: rows_of[t] for t in taken}).collect()))
        assert sorted(map(str, history.collect())) == want


def test_only_changed_versions_are_returned(spark):
    history = fold(spark, {T1: [(1, 10, "a"), (2, 20, "b")], T2: [(1, 11, "a"), (2, 20, "b")]})
    got = changed_versions(history, None, spark.createDataFrame([(1, 11, "a"), (2, 21, "b")], SCHEMA), "product_id", ["price"], T3)
    assert sorted((r.product_id, r.price, r.valid_to is None) for r in got.collect()) == [(2, 20, False), (2, 21, True)]
