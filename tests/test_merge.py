import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tillroll.operators import merge

SCHEMA = "id long, status string, updated_at timestamp"


def ts(h):
    return dt.datetime(2024, 1, 1, h)


def rows(df):
    return sorted((r["id"], r["status"], r["updated_at"]) for r in df.select("id", "status", "updated_at").collect())


def test_newest_wins_and_older_never_replaces(spark):
    target = spark.createDataFrame([(1, "a", ts(5)), (2, "b", ts(1))], SCHEMA)
    batch = spark.createDataFrame([(1, "old", ts(2)), (2, "new", ts(3)), (3, "c", ts(1))], SCHEMA)
    out = merge.merge_latest(target, batch, ["id"])
    assert rows(out) == [(1, "a", ts(5)), (2, "new", ts(3)), (3, "c", ts(1))]


def test_idempotent_same_batch_twice(spark):
    target = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)
    batch = merge.with_load_metadata(spark.createDataFrame([(1, "b", ts(2)), (4, "d", ts(2))], SCHEMA), "l1", 1, ["id"])
    once = merge.merge_latest(target, batch, ["id"])
    twice = merge.merge_latest(once, batch, ["id"])
    assert rows(once) == rows(twice)


def test_ties_resolved_by_load_sequence(spark):
    t = merge.with_load_metadata(spark.createDataFrame([(1, "first", ts(1))], SCHEMA), "l1", 1, ["id"])
    b = merge.with_load_metadata(spark.createDataFrame([(1, "second", ts(1))], SCHEMA), "l2", 2, ["id"])
    assert rows(merge.merge_latest(t, b, ["id"])) == [(1, "second", ts(1))]


def test_duplicates_within_batch(spark):
    b = spark.createDataFrame([(1, "x", ts(1)), (1, "y", ts(3)), (1, "z", ts(2))], SCHEMA)
    assert rows(merge.merge_latest(None, b, ["id"])) == [(1, "y", ts(3))]


def test_schema_evolution_adds_column(spark):
    target = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)
    batch = spark.createDataFrame([(2, "b", ts(2), "gold")], SCHEMA + ", loyalty_tier string")
    out = merge.merge_latest(target, batch, ["id"])
    got = {r["id"]: r["loyalty_tier"] for r in out.collect()}
    assert got == {1: None, 2: "gold"}


def test_parse_cursor():
    utc = dt.timezone.utc
    assert merge.parse_cursor(None) is None
    assert merge.parse_cursor("") is None
    assert merge.parse_cursor("1970-01-01T00:00:00") is None
    assert merge.parse_cursor("garbage") is None
    assert merge.parse_cursor("2024-01-01T05:00:00") == dt.datetime(2024, 1, 1, 4, tzinfo=utc)
    assert merge.parse_cursor("2024-01-01T05:00:00+09:00") == dt.datetime(2023, 12, 31, 19, tzinfo=utc)
    assert merge.parse_cursor(1704085200000001) == dt.datetime(2024, 1, 1, 4, 0, 0, 1, tzinfo=utc)


def test_incremental_cut_is_strict(spark):
    df = spark.createDataFrame([(1, "a", ts(1)), (2, "b", ts(2))], SCHEMA)
    assert [r["id"] for r in merge.incremental_cut(df, ts(1)).collect()] == [2]
    assert merge.incremental_cut(df, None).count() == 2
    assert merge.cursor_state(df).first()[0] == ts(2)


def test_replayed_load_changes_nothing(spark, scratch):
    table = merge.MergedTable(spark, f"{scratch}/t")
    b1 = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)
    table.upsert(b1, ["id"], "l1")
    b2 = spark.createDataFrame([(1, "b", ts(2))], SCHEMA)
    table.upsert(b2, ["id"], "l2")
    table.upsert(b1, ["id"], "l1")
    table.upsert(spark.createDataFrame([(9, "x", ts(9))], SCHEMA), ["id"], "l1")
    assert table.versions() == [1, 2]
    assert rows(table.read()) == [(1, "b", ts(2))] and rows(table.read(1)) == [(1, "a", ts(1))]
    assert table.row_count() == 1 and table.cursor_micros() == merge.micros(ts(2))


def test_another_load_with_a_used_sequence_raises(spark, scratch):
    table = merge.MergedTable(spark, f"{scratch}/t")
    batch = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)
    table.upsert(batch, ["id"], "l1", load_seq=5)
    with pytest.raises(ValueError, match="sequence"):
        table.upsert(batch, ["id"], "l2", load_seq=5)
    table.upsert(batch, ["id"], "l1", load_seq=5)  # the same load again
    assert table.versions() == [1]


def test_crash_between_data_and_publication(spark, scratch, monkeypatch):
    table = merge.MergedTable(spark, f"{scratch}/t")
    table.upsert(spark.createDataFrame([(1, "a", ts(1)), (2, "b", ts(1))], SCHEMA), ["id"], "l1")
    batch = spark.createDataFrame([(1, "a2", ts(3)), (3, "c", ts(3))], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(merge.MergedTable, "_publish", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            table.upsert(batch, ["id"], "l2")
    assert rows(table.read()) == [(1, "a", ts(1)), (2, "b", ts(1))] and table.cursor_micros() == merge.micros(ts(1))
    table.upsert(batch, ["id"], "l2")
    assert rows(table.read()) == [(1, "a2", ts(3)), (2, "b", ts(1)), (3, "c", ts(3))]


def test_a_small_load_writes_its_own_rows(spark, scratch):
    """200 rows into a million: under 5 % of the bytes are written, old runs go, every version kept is whole."""
    table = merge.MergedTable(spark, f"{scratch}/t", keep=2)
    t0 = "TIMESTAMP '2024-01-01 00:00:00'"
    first = spark.range(1_000_000).selectExpr("id", "uuid() AS status", f"{t0} AS updated_at")
    table.upsert(first, ["id"], "l0")
    whole = table.manifest()["runs"][0]["bytes"]
    for k in range(1, 12):
        batch = spark.range(200).selectExpr(f"pmod(xxhash64(id, {k}), 1000100) AS id", f"'v{k}' AS status", f"{t0} + INTERVAL {k} HOURS AS updated_at")
        before = {r["name"] for r in table.manifest()["runs"]}
        table.upsert(batch, ["id"], f"l{k}")
        assert sum(r["bytes"] for r in table.manifest()["runs"] if r["name"] not in before) < 0.05 * whole
        assert len(table.manifest()["runs"]) <= merge.MOST_RUNS
    assert table.versions() == [11, 12]
    used = {r["name"] for v in (11, 12) for r in table.manifest(v)["runs"]}
    assert set(os.listdir(f"{scratch}/t/data")) == used
    assert table.row_count() == table.read().count() == table.read().select("id").distinct().count()
    assert table.read().where("status = 'v11'").count() == table.read().where("status = 'v11'").select('id').distinct().count()
    assert table.read(11).where("status = 'v11'").count() == 0


def test_older_rows_never_replace_newer_ones_over_many_loads(spark, scratch):
    import random
    draw = random.Random(3)
    table, best = merge.MergedTable(spark, f"{scratch}/t"), {}
    for k in range(14):
        batch = [(draw.choice([None, *range(12)]), f"{k}-{i}", draw.choice([None, ts(draw.randint(1, 9))])) for i in range(6)]
        rows_of = {}
        for i, status, at in batch:
            rows_of.setdefault(i, []).append((at, status))
        table.upsert(spark.createDataFrame(batch, SCHEMA), ["id"], f"l{k}")
        now = {r["id"]: (r["updated_at"], r["status"]) for r in table.read().collect()}
        for i, got in rows_of.items():
            top = max((a for a, _ in got if a is not None), default=None)
            old = best.get(i)
            if old and old[0] is not None and (top is None or old[0] > top):
                assert now[i] == old
            else:
                assert now[i] in got and now[i][0] == top
        assert table.row_count() == len(now) and set(now) == set(best) | set(rows_of)
        best = now


def test_interleaved_writers_lose_nothing(spark, scratch, monkeypatch):
    """Three writers start from one version; each is overtaken between its merge and its publication."""
    path = f"{scratch}/t"
    merge.MergedTable(spark, path).upsert(spark.createDataFrame([(0, "a", ts(1))], SCHEMA), ["id"], "l0")
    evaluated = spark.sparkContext.accumulator(0)

    def load(k):
        def count(batches):
            for b in batches:
                evaluated.add(1)
                yield b
        return spark.createDataFrame([(k, f"w{k}", ts(2)), (0, f"w{k}", ts(1 + k))], SCHEMA).coalesce(1).mapInArrow(count, SCHEMA)

    publish, overtaken = merge.MergedTable._publish, []

    def late(self, manifest):
        k = int(manifest["load_id"][1:])
        if k < 3 and k not in overtaken:
            overtaken.append(k)
            merge.MergedTable(spark, path).upsert(load(k + 1), ["id"], f"l{k + 1}")
        return publish(self, manifest)

    monkeypatch.setattr(merge.MergedTable, "_publish", late)
    table = merge.MergedTable(spark, path)
    table.upsert(load(1), ["id"], "l1")
    assert overtaken == [1, 2]
    assert rows(table.read()) == [(0, "w3", ts(4)), (1, "w1", ts(2)), (2, "w2", ts(2)), (3, "w3", ts(2))]
    assert [r for k in range(4) for r in [table.applied(f"l{k}")]] == [True] * 4 and not table.applied("l9")
    assert table.row_count() == 4 and table.current_version() == 4
    assert evaluated.value == 3  # overtaken loads don't read their source again
    assert set(os.listdir(f"{path}/data")) == {r["name"] for v in table.versions() for r in table.manifest(v)["runs"]}


def test_the_same_load_by_two_writers_counts_once(spark, scratch, monkeypatch):
    path, publish, done = f"{scratch}/t", merge.MergedTable._publish, []
    batch = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)

    def late(self, manifest):
        if not done:
            done.append(merge.MergedTable(spark, path).upsert(batch, ["id"], "same"))
        return publish(self, manifest)

    done_once = []
    monkeypatch.setattr(merge.MergedTable, "_publish", lambda self, m: publish(self, m) if done_once else (done_once.append(1), late(self, m))[1])
    table = merge.MergedTable(spark, path)
    assert rows(table.upsert(batch, ["id"], "same")) == [(1, "a", ts(1))]
    assert table.versions() == [1] and len(os.listdir(f"{path}/data")) == 1


def test_one_scan_of_the_target_and_none_of_its_other_columns(spark, scratch):
    target = merge.with_load_metadata(spark.createDataFrame([(i, "a", ts(1)) for i in range(50)], SCHEMA), "l1", 1, ["id"])
    target.write.parquet(f"{scratch}/target")
    target = spark.read.parquet(f"{scratch}/target")
    batch = merge.with_load_metadata(spark.createDataFrame([(1, "b", ts(2))], SCHEMA), "l2", 2, ["id"])
    plan = merge.merge_latest(target, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_null_keys_are_one_key(spark, scratch):
    target = spark.createDataFrame([(None, "a", ts(1)), (1, "x", ts(1))], SCHEMA)
    batch = spark.createDataFrame([(None, "b", ts(2))], SCHEMA)
    got = {r["id"]: r["status"] for r in merge.merge_latest(target, batch, ["id"]).collect()}
    assert got == {None: "b", 1: "x"}


@pytest.mark.parametrize("columns, row", [
    ("id long, status string, updated_at string", (1, "x", "not a time")),      # changed type
    ("id double, status string, updated_at timestamp", (1.5, "x", ts(1))),      # a fraction into an integer
    ("id long, updated_at timestamp", (1, ts(1))),                              # removed column
])
def test_narrowed_and_removed_columns_raise(spark, scratch, columns, row):
    target = spark.createDataFrame([(1, "a", ts(1))], SCHEMA)
    batch = spark.createDataFrame([row], columns)
    with pytest.raises(TypeError):
        merge.merge_latest(target, batch, ["id"])
    table = merge.MergedTable(spark, f"{scratch}/t")
    table.upsert(target, ["id"], "l1")
    with pytest.raises(TypeError):
        table.upsert(batch, ["id"], "l2")
    assert table.versions() == [1]


def test_wider_columns_widen_the_target(spark, scratch):
    target = spark.createDataFrame([(1, 7, 1.5, ts(1))], "id int, n int, x float, updated_at timestamp")
    batch = spark.createDataFrame([(2**40, 8, 2.5, ts(2))], "id long, n int, x double, updated_at timestamp")
    table = merge.MergedTable(spark, f"{scratch}/t")
    table.upsert(target, ["id"], "l1")
    out = table.upsert(batch, ["id"], "l2")
    assert dict(out.dtypes)["id"] == "bigint" and dict(out.dtypes)["x"] == "double"
    assert sorted((r.id, r.x) for r in out.collect()) == [(1, 1.5), (2**40, 2.5)]


def test_the_machines_time_zone_has_no_part(tmp_path):
    """A row between the load's cursor and now is taken in Tokyo as in UTC."""
    code = """
import sys; sys.path.insert(0, %r)
import datetime as dt
from tillroll.session import build_session
from tillroll.operators import merge
spark = build_session(master="local[1]", shuffle_partitions=1)
t = merge.MergedTable(spark, sys.argv[1])
make = lambda i, h: spark.sql(f"SELECT CAST({i} AS BIGINT) AS id, TIMESTAMP '2024-01-01 {h}:00:00' AS updated_at")
t.upsert(make(1, 12), ["id"], "l1")
feed = make(1, 12).union(make(2, 15))
t.upsert(merge.incremental_cut(feed, merge.parse_cursor(t.cursor_micros())), ["id"], "l2")
print("IDS", sorted(r.id for r in t.read().collect()), t.cursor_micros())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = []
    for zone in ("UTC", "Asia/Tokyo"):
        out = subprocess.run([sys.executable, "-c", code % root, str(tmp_path / zone.replace("/", "-"))], capture_output=True, text=True,
                             env={**os.environ, "TZ": zone}, timeout=300)
        got.append([x for x in out.stdout.splitlines() if x.startswith("IDS")])
    assert got[0] == got[1] == ["IDS [1, 2] 1704121200000000"]


def test_a_load_writes_its_rows_once(spark, scratch):
    """What was handed over is the run; only repeats of a key or rows older than the table's make it write again."""
    written = []

    class Counting(merge.MergedTable):
        def _written(self, frame):
            written.append(super()._written(frame))
            return written[-1]

    table = Counting(spark, f"{scratch}/t")

    def load(rows_, name, writes):
        written.clear()
        batch = spark.createDataFrame(rows_, SCHEMA)
        table.upsert(batch, ["id"], name)
        assert len(written) == writes
        assert merge.ROW_ID not in {f["name"] for w in written for f in w["schema"]["fields"]}

    load([(i, "a", ts(1)) for i in range(20)], "l1", 1)
    load([(5, "b", ts(2)), (30, "b", ts(2))], "l2", 1)
    load([(5, "c", ts(1)), (6, "c", ts(3))], "l3", 2)  # 5 is older than the table's
    load([(7, "d", ts(3)), (7, "e", ts(4)), (7, "f", ts(2))], "l4", 2)  # all repeat
    load([(8, "g", ts(4)), (8, "h", ts(5)), *[(i, "h", ts(5)) for i in range(9, 19)]], "l5", 2)  # one repeats
    load([(5, "i", ts(1))], "l6", 1)  # nothing newer
    want = {i: ("a", 1, "l1") for i in range(20)} | {5: ("b", 2, "l2"), 30: ("b", 2, "l2"), 6: ("c", 3, "l3"), 7: ("e", 4, "l4")}
    want |= {i: ("h", 5, "l5") for i in range(8, 19)}
    got = table.read()
    assert {r[0]: (r[1], r[2].hour, r[merge.LOAD_ID]) for r in got.collect()} == want and table.row_count() == 21
    ids = got.select(merge.ROW_ID, merge.row_id(["id"]).alias("again"), merge.LOAD_SEQ, merge.LOAD_ID).collect()
    assert all(r[0] == r[1] and f"l{r[2]}" == r[3] for r in ids)
