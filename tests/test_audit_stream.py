import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators.audit import AuditLog
from tillroll.operators.merge import LOAD_ID, MergedTable
from tillroll.streaming.merge_stream import run_to_completion, start_merge_stream


def test_audit_fold(spark, scratch):
    a = AuditLog(spark, f"{scratch}/audit")
    r1 = a.start_run("commerce", "ingestion")
    a.log_resource(r1, "orders", 10)
    a.end_run(r1, "success", 10, 1.5)
    r2 = a.start_run("marketing", "ingestion")
    a.end_run(r2, "failed", 0, 0.1, error_message="boom")
    r3 = a.start_run("inventory", "ingestion")
    cur = {r["run_id"]: r for r in a.current_runs().collect()}
    assert cur[r1]["status"] == "success" and cur[r1]["total_rows"] == 10 and cur[r1]["pipeline_name"] == "commerce"
    assert cur[r1]["error_message"] is None and cur[r1]["completed_at"] is not None
    assert cur[r2]["status"] == "failed" and cur[r2]["error_message"] == "boom"
    assert cur[r3]["status"] == "running" and cur[r3]["completed_at"] is None
    assert a.events("pipeline_resource_runs").count() == 1


def test_compaction_keeps_the_state(spark, scratch):
    import os
    a = AuditLog(spark, f"{scratch}/audit")
    rows = lambda df: sorted(map(str, df.collect()))
    files = lambda t: sum(f.endswith(".parquet") for _, _, names in os.walk(f"{scratch}/audit/{t}") for f in names)
    runs = [a.start_run(f"p{i}", "ingestion") for i in range(4)]
    for i, r in enumerate(runs[:3]):
        a.log_resource(r, "orders", i)
        a.end_run(r, "failed" if i == 1 else "success", i, 0.5, "boom" if i == 1 else None)
    state, resources = rows(a.current_runs()), rows(a.events("pipeline_resource_runs"))
    assert a.compact() == {"pipeline_runs": 6, "pipeline_resource_runs": 3}
    assert files("pipeline_runs") == 1 and files("pipeline_resource_runs") == 0
    assert rows(a.current_runs()) == state and rows(a.events("pipeline_resource_runs")) == resources
    assert a.compact() == {"pipeline_runs": 0, "pipeline_resource_runs": 0}
    # A run that ended says more: what it doesn't say stays. The open one ends.
    a.end_run(runs[0], "failed", 9, 0.7, "found later")
    a.end_run(runs[3], "success", 5)
    state = rows(a.current_runs())
    assert a.compact()["pipeline_runs"] == 3 and rows(a.current_runs()) == state
    got = {r.run_id: r for r in a.current_runs().collect()}
    assert len(got) == 4 and got[runs[0]].pipeline_name == "p0" and got[runs[0]].error_message == "found later"
    assert got[runs[3]].status == "success" and got[runs[3]].pipeline_name == "p3"


def test_compaction_that_broke_off(spark, scratch):
    import shutil
    a = AuditLog(spark, f"{scratch}/audit")
    r = a.start_run("p", "ingestion")
    a.log_resource(r, "orders", 1)
    a.end_run(r, "success", 1)
    rows = lambda df: sorted(map(str, df.collect()))
    state, resources = rows(a.current_runs()), rows(a.events("pipeline_resource_runs").select("id", "row_count"))
    # Folded but not removed: the rows are there twice and count once.
    for table in ("pipeline_runs", "pipeline_resource_runs"):
        shutil.copytree(f"{scratch}/audit/{table}", f"{scratch}/kept/{table}")
    a.compact()
    for table in ("pipeline_runs", "pipeline_resource_runs"):
        shutil.copytree(f"{scratch}/kept/{table}", f"{scratch}/audit/{table}", dirs_exist_ok=True)
    assert a._single("pipeline_runs").count() == 2
    assert rows(a.current_runs()) == state and rows(a.events("pipeline_resource_runs").select("id", "row_count")) == resources
    a.compact()
    assert rows(a.current_runs()) == state and rows(a.events("pipeline_resource_runs").select("id", "row_count")) == resources


def test_stream_merge_is_idempotent(spark, scratch):
    schema = "id long, status string, updated_at timestamp"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    land = f"{scratch}/landing"
    spark.createDataFrame([(1, "a", t(1)), (2, "b", t(1))], schema).coalesce(1).write.mode("append").parquet(land)
    spark.createDataFrame([(1, "a2", t(3)), (1, "a2", t(3)), (3, "c", t(3))], schema).coalesce(1) \
        .write.mode("append").parquet(land)
    q = start_merge_stream(spark, land, spark.read.parquet(land).schema, f"{scratch}/table", f"{scratch}/ck", ["id"],
                           max_files_per_trigger=1, name="t")
    run_to_completion(q)
    table = MergedTable(spark, f"{scratch}/table")
    got = sorted((r["id"], r["status"]) for r in table.read().collect())
    assert got == [(1, "a2"), (2, "b"), (3, "c")]
    # restart on the same checkpoint: nothing new, nothing changes
    q = start_merge_stream(spark, land, spark.read.parquet(land).schema, f"{scratch}/table", f"{scratch}/ck", ["id"],
                           name="t")
    run_to_completion(q)
    assert sorted((r["id"], r["status"]) for r in table.read().collect()) == got
    assert table.read().filter(F.col(LOAD_ID).isNull()).count() == 0


def test_stream_keeps_late_rows_and_the_last_load_of_a_tie(spark, scratch):
    schema = "id long, status string, updated_at timestamp"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    land = f"{scratch}/landing"
    for part in ([(1, "v1", t(20)), (2, "x", t(20))], [(5, "only", t(1))], [(1, "v1-corrected", t(20))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(land)
    run_to_completion(start_merge_stream(spark, land, spark.read.parquet(land).schema, f"{scratch}/table", f"{scratch}/ck", ["id"],
                                         max_files_per_trigger=1, name="t"))
    got = sorted((r["id"], r["status"]) for r in MergedTable(spark, f"{scratch}/table").read().collect())
    assert [g[0] for g in got] == [1, 2, 5] and got[0][1] in ("v1", "v1-corrected")
    # a backfill under a new checkpoint, onto the existing table
    run_to_completion(start_merge_stream(spark, land, spark.read.parquet(land).schema, f"{scratch}/table", f"{scratch}/ck2", ["id"], name="t"))
    assert MergedTable(spark, f"{scratch}/table").read().count() == 3


def test_a_whole_job_leaves_no_views_or_caches(spark, scratch):
    from tillroll.plans import run
    from tillroll.sources import fixtures as fx
    before = {v.name for v in spark.catalog.listTables()}
    out = run.run_job(spark, "full", fx.raw_feeds(spark, "/root/testdata/sf0.001"), scratch, 1, "2024-01-01 00:00:00")
    assert set(out["loads"]) == {"commerce", "marketing", "inventory"} and out["transforms"]["models_built"] == 17
    again = run.run_job(spark, "backfill", fx.raw_feeds(spark, "/root/testdata/sf0.001"), scratch, 2, "2024-01-01 00:00:00")
    assert [r["row_count"] for r in again["loads"]["commerce"]] == [r["row_count"] for r in out["loads"]["commerce"]]
    assert {v.name for v in spark.catalog.listTables()} == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert run.run_pipeline(spark, {}, scratch, 3, ["unknown"]) == {}


def test_shared_folder_is_required_off_local_mode(monkeypatch):
    import pytest

    from tillroll import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_a_truncated_page_fails_the_read(spark, scratch):
    import pytest

    from tillroll.sources import feeds, fixtures
    spec = feeds.feed("orders")
    fixtures.write_pages(fixtures.raw_feed(spark, "/root/testdata/sf0.001", "orders"), f"{scratch}/pages", spec.pk)
    with open(f"{scratch}/pages/part-truncated.json", "w") as f:
        f.write('{"data": [{"id": 1, "order_num')
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.read_pages(spark, f"{scratch}/pages", spec).collect()
