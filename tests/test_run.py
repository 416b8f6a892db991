"""O1: feeds loaded side by side."""
import pytest
from pyspark.sql import functions as F

from tillroll.operators.audit import AuditLog
from tillroll.plans import run
from tillroll.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def content(spark, root):
    out = {}
    for name, df in run.read_raw(spark, root).items():
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
        out[name] = tuple(row)
    return out


def test_side_by_side_loads_the_same_as_one_by_one(spark, scratch):
    for name, at_once in (("one", 1), ("many", 4)):
        report = run.run_domain_pipeline(spark, "marketing", fx.raw_feeds(spark, SF), f"{scratch}/{name}", 1, at_once=at_once)
        assert [r.resource_name for r in report.orderBy("resource_name").collect()] == sorted(run.spec_names("marketing"))
    assert content(spark, f"{scratch}/one") == content(spark, f"{scratch}/many")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failing_feed_is_named_and_the_others_are_loaded(spark, scratch):
    feeds = dict(fx.raw_feeds(spark, SF).items())
    feeds["ad_sets"] = feeds["ad_sets"].withColumn("id", F.raise_error(F.lit("source is down")).cast("long"))
    with pytest.raises(Exception, match="source is down"):
        run.run_domain_pipeline(spark, "marketing", feeds, scratch, 1)
    audit = AuditLog(spark, run.layer_path(scratch, "audit", ""))
    states = {r.resource_name: r.status for r in audit.events("pipeline_resource_runs").collect()}
    assert states == {"campaigns": "success", "ad_sets": "failed", "ads": "success", "daily_performance": "success"}
    assert [r.status for r in audit.current_runs().collect()] == ["failed"]
    # The same load again merges the feed that failed and skips the others.
    run.run_domain_pipeline(spark, "marketing", fx.raw_feeds(spark, SF), scratch, 1)
    assert set(run.read_raw(spark, scratch)) == set(run.spec_names("marketing"))
    assert run.raw_table(spark, scratch, "ads").versions() == [1]


def test_a_source_is_read_twice_at_most(spark, scratch):
    """With rules: once for the rejected rows, once for the merge."""
    reads = spark.sparkContext.accumulator(0)
    ads = fx.raw_feeds(spark, SF)["ads"].coalesce(1)

    def counted(batches):
        reads.add(1)
        yield from batches

    source = ads.mapInArrow(counted, ads.schema)
    spec = next(f for f in run.DOMAINS["marketing"]["feeds"] if f.name == "ads")
    rules = [run.quarantine.rule("id", "not_null"), run.quarantine.rule("ad_type", "in_list", values=["image"])]
    out = run._load_feed(spark, spec, lambda: source, scratch, 1, "l1", rules, False)
    assert out.error is None and reads.value == 2
    bad = spark.read.parquet(f"{scratch}/quarantine/ads_quarantine").count() if out.rows < ads.count() else 0
    assert out.rows + bad == ads.count()


def test_marts_of_old_versions_go(spark, scratch):
    import os
    run.run_pipeline(spark, fx.raw_feeds(spark, SF), scratch, 1)
    for _ in range(run.KEPT_MARTS + 1):
        run.run_transforms(spark, scratch, "2024-01-01 00:00:00", fail_on_test=False)
    kept = sorted(x for x in os.listdir(f"{scratch}/mart") if x.startswith("v="))
    assert len(kept) == run.KEPT_MARTS
    assert run.read_marts(spark, scratch)["fct_orders"].count() == run.read_raw(spark, scratch)["orders"].count()
