"""Run composition (O1-O4): load domains into versioned raw tables with audit, quarantine and
cursor state; then build staging, facts and reconciliation and run every declared test.

Plain Python sequencing of Spark jobs: each step is one or a few Spark actions. The feeds of a domain
don't depend on each other and are loaded side by side; Spark schedules their jobs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import merge, quality, quarantine, scd2
from tillroll.operators.audit import AuditLog
from tillroll.plans import suites
from tillroll.plans.models import RetailModels
from tillroll.plans.parallel import AT_ONCE, side_by_side
from tillroll.sources.feeds import DOMAINS, scan

# Record rules applied before the merge, per feed.
DEFAULT_RULES: dict[str, list[quarantine.ValidationRule]] = {
    "orders": [quarantine.rule("id", "not_null"), quarantine.rule("customer_id", "not_null")],
    "order_items": [quarantine.rule("id", "not_null"), quarantine.rule("order_id", "not_null")],
    "payments": [quarantine.rule("id", "not_null"), quarantine.rule("order_id", "not_null")],
}


def layer_path(root: str, layer: str | None, table: str) -> str:
    """K6: no layer -> default folder, else ``<root>/<layer>/<table>``."""
    return f"{root.rstrip('/')}/{layer or 'default'}/{table}"


def raw_table(spark: SparkSession, root: str, name: str) -> merge.MergedTable:
    return merge.MergedTable(spark, layer_path(root, "raw", name))


@dataclass
class Loaded:
    """What became of one feed of a run."""
    name: str
    rows: int = 0
    seconds: float = 0.0
    error: str | None = None
    cause: Exception | None = None


def _load_feed(spark: SparkSession, spec, source: Callable[[], DataFrame], root: str, load_seq: int, load_id: str, rules: list,
               full_refresh: bool) -> Loaded:
    """One feed: cut, split, quarantine, merge. The source is read at most twice: for the rejected rows if
    there are rules, and for the merge."""
    started, out = time.time(), Loaded(spec.name)
    try:
        table = raw_table(spark, root, spec.name)
        since = None if full_refresh else merge.parse_cursor(table.cursor_micros())
        batch = merge.incremental_cut(source(), since, spec.cursor)
        if rules:
            batch, bad = quarantine.validate_and_split(batch, rules)
            quarantine.write_quarantine(bad, layer_path(root, "quarantine", ""), spec.name, load_id)
        table.upsert(batch, list(spec.pk), f"{load_id}-{spec.name}", load_seq, spec.cursor)
        out.rows = table.row_count()
    except Exception as exc:  # noqa: BLE001  recorded with the run, raised by it
        out.error = str(exc).splitlines()[0][:500] if str(exc) else type(exc).__name__
        out.cause = exc
    out.seconds = time.time() - started
    return out


def run_domain_pipeline(spark: SparkSession, domain: str, sources: dict[str, DataFrame], root: str,
                        load_seq: int, rules: dict | None = None, audit: AuditLog | None = None,
                        full_refresh: bool = False, load_id: str | None = None, checks: dict | None = None,
                        at_once: int = AT_ONCE) -> DataFrame:
    """O1: load every feed of ``domain`` from ``sources``; returns the resource report.

    ``at_once`` feeds are loaded side by side, each under its own job group and, with the FAIR scheduler, in its
    own pool. All are tried; those that fail are logged, and the first of them fails the run. A load is named by
    ``load_id`` (default: domain and sequence): running it again after a crash overwrites its own quarantine
    rows and skips the feeds it has merged. ``checks`` (feed -> quality checks) run on the merged tables when
    all are there, and their results are stored with the audit tables (K12)."""
    rules = DEFAULT_RULES if rules is None else rules
    audit = audit or AuditLog(spark, layer_path(root, "audit", ""))
    load_id = load_id or f"{domain}-{load_seq}"
    run_id = audit.start_run(DOMAINS[domain]["pipeline_name"], "ingestion")
    started, feeds = time.time(), DOMAINS[domain]["feeds"]

    def load(spec) -> Loaded:
        return _load_feed(spark, spec, lambda: sources[spec.name], root, load_seq, load_id, rules.get(spec.name, []), full_refresh)

    loaded = side_by_side(spark, load, feeds, load_id, at_once)
    failed = [x for x in loaded if x.error is not None]
    try:
        if not failed and checks:
            tables = {name: raw_table(spark, root, name).read() for name in spec_names(domain)}
            refs = {k: v for k, v in tables.items() if v is not None}
            for name in (n for n in spec_names(domain) if n in checks and n in refs):
                audit.store_results(quality.results_frame(spark, quality.run_checks(spark, name, refs[name], checks[name], refs=refs)))
    except Exception as exc:  # noqa: BLE001
        failed.append(Loaded("checks", 0, 0.0, str(exc).splitlines()[0][:500] if str(exc) else type(exc).__name__, exc))
    for x in loaded:
        audit.log_resource(run_id, x.name, x.rows, "success" if x.error is None else "failed", x.seconds, x.error)
    total = sum(x.rows for x in loaded)
    if failed:
        audit.end_run(run_id, "failed", total, time.time() - started, failed[0].error)
        raise failed[0].cause
    audit.end_run(run_id, "success", total, time.time() - started)
    return (audit.events("pipeline_resource_runs").filter(F.col("run_id") == run_id)
            .select("resource_name", "row_count", "status", "duration_seconds", "error_message"))


def spec_names(domain: str) -> list[str]:
    return [f.name for f in DOMAINS[domain]["feeds"]]


def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame], root: str, load_seq: int,
                 domains: list[str] | None = None, **kw) -> dict[str, DataFrame]:
    """O2: every domain in order; an unknown domain is skipped with a message."""
    out = {}
    for d in domains or list(DOMAINS):
        if d not in DOMAINS:
            print(f"Unknown domain: {d} (skipped)")
            continue
        out[d] = run_domain_pipeline(spark, d, sources, root, load_seq, **kw)
    return out


def read_raw(spark: SparkSession, root: str, metadata: bool = False) -> dict[str, DataFrame]:
    """The merged raw tables, with or without the load metadata columns (K2)."""
    raw = {}
    for d in DOMAINS.values():
        for spec in d["feeds"]:
            df = raw_table(spark, root, spec.name).read()
            if df is not None:
                raw[spec.name] = df if metadata else df.drop(*merge.METADATA)
    return raw


#: Versions of the marts that stay readable.
KEPT_MARTS = 3
MART_PARTITIONS = {"fct_orders": ["order_year", "order_month"], "fct_daily_marketing_performance": ["year", "month"]}


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts of the published version."""
    row = spark.read.parquet(layer_path(root, "mart", "_published")).agg(F.max("version")).first()
    return {n: scan(spark, layer_path(root, "mart", f"v={row[0]}/{n}")) for n in RetailModels.MART_NAMES}


def run_transforms(spark: SparkSession, root: str, run_ts: str | None = None, fail_on_test: bool = True,
                   snapshot_ts: str | None = None) -> dict:
    """O3: staging views -> facts and reconciliation written in dependency order -> all tests.

    Marts are written as a new version, partitioned tables with one task a partition value or AQE's
    share of it, tested there, and published by one appended row: readers keep the tested version
    before until then. With ``snapshot_ts`` the product history (M6) takes this run's products too."""
    m = RetailModels(read_raw(spark, root), run_ts)
    version = f"{uuid.uuid1().time:020d}"
    def build(name: str) -> DataFrame:
        path = layer_path(root, "mart", f"v={version}/{name}")
        df = m.model(name)
        if name in MART_PARTITIONS:
            df = df.hint("rebalance", *MART_PARTITIONS[name])
            df.write.option("compression", "zstd").partitionBy(*MART_PARTITIONS[name]).parquet(path)
        else:
            df.write.option("compression", "zstd").parquet(path)
        return scan(spark, path)

    # recon_marketing reads the fact that the first group writes; within a group no mart reads another.
    built = {}
    for group in ([n for n in RetailModels.MART_NAMES if n not in m.AFTER], list(m.AFTER)):
        built |= dict(zip(group, side_by_side(spark, build, group, f"marts-{version}")))
        m.__dict__["fct_daily_marketing_performance"] = built["fct_daily_marketing_performance"]
    models = {**m.raw, **m.stg, **built}
    results = suites.run_declared_tests(models).collect()
    failed = [r["test_name"] for r in results if not r["passed"]]
    report = {"models_built": len(m.stg) + len(built), "tests_passed": len(results) - len(failed),
              "tests_failed": failed}
    if fail_on_test and failed:
        raise RuntimeError(f"{len(failed)} data tests failed: {failed[:10]}")
    published = layer_path(root, "mart", "_published")
    spark.createDataFrame([(version,)], "version string").write.mode("append").parquet(published)
    _retire_marts(spark, root, [r[0] for r in spark.read.parquet(published).orderBy(F.desc("version")).limit(KEPT_MARTS).collect()])
    if snapshot_ts is not None:
        take_product_snapshot(spark, root, m.stg["stg_products"], snapshot_ts)
    return report


def _folders(spark: SparkSession, at: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders in ``at``, sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def _retire_marts(spark: SparkSession, root: str, kept: list[str]) -> None:
    """Remove the marts older than the oldest kept version; newer ones may be a run's that isn't through."""
    at = layer_path(root, "mart", "")
    for version in _folders(spark, at, "v="):
        if version < min(kept):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}v={version}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def product_history(spark: SparkSession, root: str, state: int | None = None) -> DataFrame | None:
    """M6: the product versions of all extracts taken (at an earlier ``state`` of the table)."""
    found = _history(spark, root).read(state)
    return None if found is None else found.where(~F.col(scd2.REMOVED)).drop(scd2.REMOVED, "_epoch", *merge.METADATA)


def _history(spark: SparkSession, root: str) -> merge.MergedTable:
    return merge.MergedTable(spark, layer_path(root, "snapshot", "product_snapshot"))


def take_product_snapshot(spark: SparkSession, root: str, stg_products: DataFrame, run_ts: str) -> DataFrame:
    """M6 within a run: the extract of the time ``run_ts`` becomes part of the history, also if it is older than
    others. The history is a merged table of versions, so only changed versions are written, and taking the same
    time again changes nothing. Extracts are kept, as sightings of their keys."""
    table, at = _history(spark, root), layer_path(root, "snapshot", "extracts")
    stamp = "".join(c for c in run_ts if c.isdigit())
    load_id = f"extract-{stamp}"
    if not table.applied(load_id):
        path = f"{at}/at={stamp}"
        stg_products.select(scd2.PRODUCT_COLUMNS).write.mode("overwrite").parquet(path)
        source = spark.read.parquet(path)
        taken = [v for v in _folders(spark, at, "at=") if v > stamp and table.applied(f"extract-{v}")]
        later = None
        for v in taken:
            part = spark.read.parquet(f"{at}/at={v}").withColumn("seen_at", F.to_timestamp(F.lit(v), "yyyyMMddHHmmss"))
            later = part if later is None else later.unionByName(part)
        # The versions are worked out from one state of the history; should another extract be published
        # meanwhile, the sequence is used up and the load raises.
        last = table.current_version()
        changed = scd2.changed_versions(product_history(spark, root, last), later, source, "product_id", scd2.PRODUCT_CHECK_COLUMNS, run_ts)
        table.upsert(changed.withColumn("_epoch", F.timestamp_seconds(F.lit(0))), ["product_id", scd2.VALID_FROM], load_id,
                     (last or 0) + 1, cursor="_epoch")
    return product_history(spark, root)


# Job selections
JOBS = {
    "full": {"domains": ["commerce", "marketing", "inventory"], "transforms": True, "full_refresh": False},
    "commerce": {"domains": ["commerce"], "transforms": False, "full_refresh": False},
    "marketing": {"domains": ["marketing"], "transforms": False, "full_refresh": False},
    "inventory": {"domains": ["inventory"], "transforms": False, "full_refresh": False},
    "backfill": {"domains": ["commerce", "marketing", "inventory"], "transforms": True, "full_refresh": True},
}


def run_job(spark: SparkSession, job: str, sources: dict[str, DataFrame], root: str, load_seq: int,
            run_ts: str | None = None, compact_audit: bool = False, **options) -> dict:
    """The loads, and for some jobs the transforms, of a selection. ``compact_audit`` folds the audit
    events of ended runs afterwards."""
    sel = JOBS[job]
    loads = run_pipeline(spark, sources, root, load_seq, sel["domains"], full_refresh=sel["full_refresh"], **options)
    out = {"loads": {d: [r.asDict() for r in df.collect()] for d, df in loads.items()}}
    if sel["transforms"]:
        out["transforms"] = run_transforms(spark, root, run_ts, fail_on_test=False)
    if compact_audit:
        AuditLog(spark, layer_path(root, "audit", "")).compact()
    return out
