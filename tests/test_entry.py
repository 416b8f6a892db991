"""Driver contract on the smallest scale: entry runs, every query has a matching oracle."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "order_status_category" in df.columns


def test_every_query_has_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert len(own) >= 38 and own <= set(o)


@pytest.mark.parametrize("name", ["fct_orders", "fct_daily_marketing_performance", "recon_marketing_spend_vs_revenue",
                                  "stg_products", "product_snapshot", "quarantine_products", "merge_change_feed",
                                  "list_orders_page", "raw_suite", "stream_evolution", "page_faults", "snapshot_any_order",
                                  "merge_two_writers", "list_movements_deep_pages", "schema_inventory"])
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    spark_rows = sorted((tuple(r[c] for c in sorted(dcols)) for r in df.collect()), key=key)
    duck_rows = sorted((tuple(dict(zip(dcols, r))[c] for c in sorted(dcols)) for r in cur.fetchall()), key=key)
    assert len(spark_rows) == len(duck_rows)
    assert [tuple(str(v) for v in r) for r in spark_rows] == [tuple(str(v) for v in r) for r in duck_rows]


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_queries_without_the_optional_part(tmp_path, with_pipeline):
    """A copy of the tree without the training-data folders still registers all other queries."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    gone = {"llm", ".git", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"])}
    shutil.copytree(root, tmp_path / "copy", ignore=lambda _, names: gone & set(names))
    os.makedirs(tmp_path / "copy/tillroll/llm")  # an empty folder may be left behind
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"],
                         cwd=tmp_path / "copy", env={**os.environ, "PYTHONPATH": str(tmp_path / "copy")}, capture_output=True, text=True, timeout=120)
    own = [k for k in E.queries() if k != "pipeline" and not k.startswith("op")]
    assert out.stdout.split() == ["True", str(len(own))], out.stderr[-500:]
